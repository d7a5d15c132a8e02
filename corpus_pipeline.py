"""Training-data pipeline over ``documents``: quality, exact copies, near copies, mixture, packed sequences.

Each stage works on all rows its predecessor kept, read back from Parquet; the last returns packed
pieces with their token ids and a checksum of them. Nulls, empty and long texts, ties, repeated rows, empty tables and
other columns are handled as the operators' docstrings say: an empty text is rejected or kept by its score like any
other, of equal or near-equal texts one row stays, rows that share an id are drawn together, and all columns of
``documents`` pass every stage but the last unchanged, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from roadledger.llm.common import ADDRESS, documents, dropped
from roadledger.llm.exact_dedup import exact_dedup
from roadledger.llm.mixing import mixed_sample
from roadledger.llm.near_dedup import near_dedup
from roadledger.llm.packing import pack
from roadledger.llm.quality import accepted
from roadledger.session import written

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: Python workers of the stages before are still there when texts are tokenised, so this stage holds less at a time.
SLICE_BYTES = 1 << 20


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return accepted(docs, documents(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_sample(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, TOKENIZER, slice_bytes=SLICE_BYTES).withColumn("ids_crc32", F.crc32("ids")).drop(*ADDRESS)


STAGES = [("quality", quality), ("exact_dedup", exact_copies), ("near_dedup", near_copies), ("mixing", mixing),
          ("packing", packing)]
#: SQL has no trees, stages of hashes or tokenizers.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written to the work folder and read back."""
    docs = documents(spark, sf_dir)
    for number, (name, stage) in enumerate(STAGES):
        kept = written(stage(spark, docs, sf_dir), f"stage-{name}")
        if number:
            dropped(spark, docs)
        docs = kept
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
