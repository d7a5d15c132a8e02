"""Quality classifier: histogram gradient-boosted trees over document statistics.

Labels are learnt from a bounded sample (``fit_rows``, lowest hash of the id first) of the labelled rows whose
crc32(id as text) mod 5 is not 0; the other fifth is held out. The sample's statistics are computed by Spark and fit
on the driver, which holds ``fit_rows`` short rows at most; every whole text is then scored inside Spark tasks.
Ids, labels, language and source are no inputs of a score.

Defined results: null text is empty, all of whose statistics are 0, and gets a score like any other; a null id
counts as held out; a label that is null is passed over, and of several labels of one id the least counts; with
labels of one kind, or none, every score is that kind's share (0.5); an empty table gives no rows; other columns are
left as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, FloatType

from roadledger.llm.shingles import slices
from roadledger.llm.statistics import NAMES, statistics
from roadledger.llm.trees import Forest, fit_forest

#: Labelled rows that the trees are fit on at most.
FIT_ROWS = 20_000
#: Score from which a document is taken for good.
THRESHOLD = 0.3
FOLDS = 5


def _parts(texts: pa.Array):
    return slices([pa.RecordBatch.from_arrays([texts.cast(pa.string())], names=["text"])], "text")


@arrow_udf(ArrayType(FloatType()))
def measured(texts: pa.Array) -> pa.Array:
    """The statistics of each text."""
    rows = [statistics(part.column(0)) for part in _parts(texts)] or [np.zeros((0, len(NAMES)), np.float32)]
    flat = np.concatenate(rows)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * len(NAMES), pa.int32()), pa.array(flat.ravel()))


def held_out(docs: DataFrame, id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(docs[id_col].cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", fit_rows: int = FIT_ROWS) -> Forest:
    known = labels.where(labels[id_col].isNotNull() & labels[label_col].isNotNull() & ~held_out(labels, id_col))
    known = known.groupBy(known[id_col].alias("known_id")).agg(F.min(label_col).cast("int").alias("known_label"))
    sample = known.orderBy(F.xxhash64("known_id"), "known_id").limit(fit_rows)
    # At most fit_rows rows of two numbers are sent to every task.
    rows = docs.select(docs[id_col].alias("row_id"), docs[text_col].cast("string").alias("row_text")).join(
        F.broadcast(sample), F.col("row_id") == F.col("known_id"))
    # Ids of documents can repeat; the bound holds for the rows too.
    found = rows.select("row_id", measured("row_text").alias("x"), "known_label").orderBy(
        F.xxhash64("row_id"), "row_id", "x").limit(fit_rows).collect()
    x = np.array([r.x for r in found], np.float32).reshape(len(found), len(NAMES))
    return fit_forest(x, np.array([r.known_label for r in found], float))


def scored(forest: Forest, text: Column) -> Column:
    """Score of each whole text, 0 to 1."""

    @arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        done = [forest.score(statistics(part.column(0))) for part in _parts(texts)]
        return pa.array(np.concatenate(done) if done else np.zeros(0))

    return score(F.coalesce(text.cast("string"), F.lit("")))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   **options) -> DataFrame:
    """One row per row of ``docs``: id, held_out, score, predicted."""
    forest = fit_quality(docs, labels, id_col, text_col, **options)
    return docs.select(docs[id_col], held_out(docs, id_col).alias("held_out"),
                       scored(forest, docs[text_col]).alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that the classifier takes for good, with all their columns."""
    forest = fit_quality(docs, labels, id_col, text_col, **options)
    return docs.where(scored(forest, docs[text_col]) >= THRESHOLD)
