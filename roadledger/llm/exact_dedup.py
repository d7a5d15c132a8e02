"""Exact dedup: a stream of digests into disk-backed keyed state, with whole texts compared on hits.

Texts are equal when identical after every character of ``[\\x20\\x09-\\x0D]`` is deleted. A first pass lands one
narrow record per row: digest of that text, length, id and the row's address (the content locator). A streaming
aggregation keyed by digest, on the RocksDB state store and without watermark, so that nothing expires, retains
for each digest the number of rows and the row that stays (its id and locator). It combines on the map side, so a
digest that holds a third of all rows reaches its state as one record per task. Rows whose digest was hit more
than once are then read again and their whole texts compared; classes of a digest that holds several texts are
taken apart. Another digest can be passed; a weak one costs time, never rows.

Defined results: null text is empty, and all empty texts are equal; the row with the most code points stays, then
the smallest id (null last), then the lowest address, so of repeated rows exactly one stays; a null id stays null;
an empty table gives no rows; other columns are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadledger.llm.common import ADDRESS, FILE, ROW, addressed, dropped, narrow_join, settings, text_of
from roadledger.session import fresh_path, written

WHITE_SPACE = r"[\x20\x09-\x0D]+"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Input of one micro-batch; state is committed after each.
BATCH_BYTES = str(64 << 30)
_BEST = "struct<short:int,noid:boolean,id:bigint,file:bigint,row:bigint>"


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _normal(rows: DataFrame, text_col: str) -> Column:
    return F.regexp_replace(text_of(rows, text_col), WHITE_SPACE, "")


def _best() -> Column:
    """Least of the rows of a class: longest text, then smallest id, then lowest address."""
    return F.min(F.struct((-F.col("chars")).alias("short"), F.col("id").isNull().alias("noid"), F.col("id"),
                          F.col("file"), F.col("row"))).cast(_BEST)


def land_digests(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    """One stored record per row of ``docs`` (which has addresses)."""
    normal = _normal(docs, text_col)
    return written(docs.select(
        docs[id_col].cast("bigint").alias("id"), docs[FILE].alias("file"), docs[ROW].alias("row"),
        F.char_length(text_of(docs, text_col)).alias("chars"), digest(normal).alias("digest"),
        F.sha2(normal, 256).alias("sha")), "digests")


def keyed_state(spark: SparkSession, records: DataFrame, **source: str) -> DataFrame:
    """Streams the landed records into state by digest; gives back the last value of every key."""
    path, updates, state = records.inputFiles(), fresh_path(spark, "state-updates"), fresh_path(spark, "state")
    stream = spark.readStream.schema(records.schema)
    for key, value in (source or {"maxBytesPerTrigger": BATCH_BYTES}).items():
        stream = stream.option(key, value)
    folder = path[0].rsplit("/", 1)[0] if path else fresh_path(spark, "no-digests")
    if not path:
        records.write.parquet(folder)
    values = stream.parquet(folder).groupBy("digest").agg(F.count("*").alias("group_size"), _best().alias("best"))

    def keep(batch: DataFrame, number: int) -> None:
        # A replayed batch overwrites its own folder.
        batch.write.mode("overwrite").parquet(f"{updates}/batch={number}")

    # Without fallocate a store takes the space of its keys, not some MB for each state partition; with a small write
    # buffer the same holds for memory, since a store sets an eighth of its buffer aside at once.
    with settings(spark, spark__sql__streaming__stateStore__providerClass=ROCKSDB,
                  spark__sql__streaming__stateStore__rocksdb__writeBufferSizeMB="4",
                  spark__sql__streaming__stateStore__rocksdb__allowFAllocate="false"):
        run = (values.writeStream.outputMode("update").foreachBatch(keep)
               .option("checkpointLocation", state).trigger(availableNow=True).start())
    run.awaitTermination()
    layout = f"digest string, group_size bigint, best {_BEST}, batch int"
    try:
        changed = spark.read.schema(layout).parquet(updates)
    except Exception as error:  # no batch ran: there were no records
        if "PATH_NOT_FOUND" not in str(error):
            raise
        changed = spark.createDataFrame([], layout)
    return changed.groupBy("digest").agg(F.max_by(F.struct("group_size", "best"), "batch").alias("value")).select(
        "digest", "value.group_size", "value.best")


def exact_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  digest: Callable[[Column], Column] = sha256, **source: str) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256 and the address.

    ``source`` are options of the file stream, such as ``maxFilesPerTrigger``.
    """
    spark = docs.sparkSession
    rows = addressed(docs, "documents")
    records = land_digests(rows, id_col, text_col, digest)
    state = written(keyed_state(spark, records, **source), "digest-state")
    hits = written(state.where("group_size > 1").select("digest"), "digest-hits")
    # Whole texts of every hit are compared; copies are combined before they are shuffled.
    seen = narrow_join(rows.select(digest(_normal(rows, text_col)).alias("digest"), _normal(rows, text_col).alias("normal")),
                       hits, ["digest"], "left_semi")
    several = written(seen.groupBy("digest", "normal").agg(F.count("*").alias("n")).groupBy("digest").agg(
        F.count("*").alias("texts")).where("texts > 1").select("digest"), "digest-clashes")
    classes = records.join(state, "digest")
    if several.count():
        classes = classes.join(several, "digest", "left_anti").unionByName(
            _taken_apart(rows, records, several, text_col))
    dropped(spark, hits)
    return classes.select(
        F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), "group_size",
        ((F.col("file") == F.col("best.file")) & (F.col("row") == F.col("best.row"))).alias("kept"),
        F.col("sha").alias("text_sha256"), F.col("file").alias(FILE), F.col("row").alias(ROW))


def _taken_apart(rows: DataFrame, records: DataFrame, several: DataFrame, text_col: str) -> DataFrame:
    """Classes by whole text for the digests that several texts share."""
    texts = rows.select(F.col(FILE).alias("file"), F.col(ROW).alias("row"), _normal(rows, text_col).alias("normal"))
    unclear = written(records.join(several, "digest", "left_semi").join(texts, ["file", "row"]), "clashing-texts")
    state = unclear.groupBy("digest", "normal").agg(F.count("*").alias("group_size"), _best().alias("best"))
    return unclear.join(state, ["digest", "normal"]).select(*records.columns, "group_size", "best")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows = addressed(docs, "documents")
    gone = written(exact_classes(rows, id_col, text_col, **options).where(~F.col("kept")).select(*ADDRESS), "exact-copies")
    return narrow_join(rows, gone, ADDRESS, "left_anti").select(*docs.columns)
