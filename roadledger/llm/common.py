"""Row addresses, size-checked joins and table clean-up shared by the operators of this package."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadledger.session import written

#: A side is sent to every executor only after it was counted and found to hold at most this many narrow rows.
BROADCAST_ROWS = 200_000
FILE, ROW = "__row_file", "__row_index"
ADDRESS = [FILE, ROW]


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _plain_scan(df: DataFrame) -> bool:
    """True for files under filters and projections: each file row then comes at most once, under its own position."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    return plan.nodeName() == "LogicalRelation" or plan.nodeName().startswith("Relation")


def addressed(df: DataFrame, label: str = "rows") -> DataFrame:
    """``df`` with the address of each row: a hash of its file's path, and its position in that file.

    Addresses are the same in every later scan, whatever the partitioning. Anything but a plain file scan is
    written to the work folder first. Two files share a hash with probability n*n / 2**65.
    """
    if FILE in df.columns and ROW in df.columns:
        return df
    if not _plain_scan(df):
        df = written(df, label)
    place = df.metadataColumn("_metadata")
    return df.withColumns({FILE: F.xxhash64(place["file_path"]), ROW: place["row_index"]})


def text_of(df: DataFrame, column: str) -> Column:
    """Whole text; null counts as empty."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def narrow_join(wide: DataFrame, narrow: DataFrame, on: list[str], how: str) -> DataFrame:
    """Join with a stored narrow table: its rows are counted, and only a small one is broadcast.

    A larger one is joined by shuffle, where AQE splits keys that hold many rows of the wide side.
    """
    if narrow.count() <= BROADCAST_ROWS:
        narrow = F.broadcast(narrow)
    return wide.join(narrow, on, how)


def dropped(spark: SparkSession, *tables: DataFrame) -> None:
    """Deletes tables of the work folder that no later step reads."""
    for table in tables:
        for path in {p.rsplit("/", 1)[0] for p in table.inputFiles()}:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Session settings (dots written as ``__``) for the length of a block."""
    names = {key.replace("__", "."): value for key, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in names}
    try:
        for key, value in names.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
