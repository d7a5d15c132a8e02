"""Session defaults and the shared work folder every multi-pass operator writes to."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # Beyond this size the JVM only interprets a generated method; smaller pieces run faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Paths written inside ``scratch`` blocks, innermost last.
_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def build_session(app_name: str = "roadledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; keyword arguments (dots written as ``__``) override them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SESSION_DEFAULTS)
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables, below the shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without that setting and then works below its warehouse; on a
    cluster a missing setting is an error.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if shared:
        return f"{shared.rstrip('/')}/roadledger-{context.applicationId}"
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/roadledger-{context.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the work folder that nothing has used yet."""
    return f"{work_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the work folder and return the table read back.

    Cuts the lineage with a table that survives lost executors. Each task writes one file, so
    ``_metadata.row_index`` of the result is the row's position within the partition that wrote it.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    kept = _SCRATCH.get()
    if kept is not None:
        kept.append(path)
    df.write.option("maxRecordsPerFile", 0).option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, label: str = "stored") -> DataFrame:
    """``df`` if it reads files straight, under projections and filters at most, else its written copy."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    return df if "Relation" in plan.nodeName() else written(df, label)


def planned_bytes(df: DataFrame) -> int:
    """Size that Spark plans with; of a stored table, its files scaled to the columns read."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def deleted(spark: SparkSession, path: str) -> None:
    """Removes a folder of the shared store, whatever store that is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes, at the end, the tables that ``written`` made inside the block; nothing may read them later."""
    paths: list[str] = []
    mark = _SCRATCH.set(paths)
    try:
        yield
    finally:
        _SCRATCH.reset(mark)
        for path in paths:
            deleted(spark, path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def side_by_side(*jobs: Callable[[], object]) -> list:
    """Runs independent writes at the same time, so that small ones do not leave the cluster idle."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [done.result() for done in [pool.submit(job) for job in jobs]]
