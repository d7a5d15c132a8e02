"""Scoring of a stream of requests: predictions, refused requests and a row of figures per epoch."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from roadledger.operators.gate import accounting, failed, passed
from roadledger.operators.models import checked_requests, score
from roadledger.session import scratch, written

EPOCH_FIGURES = "requests bigint, refused bigint, millis bigint"


def score_batch(model: PipelineModel, target: str, keep: tuple[str, ...] = ()) -> Callable[[DataFrame, int], None]:
    """The micro-batch function. Every epoch writes its own folders whole, so one that is run again
    replaces its rows."""

    def run(rows: DataFrame, epoch: int) -> None:
        started, spark = time.monotonic(), rows.sparkSession
        with scratch(spark):
            judged = written(checked_requests(rows), "requests")
            score(model, passed(judged), keep).write.mode("overwrite").parquet(f"{target}/scored/epoch={epoch}")
            failed(judged).write.mode("overwrite").parquet(f"{target}/refused/epoch={epoch}")
            counts = accounting(judged).first()
        row = (counts["valid"] + counts["rejected"], counts["rejected"], int((time.monotonic() - started) * 1000))
        spark.createDataFrame([row], EPOCH_FIGURES).coalesce(1).write.mode("overwrite").parquet(f"{target}/epochs/epoch={epoch}")

    return run


def stream_scores(requests: DataFrame, model: PipelineModel, target: str, checkpoint: str,
                  keep: tuple[str, ...] = ()) -> StreamingQuery:
    """Scores everything available; below ``target`` lie ``scored``, ``refused`` (with the reason) and ``epochs``."""
    return (requests.writeStream.foreachBatch(score_batch(model, target, keep))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def request_totals(spark: SparkSession, target: str) -> DataFrame:
    """One row over all epochs ever run: requests, refused ones and mean time per request in ms."""
    return spark.read.parquet(f"{target}/epochs").agg(
        F.coalesce(F.sum("requests"), F.lit(0)).alias("requests"), F.coalesce(F.sum("refused"), F.lit(0)).alias("refused"),
        F.coalesce(F.try_divide(F.sum("millis"), F.sum("requests")), F.lit(0.0)).alias("avg_latency_ms"))
