"""Streaming ingestion and scoring of a driver table read as a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadledger.catalog.feed import ARRIVAL_COLUMNS, FEED, FEED_SQL, GATED_SQL, feed_columns
from roadledger.catalog.registry import query, table
from roadledger.catalog.training import FOREST, fitted_unit, training_rows
from roadledger.operators.gate import LATITUDE_BOUNDS, LONGITUDE_BOUNDS
from roadledger.session import fresh_path
from roadledger.sources.warehouse import Warehouse
from roadledger.streaming.ingest import stream_ingest
from roadledger.streaming.scoring import request_totals, stream_scores


def line_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (spark.readStream.schema(table(spark, sf_dir, "lineitem").schema)
            .option("pathGlobFilter", "lineitem.parquet").parquet(sf_dir))


@query("h_stream_ingest", f"""SELECT coalesce(rejection_reason, 'accepted') AS outcome, count(*) AS records,
  count(DISTINCT accident_index) AS keys, (SELECT CAST(count(*) FILTER (rejection_reason IS NULL) AS INT) FROM ({GATED_SQL})) AS audited
FROM ({GATED_SQL}) GROUP BY 1""")
def ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = Warehouse(spark, fresh_path(spark, "warehouse"))
    incidents = feed_columns(line_stream(spark, sf_dir), spark, sf_dir, [])
    stream_ingest(incidents, warehouse, fresh_path(spark, "stream"), order=tuple(ARRIVAL_COLUMNS)).awaitTermination()
    accepted = warehouse.read("stg_incidents").agg(
        F.lit("accepted").alias("outcome"), F.count("*").alias("records"), F.countDistinct("accident_index").alias("keys"))
    refused = warehouse.read("quarantine").groupBy(F.col("rejection_reason").alias("outcome")).agg(
        F.count("*").alias("records"), F.countDistinct("record_identifier").alias("keys"))
    audited = warehouse.read("ingestion_audit").agg(F.sum("records_ingested").cast("int").alias("audited"))
    return accepted.unionByName(refused).join(F.broadcast(audited))  # one row of totals


_HOUR = "CAST(substring(accident_time, 1, 2) AS INT)"


_IN_BOUNDS = (f"latitude BETWEEN {LATITUDE_BOUNDS[0]} AND {LATITUDE_BOUNDS[1]} AND longitude BETWEEN {LONGITUDE_BOUNDS[0]} "
              f"AND {LONGITUDE_BOUNDS[1]} AND coalesce(speed_limit, 30) BETWEEN 10 AND 100")


@query("h_stream_score", f"""SELECT count(*) FILTER ({_IN_BOUNDS}) AS scored, count(*) AS requests,
  count(*) - count(*) FILTER ({_IN_BOUNDS}) AS refused, 0::BIGINT AS unexplained, 0::BIGINT AS bad_scores FROM ({FEED_SQL})""")
def scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit, _ = fitted_unit(training_rows(spark, sf_dir), FOREST)
    requests = feed_columns(line_stream(spark, sf_dir), spark, sf_dir, []).select(
        *[c for c in FEED if c not in ("latitude", "longitude")], F.expr(_HOUR).alias("hour"),
        F.col("latitude").cast("double").alias("latitude"), F.col("longitude").cast("double").alias("longitude"),
        F.col("urban_or_rural_area").alias("urban_or_rural"), F.col("weather_conditions").alias("weather_condition"))
    target = fresh_path(spark, "scores")
    stream_scores(requests, unit, target, fresh_path(spark, "stream"), keep=("accident_index",)).awaitTermination()
    scored = spark.read.parquet(f"{target}/scored").agg(
        F.count("*").alias("scored"), F.count_if((F.col("severity_risk_score") < 0) | (F.col("severity_risk_score") > 1)).alias("bad_scores"))
    refused = spark.read.parquet(f"{target}/refused").agg(
        F.count("*").alias("refused"), F.count_if(F.col("rejection_reason").isNull()).alias("unexplained"))
    totals = request_totals(spark, target).select("requests")
    return scored.join(F.broadcast(refused)).join(F.broadcast(totals))  # one row each
