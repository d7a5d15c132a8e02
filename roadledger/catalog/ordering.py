"""Order-dependent operators and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadledger.catalog.registry import file_of, query, table
from roadledger.functions import calendar
from roadledger.operators import aggregates, dedup, ordering
from roadledger.plans.drift_job import reference_and_current
from roadledger.plans.training import split_star
from roadledger.catalog.feed import STAR_SQL, star_frames
from roadledger.plans.star import TRAINING_COLUMNS, star, summed_star
from roadledger.sources.warehouse import latest_first

LINE_ORDER = ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey"]
LINE_REST = "l_shipdate, l_extendedprice, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus"


@query("f_keep_first", f"""SELECT l_orderkey, l_linenumber, {LINE_REST} FROM (SELECT *, row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(LINE_ORDER)}) AS rn FROM lineitem) WHERE rn = 1""")
def keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    lines = lines.select("*", file_of(lines).alias("file"), F.col("_metadata.row_index").alias("row"))
    return dedup.keep_first_by_id(lines, ["l_orderkey", "l_linenumber"], LINE_ORDER, ["file", "row"]).drop("file", "row")


@query("f_row_number", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS row_number FROM orders")
def row_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.number_rows(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"),
                                [F.col("o_totalprice"), F.col("o_orderkey")]).select("o_orderkey", "row_number")


@query("f_chrono_split", """SELECT event_id, ts, CASE WHEN rn < floor(n * 0.70::DOUBLE) THEN 'train'
  WHEN rn < floor(n * (0.70::DOUBLE + 0.15::DOUBLE)) THEN 'val' ELSE 'test' END AS split
FROM (SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) - 1 AS rn, count(*) OVER () AS n FROM events)""")
def chrono_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.chronological_split(table(spark, sf_dir, "events").select("event_id", "ts"),
                                        [F.col("ts"), F.col("event_id")], [0.70, 0.70 + 0.15],
                                        ["train", "val", "test"])


@query("f_split_star", f"""WITH {STAR_SQL}, s AS (SELECT f.accident_index, d.full_date, d.hour, f.severity_key,
  f.number_of_vehicles, f.number_of_casualties, f.location_key, f.road_key
  FROM fact_incidents f JOIN dim_date d USING (date_key) JOIN dim_location USING (location_key)
  JOIN dim_road USING (road_key) JOIN dim_weather USING (weather_key) JOIN dim_severity USING (severity_key)),
r AS (SELECT *, row_number() OVER (ORDER BY full_date, hour, accident_index) - 1 AS rn, count(*) OVER () AS n FROM s)
SELECT CASE WHEN rn < floor(n * 0.70::DOUBLE) THEN 'train' WHEN rn < floor(n * (0.70::DOUBLE + 0.15::DOUBLE)) THEN 'val'
  ELSE 'test' END AS split, count(*) AS records, min(full_date) AS first_date, max(full_date) AS last_date FROM r GROUP BY 1""")
def split_of_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = split_star(star(star_frames(spark, sf_dir), TRAINING_COLUMNS))
    return parts.groupBy("split").agg(F.count("*").alias("records"), F.min("full_date").alias("first_date"),
                                      F.max("full_date").alias("last_date"))


@query("f_ref_current", """SELECT split, count(*) AS records, min(o_orderdate) AS first_day, max(o_orderdate) AS last_day,
  sum(o_orderkey)::BIGINT AS keys FROM (SELECT *, CASE WHEN rn < floor(n * 0.70::DOUBLE) THEN 'reference' ELSE 'current' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS rn, count(*) OVER () AS n FROM orders)) GROUP BY split""")
def ref_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = reference_and_current(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"),
                                  day="o_orderdate", key="o_orderkey")
    return parts.groupBy("split").agg(
        F.count("*").alias("records"), F.min("o_orderdate").alias("first_day"), F.max("o_orderdate").alias("last_day"),
        F.sum("o_orderkey").alias("keys"))


AUTHORITY_SQL = f"""WITH {STAR_SQL} SELECT local_authority, count(latitude) AS total_accidents,
  count(*) FILTER (severity_name = 'Fatal') AS fatalities, count(*) FILTER (severity_name = 'Serious') AS serious,
  sum(number_of_casualties)::BIGINT AS total_casualties
FROM fact_incidents JOIN dim_location USING (location_key) JOIN dim_severity USING (severity_key) GROUP BY local_authority"""


def located(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summed_star(star_frames(spark, sf_dir), {
        "dim_location": ["latitude", "local_authority"], "dim_severity": ["severity_name"]}, sums=["number_of_casualties"])


@query("f_top_authorities", f"{AUTHORITY_SQL} ORDER BY total_accidents DESC, local_authority LIMIT 8")
def top_authorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.authority_ranking(located(spark, sf_dir), "local_authority", "latitude", top=8, weight="records")


@query("e_authority_rank", AUTHORITY_SQL)
def authority_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.authority_ranking(located(spark, sf_dir), "local_authority", "latitude", weight="records")


@query("f_champion", """SELECT event_type AS run_name, records FROM (SELECT event_type, count(*) AS records FROM events GROUP BY 1)
ORDER BY records DESC, event_type LIMIT 1""")
def champion(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("run_name")).agg(F.count("*").alias("records"))
    return aggregates.best_row(runs, "records", "run_name")


@query("f_listings", """SELECT o_orderkey, o_orderdate, dayname(o_orderdate) AS day_name,
  CAST(isodow(o_orderdate) AS INT) AS day_order FROM orders ORDER BY o_orderdate DESC, o_orderkey""")
def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = calendar.day_name(F.col("o_orderdate"))
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", day.alias("day_name"), calendar.rank_in(calendar.DAY_NAMES, day).alias("day_order"))
    return latest_first(rows, "o_orderdate", ["o_orderkey"])


@query("e_quantiles", """SELECT 'l_quantity' AS feature, CAST(round(quantile_cont(l_quantity, 0.1) * 10000) AS BIGINT) AS d1,
  CAST(round(quantile_cont(l_quantity, 0.5) * 10000) AS BIGINT) AS median, CAST(round(quantile_cont(l_quantity, 0.9) * 10000) AS BIGINT) AS d9 FROM lineitem
UNION ALL SELECT 'l_extendedprice', CAST(round(quantile_cont(l_extendedprice, 0.1) * 10000) AS BIGINT),
  CAST(round(quantile_cont(l_extendedprice, 0.5) * 10000) AS BIGINT), CAST(round(quantile_cont(l_extendedprice, 0.9) * 10000) AS BIGINT) FROM lineitem
UNION ALL SELECT 'l_tax', CAST(round(quantile_cont(l_tax, 0.1) * 10000) AS BIGINT),
  CAST(round(quantile_cont(l_tax, 0.5) * 10000) AS BIGINT), CAST(round(quantile_cont(l_tax, 0.9) * 10000) AS BIGINT) FROM lineitem""")
def quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ordering.exact_quantiles(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"], [0.1, 0.5, 0.9])
    return found.select("feature", *[
        F.round(F.col("quantiles")[i] * F.lit(10000.0)).cast("bigint").alias(n) for i, n in enumerate(["d1", "median", "d9"])])
