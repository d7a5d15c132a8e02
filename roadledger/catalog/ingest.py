"""Files, staging, weather, reports and the end-to-end job."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadledger.catalog.feed import ARRIVAL_COLUMNS, FEED, FEED_SQL, GATED_SQL, feed, star_frames
from roadledger.catalog.drift import event_report
from roadledger.catalog.features import JUDGED_SQL, judged
from roadledger.catalog.registry import query, table
from roadledger.catalog.star import VALID_SQL, as_doubles
from roadledger.catalog.gate import gated_feed
from roadledger.operators import aggregates
from roadledger.functions.weather import WMO_DESCRIPTIONS
from roadledger.plans import end_to_end, star as plan
from roadledger.plans.training import measures
from roadledger.schemas import COLLISION_FILE_COLUMNS, COLLISION_TO_STAGING, CLASS_LABELS, STG_INCIDENTS
from roadledger.session import fresh_path
from roadledger.sources import collisions, reports, weather
from roadledger.sources.warehouse import Warehouse, latest_first

STAGED = list(FEED)
STAGED_SQL = "SELECT " + ", ".join(
    f"{c}::DOUBLE AS {c}" if c in ("latitude", "longitude") else c for c in STAGED) + f" FROM ({FEED_SQL})"
_FIRST_IN_TASK = (1 << 33) - 1


def collision_files(spark: SparkSession, rows: DataFrame, leading_lines: int) -> str:
    """The feed as collision files (44 columns), each starting with the given number of extra lines."""
    source = {target: origin for origin, target in COLLISION_TO_STAGING.items()}
    named = rows.select(*[F.col(t).cast("string").alias(source[t]) for t in source])
    line = F.to_csv(F.struct(*[F.col(c) if c in named.columns else F.lit("0").alias(c) for c in COLLISION_FILE_COLUMNS]))
    lead = ["published extract", ",".join(COLLISION_FILE_COLUMNS)][-leading_lines:] if leading_lines else []
    first = F.monotonically_increasing_id().bitwiseAND(F.lit(_FIRST_IN_TASK)) == 0
    path = fresh_path(spark, "collision_files")
    named.select(F.when(first, F.concat(F.lit("".join(text + "\n" for text in lead)), line)).otherwise(line)).write.option("compression", "gzip").text(path)
    return path


def staged_columns(df: DataFrame) -> DataFrame:
    return as_doubles(df.select(*STAGED), "latitude", "longitude")


@query("a_csv_scan_skip", STAGED_SQL)
def csv_scan_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = collision_files(spark, feed(spark, sf_dir), 2)
    return staged_columns(collisions.to_staging(collisions.scan_collisions(spark, path)))


@query("a_csv_scan_header", STAGED_SQL)
def csv_scan_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = collision_files(spark, feed(spark, sf_dir), 1)
    return staged_columns(collisions.to_staging(collisions.scan_collisions(spark, path, skip_rows=1)))


def in_arrival_order(rows: DataFrame) -> DataFrame:
    """Rows spread and sorted in the feed's own order, so that files hold them as they arrived."""
    return rows.repartitionByRange(*[F.col(c) for c in ARRIVAL_COLUMNS]).sortWithinPartitions(*ARRIVAL_COLUMNS)


def ingested(spark: SparkSession, sf_dir: str, ordered: bool = False) -> tuple[Warehouse, str, str]:
    warehouse = Warehouse(spark, fresh_path(spark, "warehouse"))
    raw = fresh_path(spark, "raw")
    rows = in_arrival_order(feed(spark, sf_dir)) if ordered else feed(spark, sf_dir)
    batch_id = collisions.ingest_collisions(warehouse, collision_files(spark, rows, 2), raw)
    return warehouse, batch_id, raw


@query("a_land_and_stage", STAGED_SQL)
def land_and_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse, batch_id, _ = ingested(spark, sf_dir)
    return staged_columns(warehouse.read("stg_incidents", batch_id))


@query("a_raw_landing", f"SELECT accident_severity, count(*) AS records FROM ({FEED_SQL}) GROUP BY 1")
def raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, batch_id, raw = ingested(spark, sf_dir)
    landed = spark.read.option("header", True).csv(f"{raw}/accidents_raw_{batch_id}")
    return landed.where(F.col("batch_id") == batch_id).groupBy("accident_severity").agg(F.count("*").alias("records"))


@query("a_audit", """SELECT 'UK DfT Collision Dataset' AS source_name, 'SUCCESS' AS status,
  CAST(count(*) AS INT) AS records_ingested, CAST(0 AS INT) AS records_rejected, true AS closed FROM lineitem""")
def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse, _, _ = ingested(spark, sf_dir)
    return latest_first(warehouse.read("ingestion_audit"), "started_at").select(
        "source_name", "status", "records_ingested", "records_rejected",
        (F.col("completed_at") >= F.col("started_at")).alias("closed"))


@query("a_quarantine_sink", f"""SELECT accident_index AS record_identifier, rejection_reason, count(*) AS records FROM ({GATED_SQL})
WHERE rejection_reason IS NOT NULL GROUP BY 1, 2""")
def quarantine_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judged twice, quarantined once. Which of several records is the repeat depends on reading order, so the
    files hold the feed in its own order."""
    warehouse, batch_id, _ = ingested(spark, sf_dir, ordered=True)
    for _ in range(2):
        plan.validate_and_quarantine(warehouse, batch_id)
    held = warehouse.read("quarantine", batch_id)
    return latest_first(held, "rejected_at").groupBy("record_identifier", "rejection_reason").agg(F.count("*").alias("records"))


@query("a_init_seed", """SELECT CASE o_orderstatus WHEN 'F' THEN 'Fatal' WHEN 'O' THEN 'Serious' ELSE 'Slight' END AS severity_name,
  count(*) AS records, 0::BIGINT AS facts FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def init_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = Warehouse(spark, fresh_path(spark, "warehouse"))
    for _ in range(2):
        warehouse.init()
    empty = warehouse.read("fact_incidents").count()
    facts = star_frames(spark, sf_dir)["fact_incidents"].groupBy("severity_key").agg(F.count("*").alias("records"))
    return facts.join(warehouse.read("dim_severity"), "severity_key").select(
        "severity_name", "records", F.lit(empty).cast("bigint").alias("facts"))


@query("a_run_log", """SELECT event_type AS run_name, 'events' AS source, count(*)::DOUBLE AS records FROM events GROUP BY 1""")
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = Warehouse(spark, fresh_path(spark, "warehouse"))
    # One run per event type; types are few by definition, and all runs are one write.
    counts = aggregates.value_counts(table(spark, sf_dir, "events"), "event_type").collect()
    reports.log_runs(warehouse, [(r["event_type"], {"source": "events"}, {"records": r["records"]}, {}) for r in counts])
    return warehouse.read("experiment_runs").select(
        "run_name", F.col("params")["source"].alias("source"), F.col("metrics")["records"].alias("records"))


@query("a_report_roundtrip", """SELECT CAST(floor(count(*) * 0.70::DOUBLE) AS BIGINT) AS reference_records,
  CAST(count(*) - floor(count(*) * 0.70::DOUBLE) AS BIGINT) AS current_records FROM events""")
def report_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    report, folder = event_report(spark, sf_dir), fresh_path(spark, "reports")
    reports.save_dated(report.withColumn("reference_records", F.lit(0).cast("bigint")), folder, "drift_report", date(2024, 1, 1))
    reports.save_dated(report, folder, "drift_report", date(2024, 1, 2))
    return reports.latest_report(spark, folder, "drift_report", report.schema).select("reference_records", "current_records")


@query("a_quarantine_report", f"""SELECT count(*) AS total_evaluated, count(rejection_reason) AS quarantined_count,
  CAST(count(DISTINCT rejection_reason) AS INT) AS reasons FROM ({GATED_SQL})""")
def quarantine_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    gated, folder = gated_feed(spark, sf_dir), fresh_path(spark, "reports")
    reports.save_quarantine_summary(gated, folder)
    schema = reports.quarantine_summary(gated).schema
    return reports.latest_report(spark, folder, "quarantine_summary", schema).select(
        "total_evaluated", "quarantined_count", F.size("reasons_breakdown").alias("reasons"))


@query("a_evaluation_report", f"""SELECT 'roundtrip' AS source, CAST(round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) * 1000000) AS BIGINT) AS accuracy
FROM ({JUDGED_SQL}) UNION ALL SELECT 'defaults', 792000 UNION ALL SELECT 'support', count(*) FROM ({JUDGED_SQL})
UNION ALL SELECT 'support of ' || CASE label WHEN 0 THEN '{CLASS_LABELS[0]}' WHEN 1 THEN '{CLASS_LABELS[1]}' ELSE '{CLASS_LABELS[2]}' END, count(*)
FROM ({JUDGED_SQL}) GROUP BY label""")
def evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = measures(judged(spark, sf_dir), "label", "prediction")
    report = reports.evaluation_report(parts["report"], parts["averages"], CLASS_LABELS, "Forest")
    folder = fresh_path(spark, "reports")
    reports.save_dated(report, folder, "test_evaluation_report")
    back = reports.latest_report(spark, folder, "test_evaluation_report", report.schema)
    figures = reports.headline_figures(back).select(F.lit("roundtrip").alias("source"), "overall_accuracy")
    defaults = reports.headline_figures(back.select("champion_model")).select(F.lit("defaults").alias("source"), "overall_accuracy")
    shares = figures.unionByName(defaults).select("source", F.round(F.col("overall_accuracy") * F.lit(1000000.0)).cast("bigint").alias("accuracy"))
    supports = {"support": F.col("`macro avg`.support"), **{f"support of {n}": F.col(f"`{n}`.support") for n in CLASS_LABELS}}
    return reduce(DataFrame.unionByName, [back.select(F.lit(n).alias("source"), c.cast("bigint").alias("accuracy"))
                                          for n, c in supports.items()], shares)


# One payload per user and day, with one entry per hour that has events (at most 24).
_PER_SQL = """SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, hour(ts) AS h, count(*) AS n,
  count(*) FILTER (event_type = 'view') AS v, count(*) FILTER (event_type = 'error') AS e, count(*) FILTER (event_type = 'purchase') AS bought,
  max(CAST(json_extract_string(props, '$.k') AS INT)) AS code FROM events GROUP BY 1, 2, 3"""
_DESCRIBED = f"""CASE weather_code {" ".join(f"WHEN {c} THEN '{t}'" for c, t in WMO_DESCRIPTIONS.items())} ELSE 'Clear / Normal' END"""
_HOURLY_SQL = f"""SELECT user_id, day, day || 'T' || lpad(CAST(h AS VARCHAR), 2, '0') || ':00' AS weather_timestamp, n::DOUBLE AS temperature_2m,
  CASE WHEN e = 0 THEN v::DOUBLE END AS precipitation, CASE WHEN i <= 2 THEN n::DOUBLE ELSE 15.0 END AS wind_speed_10m,
  CASE WHEN i <= 3 THEN v * 100::DOUBLE ELSE 10000.0 END AS visibility, CASE WHEN i <= 4 THEN code ELSE 0 END AS weather_code
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY h) AS i FROM ({_PER_SQL}))"""


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, day, bought, payload): arrays after the first two end early, precipitation has nulls."""
    events = table(spark, sf_dir, "events")
    per = events.groupBy("user_id", F.to_date("ts").cast("string").alias("day"), F.hour("ts").alias("h")).agg(
        F.count("*").alias("n"), F.count_if(F.col("event_type") == "view").alias("v"),
        F.count_if(F.col("event_type") == "error").alias("e"), F.count_if(F.col("event_type") == "purchase").alias("bought"),
        F.max(F.from_json("props", "k int")["k"]).alias("code"))
    days = per.groupBy("user_id", "day").agg(
        F.array_sort(F.collect_list(F.struct("h", "n", "v", "e", "code"))).alias("hours"), F.sum("bought").alias("bought"))

    def each(f):
        return F.transform("hours", f)

    hourly = F.struct(
        each(lambda x: F.format_string("%sT%02d:00", F.col("day"), x["h"])).alias("time"),
        each(lambda x: x["n"].cast("double")).alias("temperature_2m"),
        each(lambda x: F.when(x["e"] == 0, x["v"].cast("double"))).alias("precipitation"),
        F.slice(each(lambda x: x["n"].cast("double")), 1, 2).alias("wind_speed_10m"),
        F.slice(each(lambda x: x["v"] * F.lit(100.0)), 1, 3).alias("visibility"),
        F.slice(each(lambda x: x["code"]), 1, 4).alias("weather_code"))
    return days.select("user_id", "day", "bought", F.to_json(F.struct(hourly.alias("hourly")), {"ignoreNullFields": "false"}).alias("payload"))


@query("a_hourly_payload", f"SELECT *, {_DESCRIBED} AS weather_description FROM ({_HOURLY_SQL})")
def hourly_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather.hourly_rows(payloads(spark, sf_dir), keep=("user_id", "day"))


@query("a_fallback_series", """SELECT s_suppkey, '2024-05-01T' || lpad(CAST(h AS VARCHAR), 2, '0') || ':00' AS weather_timestamp,
  11.5::DOUBLE AS temperature_2m, 0.2::DOUBLE AS precipitation, 14.0::DOUBLE AS wind_speed_10m, 9500.0::DOUBLE AS visibility,
  1::INT AS weather_code, 'Mainly clear' AS weather_description FROM supplier CROSS JOIN (SELECT unnest(range(24)) AS h)""")
def fallback_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = table(spark, sf_dir, "supplier").select("s_suppkey", F.lit("2024-05-01").alias("accident_date"))
    return weather.fallback_rows(sites, keep=("s_suppkey",))


@query("g_concat_weather", f"""WITH h AS ({_HOURLY_SQL}), s AS (SELECT user_id, day, sum(bought) AS bought FROM ({_PER_SQL}) GROUP BY 1, 2)
SELECT CAST(50 + user_id / 100.0 AS DOUBLE) AS latitude, -1.5::DOUBLE AS longitude, weather_timestamp, temperature_2m, precipitation,
  weather_code, {_DESCRIBED} AS weather_description FROM h JOIN s USING (user_id, day) WHERE bought > 0
UNION ALL SELECT CAST(50 + user_id / 100.0 AS DOUBLE), -1.5, day || 'T' || lpad(CAST(k AS VARCHAR), 2, '0') || ':00', 11.5, 0.2, 1, 'Mainly clear'
FROM s CROSS JOIN (SELECT unnest(range(24)) AS k) WHERE bought = 0""")
def concat_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = payloads(spark, sf_dir).selectExpr(
        "CAST(50 + user_id / CAST(100 AS DOUBLE) AS DECIMAL(10, 2)) AS lat", "CAST(-1.5 AS DECIMAL(10, 2)) AS lon",
        "day AS accident_date", "CASE WHEN bought > 0 THEN payload END AS payload")
    rows = weather.site_weather(made.select("lat", "lon", "accident_date"), made.where("payload IS NOT NULL"))
    return rows.select("latitude", "longitude", "weather_timestamp", "temperature_2m", "precipitation", "weather_code", "weather_description")


def staged_warehouse(spark: SparkSession, sf_dir: str) -> tuple[Warehouse, str]:
    warehouse = Warehouse(spark, fresh_path(spark, "warehouse"))
    warehouse.init()
    warehouse.put_batch("stg_incidents", collisions.tagged(feed(spark, sf_dir).select(*STAGED), "batch_acc_feed"), "batch_acc_feed")
    return warehouse, "batch_acc_feed"


@query("a_weather_ingest", f"""SELECT lat::DOUBLE AS latitude, lon::DOUBLE AS longitude, count(*) * 24 AS readings,
  count(DISTINCT day) AS days, 11.5::DOUBLE AS temperature FROM (SELECT DISTINCT round(latitude, 2) AS lat, round(longitude, 2) AS lon,
  substring(accident_date, 1, 10) AS day FROM ({FEED_SQL}) WHERE latitude IS NOT NULL AND accident_date IS NOT NULL) GROUP BY 1, 2""")
def weather_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No payload has landed for any site, so each site and day gets the fallback series."""
    warehouse, batch_id = staged_warehouse(spark, sf_dir)
    none = spark.createDataFrame([], "lat decimal(10,2), lon decimal(10,2), accident_date string, payload string")
    raw = fresh_path(spark, "raw")
    made = weather.ingest_weather(warehouse, none, batch_id, raw)
    staged = warehouse.read("stg_weather", made)
    layout = "latitude double, longitude double, weather_timestamp string"  # named, so that no pass looks for it
    days = spark.read.schema(layout).json(f"{raw}/weather_raw_{made}").select(
        F.col("latitude"), F.col("longitude"), F.regexp_extract("weather_timestamp", "^(.*)T", 1).alias("day")).distinct()
    per_site = days.groupBy("latitude", "longitude").agg(F.count("*").alias("days"))
    readings = staged.groupBy(F.col("latitude").cast("double").alias("latitude"), F.col("longitude").cast("double").alias("longitude")).agg(
        F.count("*").alias("readings"), F.avg("temperature_2m").cast("double").alias("temperature"))
    return readings.join(per_site, ["latitude", "longitude"])


@query("p_end_to_end", f"""WITH valid AS ({VALID_SQL}), g AS ({GATED_SQL}) SELECT (SELECT count(*) FROM g) AS total, (SELECT count(*) FROM valid) AS valid,
  (SELECT count(*) FROM valid) AS facts, (SELECT count(DISTINCT (latitude, longitude, urban_or_rural_area, local_authority)) FROM valid) AS locations,
  (SELECT count(DISTINCT weather_conditions) FROM valid) AS conditions, (SELECT count(*) FROM valid) AS mart_records,
  (SELECT CAST(floor(count(*) * 0.70::DOUBLE) AS BIGINT) FROM valid) AS reference_records, true AS weather_staged""")
def whole_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File -> warehouse -> marts -> drift, judged by its counts. The feed's own arrival order decides
    which of several records is first, so the rows are numbered in that order before they are written."""
    files = collision_files(spark, in_arrival_order(feed(spark, sf_dir)), 2)
    config = end_to_end.JobConfig(fresh_path(spark, "warehouse"), files, fresh_path(spark, "raw"), fresh_path(spark, "reports"))
    none = spark.createDataFrame([], "lat decimal(10,2), lon decimal(10,2), accident_date string, payload string")
    result = end_to_end.run_job(spark, config, none)
    warehouse = Warehouse(spark, config.warehouse_root)
    facts = warehouse.read("fact_incidents").agg(F.count("*").alias("facts"))
    counted = facts
    for name, frame in (
            ("locations", warehouse.read("dim_location").agg(F.count("*").alias("locations"))),
            ("conditions", warehouse.read("dim_weather").agg(F.count("*").alias("conditions"))),
            ("mart_records", warehouse.read_mart("agg_location_hotspots_mart").agg(F.sum("accident_count").alias("mart_records"))),
            ("weather_staged", warehouse.read("stg_weather", result.weather_batch_id).agg((F.count("*") > 0).alias("weather_staged")))):
        counted = counted.join(F.broadcast(frame))  # one row each
    return counted.join(F.broadcast(result.drift.select("reference_records"))).select(
        F.lit(result.counts["total"]).cast("bigint").alias("total"), F.lit(result.counts["valid"]).cast("bigint").alias("valid"),
        "facts", "locations", "conditions", "mart_records", "reference_records", "weather_staged")
