"""Marts and dashboard summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadledger.catalog.feed import STAR_SQL, star_frames
from roadledger.catalog.registry import query, table
from roadledger.functions import calendar
from roadledger.operators import aggregates
from roadledger.plans.star import pair_counts, star, summed_star

# Each page joins only the dimensions it needs, to facts added up by their keys.
_ALL = """FROM fact_incidents JOIN dim_date USING (date_key) JOIN dim_location USING (location_key)
JOIN dim_road USING (road_key) JOIN dim_weather USING (weather_key) JOIN dim_severity USING (severity_key)"""


@query("e_hourly_events", """SELECT dayname(ts) AS day_name, CAST(isodow(ts) - 1 AS INT) AS day_of_week, CAST(hour(ts) AS INT) AS hour,
  CASE WHEN hour(ts) >= 6 AND hour(ts) < 10 THEN 'Morning Rush' WHEN hour(ts) >= 10 AND hour(ts) < 16 THEN 'Midday'
    WHEN hour(ts) >= 16 AND hour(ts) < 20 THEN 'Evening Rush' ELSE 'Night' END AS time_of_day, event_type,
  count(*) AS records, sum(CAST(round(value * 100) AS BIGINT))::BIGINT AS total_cents FROM events GROUP BY ALL""")
def hourly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = calendar.calendar_columns(F.col("ts"))
    names = ["day_name", "day_of_week", "hour", "time_of_day"]
    return (table(spark, sf_dir, "events").groupBy(*[parts[n].alias(n) for n in names], "event_type")
            .agg(F.count("*").alias("records"),
                 F.sum(F.round(F.col("value") * F.lit(100.0)).cast("bigint")).alias("total_cents")))


@query("e_hourly_mart", f"""WITH {STAR_SQL} SELECT day_name, day_of_week, hour, time_of_day, severity_name, count(*) AS accident_count,
  sum(number_of_casualties)::BIGINT AS total_casualties, sum(number_of_vehicles)::BIGINT AS total_vehicles
FROM fact_incidents JOIN dim_date USING (date_key) JOIN dim_severity USING (severity_key) GROUP BY ALL""")
def hourly_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = star_frames(spark, sf_dir)
    return aggregates.hourly_severity_mart(t["fact_incidents"], t["dim_date"], t["dim_severity"])


@query("e_risk_mart", f"""WITH {STAR_SQL} SELECT * EXCLUDE (n), ((total_casualties * 200 + n) // (2 * n))::DOUBLE / 100 AS avg_casualties_per_accident
FROM (SELECT weather_condition, weather_risk_level, road_type, road_surface_conditions, speed_limit, severity_name,
  count(*) AS accident_count, sum(number_of_casualties)::BIGINT AS total_casualties, count(*) AS n
  FROM fact_incidents JOIN dim_weather USING (weather_key) JOIN dim_road USING (road_key) JOIN dim_severity USING (severity_key) GROUP BY ALL)""")
def risk_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = star_frames(spark, sf_dir)
    return aggregates.weather_road_mart(t["fact_incidents"], t["dim_weather"], t["dim_road"], t["dim_severity"])


@query("e_hotspots", f"""WITH {STAR_SQL} SELECT round(latitude, 3)::DOUBLE AS lat_binned, round(longitude, 3)::DOUBLE AS lon_binned,
  local_authority, urban_or_rural, count(*) AS accident_count, count(*) FILTER (severity_name = 'Fatal') AS fatal_count,
  count(*) FILTER (severity_name = 'Serious') AS serious_count, count(*) FILTER (severity_name = 'Slight') AS slight_count,
  sum(number_of_casualties)::BIGINT AS total_casualties
FROM fact_incidents JOIN dim_location USING (location_key) JOIN dim_severity USING (severity_key) GROUP BY 1, 2, 3, 4 HAVING count(*) >= 1""")
def hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = star_frames(spark, sf_dir)
    mart = aggregates.hotspot_mart(t["fact_incidents"], t["dim_location"], t["dim_severity"])
    return mart.withColumns({c: F.col(c).cast("double") for c in ("lat_binned", "lon_binned")})


@query("e_kpis", f"""WITH {STAR_SQL} SELECT count(*) AS total_accidents, count(*) FILTER (severity_name = 'Fatal') AS fatal_count,
  count(*) FILTER (severity_name = 'Serious') AS serious_count, count(*) FILTER (severity_name = 'Slight') AS slight_count,
  sum(number_of_casualties)::BIGINT AS total_casualties, round_even(avg(number_of_vehicles), 2) AS avg_vehicles
FROM fact_incidents JOIN dim_severity USING (severity_key)""")
def kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.kpis(star(star_frames(spark, sf_dir), {"dim_severity": ["severity_name"]}))


@query("e_value_counts", f"""WITH {STAR_SQL} SELECT severity_name, count(*) AS records FROM fact_incidents
JOIN dim_severity USING (severity_key) GROUP BY 1""")
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = summed_star(star_frames(spark, sf_dir), {"dim_severity": ["severity_name"]})
    return aggregates.value_counts(rows, "severity_name", weight="records")


_PAIRS = [("urban_or_rural", "severity_name"), ("time_of_day", "severity_name"), ("weather_condition", "severity_name"),
          ("road_surface_conditions", "severity_name"), ("light_conditions", "severity_name"),
          ("number_of_vehicles", "severity_name"), ("number_of_casualties", "severity_name"),
          ("road_type", "number_of_vehicles")]


@query("e_cross_counts", f"WITH {STAR_SQL}, s AS (SELECT * {_ALL}) " + " UNION ALL ".join(
    f"SELECT '{a}' AS first_name, '{b}' AS second_name, CAST({a} AS VARCHAR) AS first_value, "
    f"CAST({b} AS VARCHAR) AS second_value, count(*) AS records FROM s WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 3, 4"
    for a, b in _PAIRS))
def cross_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_counts(star_frames(spark, sf_dir), _PAIRS)


@query("e_area_severity", f"""WITH {STAR_SQL} SELECT urban_or_rural, severity_name, count(*) AS records FROM fact_incidents
JOIN dim_location USING (location_key) JOIN dim_severity USING (severity_key) GROUP BY 1, 2""")
def area_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = summed_star(star_frames(spark, sf_dir), {"dim_location": ["urban_or_rural"], "dim_severity": ["severity_name"]})
    return aggregates.cross_counts(rows, "urban_or_rural", "severity_name", weight="records")


@query("e_weekend_sums", f"""WITH {STAR_SQL} SELECT CASE WHEN is_weekend THEN 'Weekend (Sat-Sun)' ELSE 'Weekday (Mon-Fri)' END AS weekend_label,
  severity_name, sum(number_of_casualties)::BIGINT AS casualties FROM fact_incidents JOIN dim_date USING (date_key)
  JOIN dim_severity USING (severity_key) GROUP BY 1, 2""")
def weekend_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = summed_star(star_frames(spark, sf_dir), {"dim_date": ["is_weekend"], "dim_severity": ["severity_name"]},
                       sums=["number_of_casualties"])
    return aggregates.weekend_sums(rows, "is_weekend", "severity_name", "number_of_casualties", "casualties")


@query("e_pivot_day_hour", "SELECT d.day_name, CAST(d.day_order AS INT) AS day_order, " + ", ".join(
    f"count(value) FILTER (h = {h}) AS h{h:02d}" for h in range(24)) + """ FROM (VALUES ('Monday', 1), ('Tuesday', 2),
  ('Wednesday', 3), ('Thursday', 4), ('Friday', 5), ('Saturday', 6), ('Sunday', 7)) AS d(day_name, day_order)
LEFT JOIN (SELECT dayname(ts) AS day_name, hour(ts) AS h, CASE WHEN event_type <> 'error' THEN value END AS value FROM events) e
  ON d.day_name = e.day_name GROUP BY 1, 2""")
def pivot_day_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        calendar.day_name(F.col("ts")).alias("day_name"), F.hour("ts").alias("hour"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"))
    return aggregates.day_hour_pivot(rows, "day_name", "hour", "value")


@query("e_share_by_limit", f"""WITH {STAR_SQL}, s AS (SELECT speed_limit, count(*) FILTER (severity_name = 'Fatal') / count(*) * 100 AS fatal_pct,
  count(*) FILTER (severity_name = 'Serious') / count(*) * 100 AS serious_pct
  FROM fact_incidents JOIN dim_road USING (road_key) JOIN dim_severity USING (severity_key) GROUP BY 1)
SELECT speed_limit, 'fatal_pct' AS variable, CAST(round(fatal_pct * 1000000) AS BIGINT) AS value FROM s
UNION ALL SELECT speed_limit, 'serious_pct', CAST(round(serious_pct * 1000000) AS BIGINT) FROM s""")
def share_by_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = summed_star(star_frames(spark, sf_dir), {"dim_road": ["speed_limit"], "dim_severity": ["severity_name"]})
    shares = aggregates.share_by(rows, "speed_limit", "severity_name", ["Fatal", "Serious"], weight="records")
    tall = aggregates.melted(shares, "speed_limit", ["fatal_pct", "serious_pct"])
    return tall.withColumn("value", F.round(F.col("value") * F.lit(1000000.0)).cast("bigint"))


@query("e_rollup", f"""WITH {STAR_SQL}, s AS (SELECT road_type, number_of_vehicles FROM fact_incidents JOIN dim_road USING (road_key))
SELECT road_type, number_of_vehicles, CAST(2 AS INT) AS level, count(*) AS records FROM s GROUP BY 1, 2
UNION ALL SELECT road_type, NULL, 1, count(*) FROM s GROUP BY 1""")
def rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = summed_star(star_frames(spark, sf_dir), {"dim_road": ["road_type"]}, by=["number_of_vehicles"])
    return aggregates.hierarchy_counts(rows, "road_type", "number_of_vehicles", weight="records")


@query("e_centroid", f"""WITH {STAR_SQL} SELECT CAST(round(coalesce(avg(latitude::DOUBLE), 52.5) * 1000000) AS BIGINT) AS mid_latitude,
  CAST(round(coalesce(avg(longitude::DOUBLE), -1.5) * 1000000) AS BIGINT) AS mid_longitude
FROM fact_incidents JOIN dim_location USING (location_key) JOIN dim_severity USING (severity_key) WHERE severity_name IN ('Fatal', 'Serious')""")
def centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadledger.operators.gate import in_any

    rows = summed_star(star_frames(spark, sf_dir), {"dim_location": ["latitude", "longitude"], "dim_severity": ["severity_name"]})
    mid = aggregates.centroid(in_any(rows, severity_name=["Fatal", "Serious"]).withColumns(
        {c: F.col(c).cast("double") for c in ("latitude", "longitude")}), weight="records")
    return mid.select(*[F.round(F.col(c) * F.lit(1000000.0)).cast("bigint").alias(c) for c in mid.columns])


_TO_M = "(pi() / 180.0::DOUBLE * 6371008.8::DOUBLE)"


@query("e_hex_density", f"""WITH {STAR_SQL}, xy AS (SELECT longitude::DOUBLE * ({_TO_M} * cos(radians(55.0::DOUBLE))) AS x, latitude::DOUBLE * {_TO_M} AS y
  FROM fact_incidents JOIN dim_location USING (location_key)),
f AS (SELECT (x * (sqrt(3.0::DOUBLE) / 3) - y / 3) / 5000 AS q, y * (2.0::DOUBLE / 3) / 5000 AS r FROM xy),
c AS (SELECT q, r, -q - r AS s, round_even(q, 0) AS rq, round_even(r, 0) AS rr, round_even(-q - r, 0) AS rs FROM f),
d AS (SELECT *, abs(rq - q) AS dq, abs(rr - r) AS dr, abs(rs - s) AS ds FROM c)
SELECT CAST(CASE WHEN dq > dr AND dq > ds THEN -rr - rs ELSE rq END AS INT) AS hex_q,
  CAST(CASE WHEN dq > dr AND dq > ds THEN rr WHEN dr > ds THEN -rq - rs ELSE rr END AS INT) AS hex_r, count(*) AS records FROM d GROUP BY 1, 2""")
def hex_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = summed_star(star_frames(spark, sf_dir), {"dim_location": ["latitude", "longitude"]})
    return aggregates.hex_density(rows, weight="records")


@query("e_class_share", """SELECT split, event_type, n AS records, round_even(n / sum(n) OVER (PARTITION BY split), 4) AS share FROM (
  SELECT CASE WHEN day(ts) <= 20 THEN 'reference' ELSE 'current' END AS split, event_type, count(*) AS n FROM events GROUP BY 1, 2)""")
def class_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        F.when(F.dayofmonth("ts") <= 20, "reference").otherwise("current").alias("split"), "event_type")
    return aggregates.class_shares(rows, "split", "event_type")


@query("e_class_weights", """SELECT o_orderstatus, n AS records, CAST(round(sum(n) OVER () / (count(*) OVER () * n) * 1000000) AS BIGINT) AS class_weight
FROM (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1)""")
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = aggregates.class_weights(table(spark, sf_dir, "orders"), "o_orderstatus")
    return weights.withColumn("class_weight", F.round(F.col("class_weight") * F.lit(1000000.0)).cast("bigint"))


@query("e_distinct_values", f"""WITH {STAR_SQL} SELECT DISTINCT 'urban_or_rural' AS slicer, urban_or_rural AS choice
FROM fact_incidents JOIN dim_location USING (location_key)
UNION ALL SELECT DISTINCT 'severity_name', severity_name FROM fact_incidents JOIN dim_severity USING (severity_key)""")
def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = star_frames(spark, sf_dir)
    areas = summed_star(t, {"dim_location": ["urban_or_rural"]})
    severities = summed_star(t, {"dim_severity": ["severity_name"]})
    return (areas.select(F.lit("urban_or_rural").alias("slicer"), F.col("urban_or_rural").alias("choice")).distinct()
            .unionByName(severities.select(F.lit("severity_name").alias("slicer"), F.col("severity_name").alias("choice")).distinct())
            .orderBy("slicer", "choice"))


@query("e_guards", """SELECT (SELECT count(*) >= 50 FROM events) AS can_train, (SELECT count(*) >= 40 FROM lineitem) AS can_judge_drift,
  (SELECT count(*) >= 50 FROM region) AS regions_can_train""")
def guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = {name: aggregates.at_least(table(spark, sf_dir, source), n) for name, source, n in (
        ("can_train", "events", 50), ("can_judge_drift", "lineitem", 40), ("regions_can_train", "region", 50))}
    return spark.range(1).select(*[F.lit(v).alias(n) for n, v in answers.items()])
