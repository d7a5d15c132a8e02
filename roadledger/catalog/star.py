"""Dimensions, facts, star joins and constraint checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadledger.catalog.feed import (ARRIVAL_COLUMNS, GATED_SQL, PARSED_SQL, STAR_SQL, calendar_sql, date_key_sql, feed,
                                     inferred_list_sql, star_frames)
from roadledger.catalog.gate import gated_feed
from roadledger.catalog.registry import query, table
from roadledger.operators import dedup, joins, skipping
from roadledger.operators.gate import passed
from roadledger.plans import star as plan
from roadledger.session import fresh_path, written
from roadledger.sources.warehouse import Warehouse

VALID_SQL = f"SELECT *, {PARSED_SQL} AS dt FROM ({GATED_SQL}) WHERE rejection_reason IS NULL"
LOCATION_SQL = """SELECT *, row_number() OVER (ORDER BY latitude NULLS FIRST, longitude NULLS FIRST, urban_or_rural NULLS FIRST,
  local_authority NULLS FIRST) AS location_key FROM (SELECT DISTINCT latitude, longitude,
  urban_or_rural_area AS urban_or_rural, local_authority, 'UK Region' AS region FROM valid)"""
ROAD_SQL = """SELECT *, row_number() OVER (ORDER BY road_type NULLS FIRST, speed_limit NULLS FIRST, light_conditions NULLS FIRST,
  road_surface_conditions NULLS FIRST) AS road_key FROM (SELECT DISTINCT road_type, speed_limit, light_conditions,
  road_surface_conditions FROM valid)"""
WEATHER_SQL = f"""SELECT row_number() OVER (ORDER BY weather_condition NULLS FIRST) AS weather_key, weather_condition,
  {inferred_list_sql('weather_condition')} FROM (SELECT DISTINCT weather_conditions AS weather_condition FROM valid)"""


def as_doubles(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.prepared(passed(gated_feed(spark, sf_dir)))


@query("p_dim_date", f"SELECT DISTINCT {calendar_sql('dt')} FROM ({VALID_SQL})")
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.date_rows(incidents(spark, sf_dir))


@query("p_dim_location", f"""WITH valid AS ({VALID_SQL}) SELECT * REPLACE (latitude::DOUBLE AS latitude,
  longitude::DOUBLE AS longitude) FROM ({LOCATION_SQL})""")
def dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = plan.location_rows(incidents(spark, sf_dir))
    return as_doubles(plan.with_keys(rows, "location_key", plan.LOCATION_KEY_COLUMNS), "latitude", "longitude")


@query("p_dim_road", f"WITH valid AS ({VALID_SQL}) {ROAD_SQL}")
def dim_road(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.with_keys(plan.road_rows(incidents(spark, sf_dir)), "road_key", plan.ROAD_KEY_COLUMNS)


@query("p_dim_weather", f"WITH valid AS ({VALID_SQL}) {WEATHER_SQL}")
def dim_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.with_keys(plan.weather_rows(incidents(spark, sf_dir)), "weather_key", ["weather_condition"])


FACT_SQL = f"""WITH valid AS ({VALID_SQL}), loc AS ({LOCATION_SQL}), road AS ({ROAD_SQL}), wea AS ({WEATHER_SQL}),
place AS (SELECT latitude, longitude, min(location_key) AS location_key FROM loc GROUP BY ALL)
SELECT accident_index, {date_key_sql('dt')} AS date_key, coalesce(location_key, 1) AS location_key,
  coalesce(road_key, 1) AS road_key, coalesce(weather_key, 1) AS weather_key,
  CAST(CASE accident_severity WHEN 'Fatal' THEN 1 WHEN '2' THEN 2 ELSE 3 END AS INT) AS severity_key,
  number_of_vehicles, number_of_casualties
FROM valid v LEFT JOIN place USING (latitude, longitude)
LEFT JOIN road r ON v.road_type IS NOT DISTINCT FROM r.road_type AND v.speed_limit IS NOT DISTINCT FROM r.speed_limit
  AND v.light_conditions IS NOT DISTINCT FROM r.light_conditions
  AND v.road_surface_conditions IS NOT DISTINCT FROM r.road_surface_conditions
LEFT JOIN wea w ON v.weather_conditions IS NOT DISTINCT FROM w.weather_condition"""


@query("p_fact", FACT_SQL)
def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = written(incidents(spark, sf_dir), "valid")
    keyed = plan.with_dimension_keys(
        valid, plan.with_keys(plan.location_rows(valid), "location_key", plan.LOCATION_KEY_COLUMNS),
        plan.with_keys(plan.road_rows(valid), "road_key", plan.ROAD_KEY_COLUMNS),
        plan.with_keys(plan.weather_rows(valid), "weather_key", ["weather_condition"]))
    return plan.fact_rows(keyed, tuple(ARRIVAL_COLUMNS))


_HOURLY_SQL = """SELECT dayname(dt) AS day_name, CAST(isodow(dt) - 1 AS INT) AS day_of_week, CAST(hour(dt) AS INT) AS hour,
  CASE WHEN hour(dt) >= 6 AND hour(dt) < 10 THEN 'Morning Rush' WHEN hour(dt) >= 10 AND hour(dt) < 16 THEN 'Midday'
    WHEN hour(dt) >= 16 AND hour(dt) < 20 THEN 'Evening Rush' ELSE 'Night' END AS time_of_day,
  CASE accident_severity WHEN 'Fatal' THEN 'Fatal' WHEN '2' THEN 'Serious' ELSE 'Slight' END AS severity_name,
  count(*) AS accident_count, sum(number_of_casualties)::BIGINT AS total_casualties, sum(number_of_vehicles)::BIGINT AS total_vehicles
FROM valid GROUP BY ALL"""
MART_SQL = f"WITH valid AS ({VALID_SQL}) {_HOURLY_SQL}"


def loaded_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse below the work folder, loaded twice with the feed: the second load adds nothing."""
    warehouse = Warehouse(spark, fresh_path(spark, "warehouse"))
    warehouse.init()
    valid = written(passed(gated_feed(spark, sf_dir)).withColumns(
        {"batch_id": F.lit("feed"), "arrival": F.col("source_row")}), "valid")
    for _ in range(2):
        plan.load_star(warehouse, valid, unique=True)
    return warehouse


@query("p_mart_refresh", MART_SQL)
def mart_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = loaded_warehouse(spark, sf_dir)
    plan.refresh_marts(warehouse)
    return warehouse.read_mart("agg_hourly_severity_mart")


_JOINED = """FROM fact_incidents f JOIN dim_date d USING (date_key) JOIN dim_location l USING (location_key)
JOIN dim_road r USING (road_key) JOIN dim_weather w USING (weather_key) JOIN dim_severity s USING (severity_key)"""


def _star_sql(columns: dict[str, list[str]], measures: list[str]) -> str:
    def shown(c: str) -> str:
        return f"{c}::DOUBLE AS {c}" if c in ("latitude", "longitude") else c

    names = [*measures, *[c for cols in columns.values() for c in cols]]
    return f"WITH {STAR_SQL} SELECT {', '.join(shown(c) for c in names)} {_JOINED}"


def _projected(spark: SparkSession, sf_dir: str, columns, measures) -> DataFrame:
    rows = plan.star(star_frames(spark, sf_dir), columns, measures)
    return as_doubles(rows, *[c for c in ("latitude", "longitude") if c in rows.columns])


@query("c_star_view", _star_sql(plan.VIEW_COLUMNS, plan.FACT_MEASURES))
def star_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _projected(spark, sf_dir, plan.VIEW_COLUMNS, plan.FACT_MEASURES)


@query("c_star_full", _star_sql(plan.TRAINING_COLUMNS, plan.FACT_MEASURES))
def star_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _projected(spark, sf_dir, plan.TRAINING_COLUMNS, plan.FACT_MEASURES)


@query("c_star_dashboard", _star_sql(plan.DASHBOARD_COLUMNS, plan.FACT_MEASURES))
def star_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _projected(spark, sf_dir, plan.DASHBOARD_COLUMNS, plan.FACT_MEASURES)


@query("c_star_drift", _star_sql(plan.DRIFT_COLUMNS, ["accident_index"]))
def star_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _projected(spark, sf_dir, plan.DRIFT_COLUMNS, ["accident_index"])


@query("c_star_partial", f"""WITH {STAR_SQL} SELECT road_type, speed_limit, local_authority, severity_name,
  number_of_vehicles, number_of_casualties FROM fact_incidents JOIN dim_road USING (road_key)
  JOIN dim_location USING (location_key) JOIN dim_severity USING (severity_key)""")
def star_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.star(star_frames(spark, sf_dir), {
        "dim_road": ["road_type", "speed_limit"], "dim_severity": ["severity_name"], "dim_location": ["local_authority"]},
        ["number_of_vehicles", "number_of_casualties"])


@query("c_key_lookup", """SELECT l_orderkey, l_linenumber, l_extendedprice, coalesce(k, 1) AS part_key
FROM lineitem LEFT JOIN (SELECT p_size, p_type, min(p_partkey) AS k FROM part GROUP BY ALL)
  ON CAST(l_quantity AS INT) = p_size AND (CASE l_returnflag WHEN 'A' THEN 'PROMO' WHEN 'N' THEN 'SMALL' END) = p_type""")
def key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_extendedprice", "CAST(l_quantity AS INT) AS size",
        "CASE l_returnflag WHEN 'A' THEN 'PROMO' WHEN 'N' THEN 'SMALL' END AS kind")
    parts = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "part_key")
    found = joins.lookup_key(lines, parts, {"size": "p_size", "kind": "p_type"}, "part_key")
    return found.select("l_orderkey", "l_linenumber", "l_extendedprice", "part_key")


@query("c_salted_join", """SELECT l_returnflag, c_mktsegment, count(*) AS records, sum(l_linenumber)::BIGINT AS lines
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order"), "l_returnflag", "l_linenumber", "l_extendedprice")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order"), F.col("o_custkey").alias("customer"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer"), "c_mktsegment")
    first = joins.salted_join(lines, orders, ["order"])
    return (joins.salted_join(first, customers, ["customer"], "left").groupBy("l_returnflag", "c_mktsegment")
            .agg(F.count("*").alias("records"), F.sum("l_linenumber").alias("lines")))


@query("c_anti_new", """SELECT DISTINCT l_partkey, l_suppkey, surface FROM (SELECT *, CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS surface FROM lineitem) a
WHERE l_linestatus = 'O' AND NOT EXISTS (SELECT 1 FROM (SELECT *, CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS surface FROM lineitem) b
  WHERE b.l_linestatus = 'F' AND a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey AND a.surface IS NOT DISTINCT FROM b.surface)""")
def anti_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("surface", F.expr("CASE WHEN l_returnflag <> 'R' THEN l_returnflag END"))
    natural = ["l_partkey", "l_suppkey", "surface"]
    candidates = dedup.distinct_rows(lines.where("l_linestatus = 'O'"), natural)
    existing = dedup.distinct_rows(lines.where("l_linestatus = 'F'"), natural)
    return joins.only_new(candidates, existing, natural)


_INDEX = "l_orderkey || '-' || l_linenumber"


@query("c_anti_bloom", f"""WITH x AS (SELECT {_INDEX} AS index, l_shipdate, l_linestatus = 'O' AND l_returnflag = 'N' AS open,
  l_orderkey % 100 < 90 AS fresh FROM lineitem)
SELECT index, l_shipdate FROM x WHERE open AND index NOT IN (SELECT index FROM x WHERE NOT (open AND fresh))""")
def anti_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open lines are the candidates, a history by month holds a tenth of them and all other lines."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.expr(_INDEX).alias("index"), "l_shipdate", F.expr("l_linestatus = 'O' AND l_returnflag = 'N'").alias("open"),
        (F.col("l_orderkey") % 100 < 90).alias("fresh"), F.date_format("l_shipdate", "yyyyMM").cast("int").alias("month"))
    path = fresh_path(spark, "history")
    lines.where("NOT (open AND fresh)").select("index", "month").hint("rebalance", "month").write.partitionBy("month").parquet(path)
    history = spark.read.schema("index string, month int").parquet(path)
    filters = written(skipping.key_filters(history, ["index"], "month", "first"), "filters")
    return skipping.only_new_by_filters(lines.where("open").select("index", "l_shipdate"), history, filters, ["index"], "month")


@query("c_fk_check", """SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
UNION ALL SELECT l_orderkey, l_returnflag FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def fk_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    idle = joins.missing_parents(table(spark, sf_dir, "customer"), orders, "c_custkey", "o_custkey")
    orphans = joins.missing_parents(table(spark, sf_dir, "lineitem"), orders, "l_orderkey", "o_orderkey")
    return idle.select("c_custkey", "c_name").unionAll(orphans.select("l_orderkey", "l_returnflag"))


@query("c_unique_check", """SELECT l_orderkey, l_linenumber, count(*) AS rows_with_key FROM lineitem
GROUP BY ALL HAVING count(*) > 1""")
def unique_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.key_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


_SITE = "CAST(50 + user_id % 10 / CAST(100 AS DOUBLE) + {} AS DECIMAL(10, 6))"
_INCIDENT = [f"{_SITE.format('CAST(0.001 AS DOUBLE)')} AS latitude", f"{_SITE.format('CAST(-51.5 AS DOUBLE)')} AS longitude"]
_READING = [f"{_SITE.format('CAST(-0.002 AS DOUBLE)')} AS latitude", f"{_SITE.format('CAST(-51.5 AS DOUBLE)')} AS longitude"]
_EVENT_WEATHER = "CASE event_type WHEN 'click' THEN 'Fine no high winds' WHEN 'view' THEN 'Snowing' ELSE 'Other' END"


@query("c_weather_enrich", f"""WITH i AS (SELECT event_id, ts, {', '.join(_INCIDENT)}, {_EVENT_WEATHER} AS weather_conditions FROM events),
w AS (SELECT round(latitude, 2) AS la, round(longitude, 2) AS lo, date_trunc('hour', ts) AS h, min(t) AS t, min(p) AS p
  FROM (SELECT ts, {', '.join(_READING)}, value AS t, CASE WHEN value > 20 THEN value / 10 END AS p FROM events WHERE event_type = 'purchase') GROUP BY 1, 2, 3)
SELECT event_id, coalesce(t, d.temperature_c) AS temperature_c, coalesce(p, d.precipitation_mm) AS precipitation_mm
FROM i JOIN (SELECT weather_condition, {inferred_list_sql('weather_condition')} FROM (SELECT DISTINCT weather_conditions AS weather_condition FROM i)) d
  ON i.weather_conditions = d.weather_condition
LEFT JOIN w ON round(i.latitude, 2) = la AND round(i.longitude, 2) = lo AND date_trunc('hour', i.ts) = h""")
def weather_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    places = events.selectExpr("event_id", "ts AS dt", *_INCIDENT, f"{_EVENT_WEATHER} AS weather_conditions")
    readings = events.where("event_type = 'purchase'").selectExpr(
        "ts AS weather_timestamp", *_READING, "value AS temperature_2m",
        "CASE WHEN value > 20 THEN value / 10 END AS precipitation", "CAST(NULL AS DOUBLE) AS visibility",
        "CAST(NULL AS DOUBLE) AS wind_speed_10m")
    return plan.with_site_weather(places, readings).select("event_id", "temperature_c", "precipitation_mm")


@query("g_distinct_sites", """SELECT DISTINCT round(lat, 2)::DOUBLE AS lat, round(lon, 2)::DOUBLE AS lon, day FROM (
  SELECT CAST(50 + s_acctbal / 10000 AS DECIMAL(10, 6)) AS lat, CAST(-3 + s_acctbal / 7000 AS DECIMAL(10, 6)) AS lon,
  CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)""")
def distinct_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadledger.sources.weather import weather_sites

    places = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey", "CAST(50 + s_acctbal / 10000 AS DECIMAL(10, 6)) AS latitude",
        "CAST(-3 + s_acctbal / 7000 AS DECIMAL(10, 6)) AS longitude")
    staged = (table(spark, sf_dir, "lineitem").join(places, F.expr("l_suppkey = s_suppkey"))
              .select("latitude", "longitude", F.col("l_shipdate").cast("date").cast("string").alias("accident_date")))
    return as_doubles(weather_sites(staged), "lat", "lon").withColumnRenamed("accident_date", "day")
