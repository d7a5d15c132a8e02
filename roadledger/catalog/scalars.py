"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadledger.catalog.feed import (FEED_SQL, HOUR, ISO_DAY, WEATHER, calendar_sql, date_key_sql, feed,
                                     inferred_list_sql, period_sql, risk_sql)
from roadledger.catalog.registry import query, table
from roadledger.functions import calendar, cleaning, geo, severity, weather

MICRO = "CAST(round({} * 1000000) AS BIGINT)"


def micro(column):
    """A double as whole millionths, so that last-digit differences of libraries do not show."""
    return F.round(column * F.lit(1000000.0)).cast("bigint")


@query("d_calendar_parts", f"SELECT event_id, {calendar_sql('ts')} FROM events")
def calendar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", *[c.alias(n) for n, c in calendar.calendar_columns(F.col("ts")).items()])


@query("d_time_of_day", f"SELECT CAST(hour(ts) AS INT) AS hour, {period_sql('hour(ts)')} AS time_of_day, "
                        "count(*) AS records FROM events GROUP BY ALL")
def time_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = F.hour("ts")
    return (table(spark, sf_dir, "events").groupBy(hour.alias("hour"), calendar.time_of_day(hour).alias("time_of_day"))
            .agg(F.count("*").alias("records")))


@query("d_date_key", f"SELECT {date_key_sql('ts')} AS date_key, count(*) AS records FROM events GROUP BY ALL")
def date_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "events").groupBy(calendar.date_key(F.col("ts")).alias("date_key"))
            .agg(F.count("*").alias("records")))


@query("d_cyclical_hour", f"""SELECT event_id, {MICRO.format("sin(2.0::DOUBLE * pi() * hour(ts) / 24.0::DOUBLE)")} AS hour_sin,
  {MICRO.format("cos(2.0::DOUBLE * pi() * hour(ts) / 24.0::DOUBLE)")} AS hour_cos FROM events""")
def cyclical_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = F.hour("ts")
    return table(spark, sf_dir, "events").select(
        "event_id", micro(calendar.hour_sin(hour)).alias("hour_sin"), micro(calendar.hour_cos(hour)).alias("hour_cos"))


DATE_TEXT = (f"CASE o_orderpriority WHEN '1-URGENT' THEN {ISO_DAY} WHEN '2-HIGH' THEN concat(substring({ISO_DAY}, 9, 2), "
             f"'/', substring({ISO_DAY}, 6, 2), '/', substring({ISO_DAY}, 1, 4)) WHEN '3-MEDIUM' THEN NULL "
             f"WHEN '4-NOT SPECIFIED' THEN '99999999' ELSE concat(substring({ISO_DAY}, 1, 4), '-02-31') END")
TIME_TEXT = (f"concat(lpad(CAST({HOUR} AS STRING), 2, '0'), ':', lpad(CAST(o_orderkey % 70 AS STRING), 2, '0'), ':30')")


@query("d_parse_timestamp", f"""SELECT o_orderkey, coalesce(try_strptime(d || ' ' || substring(t, 1, 5), '%Y-%m-%d %H:%M'),
  try_strptime(d || ' ' || substring(t, 1, 5), '%d/%m/%Y %H:%M'), TIMESTAMP '2024-06-01 12:00:00') AS dt,
  substring(d, 1, 10) AS day_text, coalesce(try_cast(p AS DOUBLE), 0.0) AS number
FROM (SELECT o_orderkey, {DATE_TEXT} AS d, {TIME_TEXT} AS t,
  CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE substring(o_orderpriority, 1, 1) END AS p FROM orders)""")
def parse_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", f"{DATE_TEXT} AS d", f"{TIME_TEXT} AS t",
        "CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE substring(o_orderpriority, 1, 1) END AS p")
    return texts.select(
        "o_orderkey", calendar.incident_time(F.col("d"), F.col("t")).alias("dt"),
        F.substring("d", 1, 10).alias("day_text"), cleaning.number_or_zero(F.col("p")).alias("number"))


SEVERITY_TEXT = ("CASE WHEN o_orderpriority = '1-URGENT' THEN '1' WHEN o_orderpriority = '5-LOW' THEN 'unknown' "
                 "WHEN o_orderstatus = 'F' THEN 'Fatal' WHEN o_orderstatus = 'O' THEN 'Serious' ELSE NULL END")


@query("d_severity_map", f"""SELECT o_orderkey, code AS severity_code, 3 - code AS class,
  CASE code WHEN 1 THEN 'Fatal' WHEN 2 THEN 'Serious' ELSE 'Slight' END AS label
FROM (SELECT o_orderkey, CAST(CASE WHEN s IN ('1', 'Fatal') THEN 1 WHEN s IN ('2', 'Serious') THEN 2 ELSE 3 END AS INT) AS code
  FROM (SELECT o_orderkey, {SEVERITY_TEXT} AS s FROM orders))""")
def severity_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = table(spark, sf_dir, "orders").select(
        "o_orderkey", severity.severity_code(F.expr(SEVERITY_TEXT)).alias("severity_code"))
    return coded.select("o_orderkey", "severity_code", severity.class_index(F.col("severity_code")).alias("class"),
                        severity.class_label(severity.class_index(F.col("severity_code"))).alias("label"))


K_SQL = "CAST(json_extract_string(props, '$.k') AS INT)"


@query("d_wmo_code", f"""SELECT k AS code, CASE k {" ".join(f"WHEN {c} THEN '{t}'" for c, t in weather.WMO_DESCRIPTIONS.items())}
  ELSE 'Clear / Normal' END AS description, count(*) AS records FROM (SELECT {K_SQL} AS k FROM events) GROUP BY ALL""")
def wmo_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.from_json("props", "k int")["k"]
    return (table(spark, sf_dir, "events").groupBy(code.alias("code")).agg(F.count("*").alias("records"))
            .select("code", weather.wmo_description(F.col("code")).alias("description"), "records"))


@query("d_weather_infer", f"""SELECT weather_condition, {inferred_list_sql('weather_condition')}, count(*) AS records
FROM (SELECT {WEATHER} AS weather_condition FROM orders) GROUP BY weather_condition""")
def weather_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = (table(spark, sf_dir, "orders").groupBy(F.expr(WEATHER).alias("weather_condition"))
              .agg(F.count("*").alias("records")))
    return counts.select("weather_condition", "records", *[
        c.alias(n) for n, c in weather.inferred_columns(F.col("weather_condition")).items()])


RISK_TEXT = ("CASE WHEN p_size < 10 THEN 'Snowing' WHEN p_size < 20 THEN 'Raining' WHEN p_size < 30 THEN 'Fog or mist' "
             "WHEN p_size < 40 THEN 'Icy (Ice)' ELSE 'Fine' END")


@query("d_weather_risk", f"""SELECT p_partkey, {risk_sql('c', 't', 'p')} AS risk FROM (SELECT p_partkey, {RISK_TEXT} AS c,
  CAST(p_partkey % 30 - 5 AS DOUBLE) AS t, CAST(p_size % 8 AS DOUBLE) AS p FROM part)""")
def weather_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", f"{RISK_TEXT} AS c", "CAST(p_partkey % 30 - 5 AS DOUBLE) AS t", "CAST(p_size % 8 AS DOUBLE) AS p")
    return parts.select("p_partkey", weather.risk_level(F.col("c"), F.col("t"), F.col("p")).alias("risk"))


RULE_SQL = f"""SELECT accident_index, arrived_at, arrival_price, slight / total AS p0, serious / total AS p1, fatal / total AS p2
FROM (SELECT *, slight + serious + fatal AS total FROM (SELECT *, greatest(0.05::DOUBLE, 1.0::DOUBLE - fatal - serious) AS slight
FROM (SELECT *, least(greatest(0.02::DOUBLE + 0.25::DOUBLE * (risk / 1.5::DOUBLE), 0.01::DOUBLE), 0.45::DOUBLE) AS fatal,
  least(greatest(0.15::DOUBLE + 0.35::DOUBLE * (risk / 1.5::DOUBLE), 0.10::DOUBLE), 0.50::DOUBLE) AS serious
FROM (SELECT *, 0.05::DOUBLE + 0.12::DOUBLE * least(number_of_casualties::DOUBLE, 4.0::DOUBLE)
  + 0.005::DOUBLE * greatest(0.0::DOUBLE, coalesce(speed_limit, 30)::DOUBLE - 20.0::DOUBLE)
  + 0.05::DOUBLE * least(number_of_vehicles::DOUBLE, 4.0::DOUBLE)
  + 0.1::DOUBLE * (CASE WHEN contains(light_conditions, 'Dark') THEN 1.0 ELSE 0.0 END)::DOUBLE
  + 0.08::DOUBLE * (CASE WHEN contains(weather_conditions, 'Rain') OR contains(weather_conditions, 'Snow')
    OR contains(weather_conditions, 'Fog') THEN 1.0 ELSE 0.0 END)::DOUBLE AS risk FROM ({FEED_SQL})))))"""


def rule_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feed(spark, sf_dir)
    p = severity.rule_probabilities(F.col("number_of_casualties"), F.col("speed_limit"), F.col("number_of_vehicles"),
                                    F.col("light_conditions"), F.col("weather_conditions"))
    return rows.select("accident_index", "arrived_at", "arrival_price", *[c.alias(f"p{i}") for i, c in enumerate(p)])


@query("d_rule_scorer", f"""SELECT accident_index, arrived_at, arrival_price, {MICRO.format('p0')} AS p_slight,
  {MICRO.format('p1')} AS p_serious, {MICRO.format('p2')} AS p_fatal,
  CASE WHEN p0 >= p1 AND p0 >= p2 THEN 'Slight' WHEN p1 >= p2 THEN 'Serious' ELSE 'Fatal' END AS label FROM ({RULE_SQL})""")
def rule_scorer(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = [F.col(f"p{i}") for i in range(3)]
    return rule_scored(spark, sf_dir).select(
        "accident_index", "arrived_at", "arrival_price", micro(p[0]).alias("p_slight"), micro(p[1]).alias("p_serious"),
        micro(p[2]).alias("p_fatal"), severity.class_label(severity.arg_max(p)).alias("label"))


@query("d_risk_score", f"""SELECT accident_index, arrived_at, arrival_price,
  CAST(round((0.1::DOUBLE * p0 + 0.5::DOUBLE * p1 + 1.0::DOUBLE * p2) * 10000) AS BIGINT) AS risk_e4,
  CAST(round(p2 * 10000) AS BIGINT) AS fatal_e4, CAST(round(p2 * 10000) / 100 AS DOUBLE) AS fatal_pct FROM ({RULE_SQL})""")
def risk_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = [F.col(f"p{i}") for i in range(3)]
    fatal = severity.probability_map(p)["Fatal"]
    return rule_scored(spark, sf_dir).select(
        "accident_index", "arrived_at", "arrival_price",
        F.round(severity.risk_score(p) * F.lit(10000.0)).cast("bigint").alias("risk_e4"),
        F.round(fatal * F.lit(10000.0)).cast("bigint").alias("fatal_e4"),
        (F.round(fatal * F.lit(10000.0)) / F.lit(100.0)).alias("fatal_pct"))


@query("d_json_payload", """SELECT event_type, sum(CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS k_sum,
  count(*) AS records, count(*) AS round_trips FROM events GROUP BY event_type""")
def json_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        "event_type", "event_id", F.from_json("props", "k bigint").alias("p"),
        F.to_json(F.struct("event_id", "event_type"), {"ignoreNullFields": "false"}).alias("row"))
    back = F.from_json("row", "event_id bigint, event_type string")
    return rows.groupBy("event_type").agg(
        F.sum("p.k").alias("k_sum"), F.count("*").alias("records"),
        F.count_if(back["event_id"] == F.col("event_id")).alias("round_trips"))


@query("d_misc_scalars", """SELECT event_id, CASE WHEN isodow(ts) >= 6 THEN 'Weekend (Sat-Sun)' ELSE 'Weekday (Mon-Fri)' END AS weekend_label,
  lpad(CAST(hour(ts) AS VARCHAR), 2, '0') || ':00' AS hour_label, date_trunc('hour', ts)::TIMESTAMP AS sort_time,
  CAST(CASE dayname(ts) WHEN 'Monday' THEN 1 WHEN 'Tuesday' THEN 2 WHEN 'Wednesday' THEN 3 WHEN 'Thursday' THEN 4
    WHEN 'Friday' THEN 5 WHEN 'Saturday' THEN 6 ELSE 7 END AS INT) AS day_order,
  CASE WHEN event_type = 'error' THEN 'Unknown' ELSE event_type END AS event_type,
  CASE WHEN value / 100 > 0.25 THEN 'CRITICAL_DRIFT' WHEN value / 100 > 0.10 THEN 'MODERATE_DRIFT' ELSE 'STABLE' END AS status,
  CAST(round(CAST(value AS DECIMAL(10, 6)), 1) AS DOUBLE) AS one_place FROM events""")
def misc_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadledger.operators.drift import drift_status

    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id", calendar.weekend_label(calendar.is_weekend(ts)).alias("weekend_label"),
        calendar.hour_label(F.hour(ts)).alias("hour_label"),
        calendar.sort_time(F.to_date(ts), F.hour(ts)).alias("sort_time"),
        calendar.rank_in(calendar.DAY_NAMES, calendar.day_name(ts)).alias("day_order"),
        cleaning.text_or_unknown(F.when(F.col("event_type") != "error", F.col("event_type"))).alias("event_type"),
        drift_status(F.col("value") / 100).alias("status"),
        geo.grid(F.col("value"), 1).cast("double").alias("one_place"))


@query("d_coordinates", """SELECT s_suppkey, CAST(round(lat, 2) AS DOUBLE) AS site_lat, CAST(round(lon, 2) AS DOUBLE) AS site_lon,
  CAST(round(lat, 3) AS DOUBLE) AS cell_lat, CAST(round(lon, 3) AS DOUBLE) AS cell_lon
FROM (SELECT s_suppkey, CAST(50 + s_acctbal / 10000 AS DECIMAL(10, 6)) AS lat, CAST(-3 + s_acctbal / 7000 AS DECIMAL(10, 6)) AS lon FROM supplier)""")
def coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey", "CAST(50 + s_acctbal / 10000 AS DECIMAL(10, 6)) AS lat",
        "CAST(-3 + s_acctbal / 7000 AS DECIMAL(10, 6)) AS lon")
    return places.select("s_suppkey", *[
        geo.grid(F.col(c), n).cast("double").alias(f"{kind}_{c}") for kind, n in (("site", 2), ("cell", 3)) for c in ("lat", "lon")])
