"""Driver tables seen as incidents.

Each column is one expression that reads the same in Spark SQL and in the oracle's SQL. Values
cross every bound of the quality gate, keys repeat, and some natural-key parts are null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadledger.catalog.registry import file_of, table
from roadledger.operators.joins import NARROW_TABLE, sent_if_small
from roadledger.schemas import severity_rows

ISO_DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
HOUR = "(o_custkey % 24)"


def _degrees(start: str, key: str, factor: int, span: int) -> str:
    return (f"CAST(CAST({start} AS DOUBLE) + CAST({key} * {factor} % {span} AS DOUBLE) / CAST(100 AS DOUBLE) "
            "AS DECIMAL(10,6))")


LATITUDE = _degrees("48.5", "s_suppkey", 37, 1400)
LONGITUDE = _degrees("-9.0", "s_suppkey", 53, 1200)
SPEED = ("CAST(CASE WHEN p_size = 1 THEN NULL WHEN p_size = 2 THEN 0 WHEN p_size = 3 THEN 120 "
         "ELSE 20 + 10 * (p_size % 6) END AS INT)")
LIGHT = f"CASE WHEN {HOUR} BETWEEN 7 AND 18 THEN 'Daylight' ELSE 'Darkness - lights lit' END"
WEATHER = ("CASE o_orderpriority WHEN '1-URGENT' THEN 'Fine no high winds' WHEN '2-HIGH' THEN 'Raining no high winds' "
           "WHEN '3-MEDIUM' THEN 'Snowing + high winds' WHEN '4-NOT SPECIFIED' THEN 'Fog or mist' ELSE 'Other' END")
AREA = "CASE WHEN r_name IN ('ASIA', 'EUROPE') THEN 'Urban' ELSE 'Rural' END"
VEHICLES = "CAST(1 + l_linenumber % 4 AS INT)"
CASUALTIES = "CAST(1 + CAST(l_quantity AS INT) % 5 AS INT)"
SEVERITY = ("CASE WHEN o_orderstatus = 'F' THEN 'Fatal' WHEN o_orderstatus = 'O' THEN '2' "
            "WHEN l_linestatus = 'F' AND l_discount = 0.1 THEN '1.0' ELSE 'Slight' END")
SEVERITY_KEY = "CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS INT)"

FEED = {
    "accident_index": "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING))",
    "accident_date": (
        "CASE WHEN l_quantity = 50 THEN NULL WHEN l_quantity = 49 THEN '2024-1' WHEN l_quantity = 48 THEN '99999999' "
        f"WHEN l_returnflag = 'R' THEN concat(substring({ISO_DAY}, 9, 2), '/', substring({ISO_DAY}, 6, 2), '/', "
        f"substring({ISO_DAY}, 1, 4)) ELSE {ISO_DAY} END"),
    "accident_time": (f"concat(lpad(CAST({HOUR} AS STRING), 2, '0'), ':', "
                      "lpad(CAST(l_partkey % 60 AS STRING), 2, '0'), ':00')"),
    "latitude": f"CASE WHEN l_tax = 0.08 AND l_discount = 0.1 THEN NULL ELSE {LATITUDE} END",
    "longitude": LONGITUDE,
    "accident_severity": SEVERITY,
    "number_of_vehicles": VEHICLES,
    "number_of_casualties": CASUALTIES,
    "speed_limit": SPEED,
    "road_type": "p_type",
    "light_conditions": LIGHT,
    "weather_conditions": WEATHER,
    "road_surface_conditions": "CASE l_returnflag WHEN 'A' THEN 'Dry' WHEN 'N' THEN 'Wet or damp' ELSE NULL END",
    "urban_or_rural_area": AREA,
    "local_authority": "n_name",
}
# What puts the records of one key in order.
ARRIVAL = {"arrived_at": "l_shipdate", "arrival_price": "l_extendedprice", "arrival_part": "l_partkey",
           "arrival_supplier": "l_suppkey"}
ARRIVAL_COLUMNS = list(ARRIVAL)
ROW_ID = ["source_file", "source_row"]

_FROM = """lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey"""

FEED_SQL = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in {**FEED, **ARRIVAL}.items()) + f" FROM {_FROM}"


def feed_columns(lines: DataFrame, spark: SparkSession, sf_dir: str, carried: list[str]) -> DataFrame:
    """Lines (a batch or a stream) joined to the tables that describe them, as incidents.

    A join that is shuffled moves whole lines with all that earlier ones have added. So what adds least goes first and
    orders, which add most, last; of suppliers only the nation's key travels, its names are looked up at the end.
    """
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = (lines.join(sent_if_small(suppliers, NARROW_TABLE), F.expr("l_suppkey = s_suppkey"))
              .join(table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
              .join(table(spark, sf_dir, "orders"), F.expr("l_orderkey = o_orderkey"))
              .join(sent_if_small(nations), F.expr("s_nationkey = n_nationkey"))
              .join(sent_if_small(regions), F.expr("n_regionkey = r_regionkey")))
    return joined.selectExpr(*[f"{e} AS {c}" for c, e in {**FEED, **ARRIVAL}.items()], *carried)


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incident feed with the position of each row in its source file."""
    lines = table(spark, sf_dir, "lineitem")
    lines = lines.select("*", file_of(lines).alias("source_file"), F.col("_metadata.row_index").alias("source_row"))
    return feed_columns(lines, spark, sf_dir, ROW_ID)


# The gate and what follows it, as SQL.
MESSAGE_SQL = {
    "INVALID_COORDINATES": "INVALID_COORDINATES: Lat/Lon out of plausible geographic bounds",
    "MISSING_DATETIME": "MISSING_DATETIME: Accident date is null or invalid format",
    "INVALID_SPEED_LIMIT": "INVALID_SPEED_LIMIT: Speed limit not in range [10, 100]",
    "INVALID_SEVERITY": "INVALID_SEVERITY: Severity not mapped to 1, 2, or 3",
    "DUPLICATE_ACCIDENT_INDEX": "DUPLICATE_ACCIDENT_INDEX: Duplicate key collision",
}
GATED_SQL = f"""SELECT *, CASE
  WHEN latitude IS NULL OR longitude IS NULL OR latitude < 49.0 OR latitude > 61.5 OR longitude < -8.5
    OR longitude > 2.5 THEN '{MESSAGE_SQL["INVALID_COORDINATES"]}'
  WHEN accident_date IS NULL OR length(accident_date) < 8 THEN '{MESSAGE_SQL["MISSING_DATETIME"]}'
  WHEN speed_limit IS NULL OR speed_limit <= 0 OR speed_limit > 100 THEN '{MESSAGE_SQL["INVALID_SPEED_LIMIT"]}'
  WHEN accident_severity IS NULL OR accident_severity NOT IN ('1', '2', '3', 'Fatal', 'Serious', 'Slight')
    THEN '{MESSAGE_SQL["INVALID_SEVERITY"]}'
  WHEN place > 1 THEN '{MESSAGE_SQL["DUPLICATE_ACCIDENT_INDEX"]}' END AS rejection_reason
FROM (SELECT *, row_number() OVER (PARTITION BY accident_index ORDER BY arrived_at, arrival_price, arrival_part,
  arrival_supplier) AS place FROM ({FEED_SQL}))"""

PARSED_SQL = """coalesce(try_strptime(accident_date || ' ' || substring(accident_time, 1, 5), '%Y-%m-%d %H:%M'),
  try_strptime(accident_date || ' ' || substring(accident_time, 1, 5), '%d/%m/%Y %H:%M'),
  TIMESTAMP '2024-06-01 12:00:00')"""


def date_key_sql(ts: str) -> str:
    return f"CAST(year({ts}) * 1000000 + month({ts}) * 10000 + day({ts}) * 100 + hour({ts}) AS INT)"


def period_sql(hour: str) -> str:
    return (f"CASE WHEN {hour} >= 6 AND {hour} < 10 THEN 'Morning Rush' WHEN {hour} >= 10 AND {hour} < 16 THEN 'Midday' "
            f"WHEN {hour} >= 16 AND {hour} < 20 THEN 'Evening Rush' ELSE 'Night' END")


def calendar_sql(ts: str) -> str:
    return f"""{date_key_sql(ts)} AS date_key, CAST({ts} AS DATE) AS full_date, CAST(year({ts}) AS INT) AS year,
  CAST(quarter({ts}) AS INT) AS quarter, CAST(month({ts}) AS INT) AS month, monthname({ts}) AS month_name,
  CAST(day({ts}) AS INT) AS day_of_month, CAST(isodow({ts}) - 1 AS INT) AS day_of_week, dayname({ts}) AS day_name,
  isodow({ts}) >= 6 AS is_weekend, CAST(hour({ts}) AS INT) AS hour, {period_sql(f'hour({ts})')} AS time_of_day"""


def inferred_sql(condition: str) -> dict[str, str]:
    c = f"coalesce({condition}, '')"

    def has(word: str) -> str:
        return f"contains({c}, '{word}')"

    out = {
        "temperature_c": f"CASE WHEN {has('Fine')} THEN 14.5 WHEN {has('Rain')} THEN 8.0 WHEN {has('Snow')} THEN 1.5 ELSE 10.0 END",
        "precipitation_mm": f"CASE WHEN {has('Fine')} THEN 0.0 WHEN {has('Rain')} THEN 3.5 ELSE 1.0 END",
        "visibility_m": f"CASE WHEN {has('Fine')} THEN 10000.0 WHEN {has('Rain')} THEN 4000.0 ELSE 800.0 END",
        "wind_speed_kmh": f"CASE WHEN {has('Fine')} THEN 12.0 WHEN {has('high winds')} THEN 28.0 ELSE 16.0 END",
    }
    out = {name: f"CAST({e} AS DOUBLE)" for name, e in out.items()}
    out["weather_risk_level"] = risk_sql(c, out["temperature_c"], out["precipitation_mm"])
    return out


def risk_sql(condition: str, temperature: str, precipitation: str) -> str:
    return (f"CASE WHEN contains({condition}, 'Snow') OR contains({condition}, 'Ice') OR {precipitation} > 5.0 "
            f"OR {temperature} < 0 THEN 'Severe' WHEN contains({condition}, 'Rain') OR contains({condition}, 'Fog') "
            f"OR {precipitation} > 0.5 THEN 'Moderate' ELSE 'Low' END")


def inferred_list_sql(condition: str) -> str:
    return ", ".join(f"{e} AS {name}" for name, e in inferred_sql(condition).items())


# A star over the driver tables that needs no load: their own keys serve as surrogate keys.
_FACT = {
    "accident_index": FEED["accident_index"],
    "date_key": (f"CAST(year(o_orderdate) * 1000000 + month(o_orderdate) * 10000 + day(o_orderdate) * 100 + {HOUR} "
                 "AS INT)"),
    "location_key": "l_suppkey",
    "road_key": "l_partkey",
    "weather_key": "CAST(substring(o_orderpriority, 1, 1) AS BIGINT)",
    "severity_key": SEVERITY_KEY,
    "number_of_vehicles": VEHICLES,
    "number_of_casualties": CASUALTIES,
}
_LOCATION = {"location_key": "s_suppkey", "latitude": LATITUDE, "longitude": LONGITUDE, "urban_or_rural": AREA,
             "local_authority": "n_name"}
_ROAD = {"road_key": "p_partkey", "road_type": "p_type", "speed_limit": "CAST(20 + 10 * (p_size % 6) AS INT)",
         "light_conditions": "CASE WHEN p_size > 25 THEN 'Daylight' ELSE 'Darkness - lights lit' END",
         "road_surface_conditions": "CASE WHEN p_brand < 'Brand#2' THEN 'Dry' ELSE 'Wet or damp' END"}


def _select(columns: dict[str, str], source: str) -> str:
    return "SELECT " + ", ".join(f"{e} AS {c}" for c, e in columns.items()) + f" FROM {source}"


_FACT_SQL = _select(_FACT, "lineitem JOIN orders ON l_orderkey = o_orderkey")
_HOUR_SQL = ("SELECT DISTINCT date_key, make_timestamp(CAST(date_key // 1000000 AS BIGINT), "
             "CAST(date_key // 10000 % 100 AS BIGINT), CAST(date_key // 100 % 100 AS BIGINT), "
             f"CAST(date_key % 100 AS BIGINT), 0, 0) AS t FROM ({_FACT_SQL})")
STAR_SQL = f"""fact_incidents AS ({_FACT_SQL}),
dim_date AS (SELECT {calendar_sql('t')} FROM ({_HOUR_SQL})),
dim_location AS ({_select(_LOCATION, "supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")}),
dim_road AS ({_select(_ROAD, "part")}),
dim_weather AS (SELECT weather_key, weather_condition, {inferred_list_sql("weather_condition")} FROM (
  SELECT DISTINCT {_FACT["weather_key"]} AS weather_key, {WEATHER} AS weather_condition FROM orders)),
dim_severity AS (SELECT * FROM (VALUES (CAST(1 AS INT), CAST(1 AS INT), 'Fatal'), (2, 2, 'Serious'), (3, 3, 'Slight'))
  AS s(severity_key, severity_code, severity_name))"""


def star_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    from roadledger.plans.star import date_rows, weather_rows

    def columns(mapping: dict[str, str]) -> list[str]:
        return [f"{e} AS {c}" for c, e in mapping.items()]

    orders = table(spark, sf_dir, "orders")
    facts = (table(spark, sf_dir, "lineitem").join(orders, F.expr("l_orderkey = o_orderkey"))
             .selectExpr(*columns(_FACT)))
    places = (table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.expr("s_nationkey = n_nationkey"))
              .join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey")).selectExpr(*columns(_LOCATION)))
    # The weather dimension has one row per priority; the date dimension comes from orders alone.
    named = orders.selectExpr(f"{_FACT['weather_key']} AS weather_key", f"{WEATHER} AS weather_conditions").distinct()
    weather = named.join(weather_rows(named), F.expr("weather_conditions <=> weather_condition")).drop("weather_conditions")
    return {
        "fact_incidents": facts,
        "dim_date": date_rows(orders.selectExpr(f"{_FACT['date_key']} AS date_key")),
        "dim_location": places,
        "dim_road": table(spark, sf_dir, "part").selectExpr(*columns(_ROAD)),
        "dim_weather": weather,
        "dim_severity": severity_rows(spark).drop("severity_description"),
    }
