"""Quality gate and slicers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadledger.catalog.feed import ARRIVAL_COLUMNS, FEED, FEED_SQL, GATED_SQL, ROW_ID, feed
from roadledger.catalog.registry import query
from roadledger.operators import gate
from roadledger.session import written
from roadledger.sources.reports import quarantine_summary


def gated_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = written(feed(spark, sf_dir), "staged")
    return gate.incident_gate(staged, order=ARRIVAL_COLUMNS, row_id=ROW_ID)


@query("b_gate_reasons", f"SELECT accident_index, arrived_at, arrival_price, rejection_reason FROM ({GATED_SQL})")
def gate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gated_feed(spark, sf_dir).select("accident_index", "arrived_at", "arrival_price", "rejection_reason")


@query("b_gate_accounting", f"""SELECT count(*) AS total, count(*) - count(rejection_reason) AS valid,
  count(rejection_reason) AS rejected FROM ({GATED_SQL})""")
def gate_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.accounting(gated_feed(spark, sf_dir))


@query("b_reason_counts", f"""SELECT rejection_reason, count(*) AS records FROM ({GATED_SQL})
WHERE rejection_reason IS NOT NULL GROUP BY rejection_reason""")
def reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.reason_counts(gated_feed(spark, sf_dir))


@query("b_quarantine_payload", f"""SELECT accident_index AS record_identifier, rejection_reason,
  'stg_accidents_raw' AS source_entity, CAST(speed_limit AS VARCHAR) AS payload_speed,
  accident_date IS NULL AS payload_null_date, weather_conditions AS payload_weather
FROM ({GATED_SQL}) WHERE rejection_reason IS NOT NULL""")
def quarantine_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = gate.envelopes(gated_feed(spark, sf_dir), "stg_accidents_raw", "accident_index", list(FEED))
    return records.select(
        "record_identifier", "rejection_reason", "source_entity",
        F.get_json_object("raw_payload", "$.speed_limit").alias("payload_speed"),
        F.col("raw_payload").contains('"accident_date":null').alias("payload_null_date"),
        F.get_json_object("raw_payload", "$.weather_conditions").alias("payload_weather"))


@query("b_quarantine_summary", f"""WITH g AS ({GATED_SQL}) SELECT (SELECT count(*) FROM g) AS total_evaluated,
  (SELECT count(*) FROM g WHERE rejection_reason IS NULL) AS passed_validation, rejection_reason AS reason, count(*) AS records
FROM g WHERE rejection_reason IS NOT NULL GROUP BY rejection_reason""")
def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quarantine_summary(gated_feed(spark, sf_dir))
    return report.select("total_evaluated", "passed_validation", F.explode("reasons_breakdown").alias("reason", "records"))


_REQUEST = {
    "accident_index": "accident_index", "arrived_at": "arrived_at", "arrival_price": "arrival_price",
    "hour": "CAST(substring(accident_time, 1, 2) AS INT) + 2",
    "latitude": "CAST(latitude AS DOUBLE)", "longitude": "CAST(longitude AS DOUBLE)",
    "speed_limit": "CASE WHEN speed_limit = 0 THEN NULL ELSE speed_limit END",
    "number_of_vehicles": "number_of_vehicles",
    "number_of_casualties": "CASE WHEN number_of_casualties = 5 THEN NULL ELSE number_of_casualties * 6 END",
    "road_surface_conditions": "road_surface_conditions",
}
_REQUEST_LIST = [f"{e} AS {c}" for c, e in _REQUEST.items()]
_BOUND = "'INVALID_{u}: {n} not in [{lo}, {hi}]'"


def _bound_sql(name: str, low, high) -> str:
    text = _BOUND.format(u=name.upper(), n=name, lo=low, hi=high)
    return f"WHEN {name} IS NULL OR {name} < {low} OR {name} > {high} THEN {text}"


@query("b_score_input", f"""SELECT accident_index, arrived_at, arrival_price, speed_limit, number_of_casualties, road_surface_conditions,
  'Friday' AS day_name, 12.0::DOUBLE AS temperature_c,
  CASE {" ".join(_bound_sql(n, *b) for n, b in gate.SCORING_BOUNDS.items())} END AS rejection_reason
FROM (SELECT * REPLACE (coalesce(speed_limit, 30) AS speed_limit, coalesce(number_of_casualties, 1) AS number_of_casualties,
  coalesce(road_surface_conditions, 'Dry') AS road_surface_conditions) FROM (SELECT {', '.join(_REQUEST_LIST)} FROM ({FEED_SQL})))""")
def score_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = feed(spark, sf_dir).selectExpr(*_REQUEST_LIST)
    checked = gate.scoring_input(requests)
    return checked.select("accident_index", "arrived_at", "arrival_price", "speed_limit", "number_of_casualties",
                          "road_surface_conditions", "day_name", "temperature_c", "rejection_reason")


@query("b_slicers", f"""SELECT urban_or_rural_area, accident_severity, count(*) AS records,
  sum(number_of_casualties)::BIGINT AS casualties FROM ({FEED_SQL})
WHERE urban_or_rural_area IN ('Urban') AND accident_severity IN ('Fatal', 'Slight') AND latitude IS NOT NULL
  AND accident_date IS NOT NULL GROUP BY ALL""")
def slicers(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = gate.in_any(feed(spark, sf_dir), urban_or_rural_area=["Urban"], accident_severity=["Fatal", "Slight"])
    return (gate.with_values(chosen, "latitude", "accident_date").groupBy("urban_or_rural_area", "accident_severity")
            .agg(F.count("*").alias("records"), F.sum("number_of_casualties").alias("casualties")))
