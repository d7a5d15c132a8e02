"""Drift queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from roadledger.catalog.feed import STAR_SQL, star_frames
from roadledger.catalog.registry import query, table
from roadledger.operators import drift
from roadledger.plans.drift_job import DRIFT_FEATURES, analyse, reference_and_current
from roadledger.plans.star import DRIFT_COLUMNS, star

_CUT = "TIMESTAMP '1999-06-01 00:00:00'"
LINE_FEATURES = ["l_quantity", "l_discount", "l_extendedprice"]


def line_totals(spark: SparkSession, sf_dir: str, features=LINE_FEATURES) -> DataFrame:
    return drift.ordered_counts(table(spark, sf_dir, "lineitem"), features,
                                F.col("l_shipdate") < F.lit("1999-06-01").cast("timestamp_ntz"))


def tall_sql(columns: list[str], source: str, is_ref: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, {is_ref} AS is_ref FROM {source}" for c in columns)


def ks_sql(tall: str) -> str:
    """CTEs ks(feature, n_ref, n_cur, ks) and psi(feature, psi) of rows (feature, value, is_ref)."""
    return f"""tall AS MATERIALIZED ({tall}),
counts AS (SELECT feature, value, count(*) FILTER (is_ref) AS r, count(*) FILTER (NOT is_ref) AS c FROM tall GROUP BY 1, 2),
running AS (SELECT feature, sum(r) OVER w / sum(r) OVER (PARTITION BY feature) AS fr, sum(c) OVER w / sum(c) OVER (PARTITION BY feature) AS fc,
  sum(r) OVER (PARTITION BY feature) AS n, sum(c) OVER (PARTITION BY feature) AS m FROM counts WINDOW w AS (PARTITION BY feature ORDER BY value)),
ks AS (SELECT feature, max(n)::BIGINT AS n_ref, max(m)::BIGINT AS n_cur, max(abs(fr - fc)) AS ks FROM running GROUP BY 1),
edges AS (SELECT feature, quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM tall WHERE is_ref GROUP BY 1),
binned AS (SELECT t.feature, is_ref, len(list_filter(e, lambda q: q <= value)) AS b FROM tall t JOIN edges USING (feature)),
cells AS (SELECT f.feature, g.b, coalesce(sum(CASE WHEN is_ref THEN 1 END), 0) AS r, coalesce(sum(CASE WHEN NOT is_ref THEN 1 END), 0) AS c
  FROM (SELECT feature FROM edges) f CROSS JOIN (SELECT unnest(range(10)) AS b) g LEFT JOIN binned x ON x.feature = f.feature AND x.b = g.b GROUP BY 1, 2),
shares AS (SELECT feature, CASE WHEN r = 0 THEN 1e-4 ELSE r::DOUBLE END / sum(r) OVER (PARTITION BY feature) AS er,
  CASE WHEN c = 0 THEN 1e-4 ELSE c::DOUBLE END / sum(c) OVER (PARTITION BY feature) AS ac FROM cells),
psi AS (SELECT feature, sum((ac - er) * ln(ac / er)) AS psi FROM shares GROUP BY 1)"""


def p_sql(d: str, n: str, m: str) -> str:
    lam2 = f"({d} * {d} * ({n}::DOUBLE * {m} / ({n} + {m})))"
    terms = " + ".join(f"({1.0 if j % 2 else -1.0}::DOUBLE) * exp(-2.0::DOUBLE * {j * j} * {lam2})" for j in range(1, 41))
    return f"CASE WHEN sqrt({lam2}) < 0.2 THEN 1.0::DOUBLE ELSE least(greatest(2.0::DOUBLE * ({terms}), 0.0), 1.0) END"


def millionths(column: str):
    return F.round(F.col(column) * F.lit(1000000.0)).cast("bigint").alias(column)


_LINE = ks_sql(tall_sql(LINE_FEATURES, "lineitem", f"l_shipdate < {_CUT}"))


@query("j_psi", f"WITH {_LINE} SELECT feature, CAST(round(psi * 1000000) AS BIGINT) AS psi FROM psi")
def psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.psi(line_totals(spark, sf_dir)).select("feature", millionths("psi"))


@query("j_ks", f"WITH {_LINE} SELECT feature, n_ref, n_cur, CAST(round(ks * 1000000) AS BIGINT) AS ks FROM ks")
def ks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.ks_statistic(line_totals(spark, sf_dir)).select("feature", "n_ref", "n_cur", millionths("ks"))


@query("j_ks_pvalue", f"WITH {_LINE} SELECT feature, CAST(round(({p_sql('ks', 'n_ref', 'n_cur')}) * 1000000) AS BIGINT) AS p FROM ks")
def ks_pvalue(spark: SparkSession, sf_dir: str) -> DataFrame:
    tested = drift.ks_statistic(line_totals(spark, sf_dir))
    return tested.withColumn("p", drift.ks_p_value(F.col("ks"), F.col("n_ref"), F.col("n_cur"))).select("feature", millionths("p"))


_STEP = """list_append(acc, CASE WHEN abs(i * m - CAST(e[1] AS BIGINT) * n) >= reach THEN 0.0 WHEN i = 0 AND e[1] = 0 THEN 1.0
    ELSE (e[2] * i + CASE WHEN e[1] > 0 THEN acc[-1] ELSE 0 END * e[1]) / (i + e[1]) END)"""


@query("j_ks_exact", f"""WITH RECURSIVE v AS (SELECT l_suppkey, l_quantity AS x, count(*) FILTER (l_returnflag = 'R') AS r, count(*) FILTER (l_returnflag = 'A') AS a
  FROM lineitem WHERE l_returnflag IN ('R', 'A') GROUP BY ALL),
w AS (SELECT l_suppkey, abs(sum(r) OVER up * sum(a) OVER whole - sum(a) OVER up * sum(r) OVER whole) AS gap, sum(r) OVER whole AS n, sum(a) OVER whole AS m
  FROM v WINDOW up AS (PARTITION BY l_suppkey ORDER BY x), whole AS (PARTITION BY l_suppkey)),
k AS (SELECT l_suppkey, CAST(max(n) AS BIGINT) AS n, CAST(max(m) AS BIGINT) AS m, CAST(max(gap) AS BIGINT) AS reach FROM w WHERE n > 0 AND m > 0 GROUP BY l_suppkey),
s AS (SELECT l_suppkey, n, m, reach, -1::BIGINT AS i, [0.0::DOUBLE FOR j IN range(m + 1)] AS row FROM k
  UNION ALL SELECT l_suppkey, n, m, reach, i, list_reduce([[j::DOUBLE, row[j + 1]] FOR j IN range(m + 1)], lambda acc, e: {_STEP}, []::DOUBLE[])
  FROM (SELECT * REPLACE (i + 1 AS i) FROM s WHERE i < n))
SELECT l_suppkey, n AS n_ref, m AS n_cur, CAST(round(CASE WHEN reach = 0 THEN 1 ELSE least(greatest(1 - row[-1], 0), 1) END * 1000000) AS BIGINT) AS p
FROM s WHERE i = n""")
def ks_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities of returned against accepted lines by supplier; a supplier has some hundred of them at any scale."""
    lines = table(spark, sf_dir, "lineitem").where("l_returnflag IN ('R', 'A')")
    counted = lines.groupBy("l_suppkey", F.col("l_quantity").alias("value")).agg(
        F.count_if(F.col("l_returnflag") == "R").alias("ref"), F.count_if(F.col("l_returnflag") == "A").alias("cur"))
    whole = Window.partitionBy("l_suppkey")
    upto = whole.orderBy("value")
    gaps = counted.select("l_suppkey", *[F.sum(c).over(w).alias(f"{c}_{name}") for c in ("ref", "cur")
                                         for w, name in ((upto, "upto"), (whole, "total"))])
    gap = F.abs(F.col("ref_upto") / F.col("ref_total") - F.col("cur_upto") / F.col("cur_total"))
    tested = gaps.where("ref_total > 0 AND cur_total > 0").groupBy("l_suppkey").agg(
        F.max("ref_total").alias("n_ref"), F.max("cur_total").alias("n_cur"), F.max(gap).alias("ks"))
    exact = tested.withColumn("p", drift.exact_ks_p_value(F.col("ks"), F.col("n_ref"), F.col("n_cur")))
    return exact.select("l_suppkey", "n_ref", "n_cur", millionths("p"))


_SPLIT = """SELECT *, rn < floor(n * 0.70::DOUBLE) AS is_ref FROM (SELECT *, row_number() OVER (ORDER BY ts, event_id) - 1 AS rn, count(*) OVER () AS n FROM (
  SELECT event_id, ts, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, event_type,
  50 + user_id % 90 / 100.0 AS latitude, -2 + value / 1000 AS longitude FROM events))"""
EVENT_FEATURES = ["value", "k"]


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        "event_id", "ts", "value", F.from_json("props", "k int")["k"].cast("double").alias("k"), "event_type",
        (F.lit(50.0) + F.col("user_id") % 90 / F.lit(100.0)).alias("latitude"),
        (F.lit(-2.0) + F.col("value") / F.lit(1000.0)).alias("longitude"))
    return reference_and_current(rows, day="ts", key="event_id")


def _is_reference():
    return F.col("split") == "reference"


_EVENT = f"rows AS ({_SPLIT}), " + ks_sql(tall_sql(EVENT_FEATURES, "rows", "is_ref"))
_FEATURE_SQL = f"""SELECT feature, n_ref, n_cur, CAST(round(round_even(ks, 4) * 10000) AS BIGINT) AS ks_e4,
  CAST(round(round_even(p, 4) * 10000) AS BIGINT) AS p_e4, CAST(round(round_even(psi, 4) * 10000) AS BIGINT) AS psi_e4,
  CASE WHEN round_even(psi, 4) > 0.25 THEN 'CRITICAL_DRIFT' WHEN round_even(psi, 4) > 0.10 THEN 'MODERATE_DRIFT' ELSE 'STABLE' END AS status,
  round_even(psi, 4) > 0.25 OR p < 0.01 AS drift_detected
FROM (SELECT *, {p_sql('ks', 'n_ref', 'n_cur')} AS p FROM ks JOIN psi USING (feature))"""


def in_e4(column: str, name: str):
    return F.round(F.col(column) * F.lit(10000.0)).cast("bigint").alias(name)


@query("j_feature_drift", f"WITH {_EVENT} {_FEATURE_SQL}")
def feature_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = drift.ordered_counts(event_rows(spark, sf_dir), EVENT_FEATURES, _is_reference())
    return drift.feature_drift(totals).select(
        "feature", "n_ref", "n_cur", in_e4("ks_statistic", "ks_e4"), in_e4("p_value", "p_e4"), in_e4("psi", "psi_e4"),
        "status", "drift_detected")


_PLACE = f"rows AS ({_SPLIT}), " + ks_sql(tall_sql(["latitude", "longitude"], "rows", "is_ref"))


@query("j_location_drift", f"""WITH {_PLACE}, t AS (SELECT *, {p_sql('ks', 'n_ref', 'n_cur')} AS p FROM ks)
SELECT CAST(round(round_even(la.ks, 4) * 10000) AS BIGINT) AS lat_ks_e4, CAST(round(round_even(la.p, 4) * 10000) AS BIGINT) AS lat_p_e4,
  CAST(round(round_even(lo.ks, 4) * 10000) AS BIGINT) AS lon_ks_e4, CAST(round(round_even(lo.p, 4) * 10000) AS BIGINT) AS lon_p_e4,
  la.p < 0.01 OR lo.p < 0.01 AS drift_detected, (la.p < 0.01 OR lo.p < 0.01) AND (la.ks > 0.15 OR lo.ks > 0.15) AS shift_triggers
FROM (SELECT * FROM t WHERE feature = 'latitude') la CROSS JOIN (SELECT * FROM t WHERE feature = 'longitude') lo""")
def location_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = drift.ordered_counts(event_rows(spark, sf_dir), ["latitude", "longitude"], _is_reference())
    return drift.location_drift(totals).select(
        in_e4("latitude_ks", "lat_ks_e4"), in_e4("latitude_p_val", "lat_p_e4"), in_e4("longitude_ks", "lon_ks_e4"),
        in_e4("longitude_p_val", "lon_p_e4"), "drift_detected", "shift_triggers")


def event_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.drift_report(event_rows(spark, sf_dir), _is_reference(), EVENT_FEATURES, "event_type")


_DECIDED = f"""d AS ({_FEATURE_SQL}), c AS (SELECT bool_or(status = 'CRITICAL_DRIFT') AS critical FROM d),
place_tall AS ({tall_sql(['latitude', 'longitude'], 'rows', 'is_ref')}),
place_counts AS (SELECT feature, value, count(*) FILTER (is_ref) AS r, count(*) FILTER (NOT is_ref) AS c FROM place_tall GROUP BY 1, 2),
place_run AS (SELECT feature, abs(sum(r) OVER w / sum(r) OVER (PARTITION BY feature) - sum(c) OVER w / sum(c) OVER (PARTITION BY feature)) AS gap,
  sum(r) OVER (PARTITION BY feature) AS n, sum(c) OVER (PARTITION BY feature) AS m FROM place_counts WINDOW w AS (PARTITION BY feature ORDER BY value)),
place_ks AS (SELECT feature, max(n) AS n, max(m) AS m, max(gap) AS ks FROM place_run GROUP BY 1),
l AS (SELECT bool_or(({p_sql('ks', 'n', 'm')}) < 0.01) AND bool_or(ks > 0.15) AS shifted FROM place_ks)"""


@query("j_retrain_decision", f"""WITH {_EVENT}, {_DECIDED} SELECT critical OR shifted AS retrain_triggered, CASE WHEN critical OR shifted THEN concat_ws(', ',
  CASE WHEN critical THEN '{drift.REASON_FEATURES}' END, CASE WHEN shifted THEN '{drift.REASON_LOCATION}' END)
  ELSE '{drift.REASON_NONE}' END AS reason FROM c CROSS JOIN l""")
def retrain_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.decision_text(event_report(spark, sf_dir))


@query("j_drift_rows", f"WITH {_EVENT} SELECT feature, psi_e4, ks_e4, p_e4, status, drift_detected FROM ({_FEATURE_SQL})")
def drift_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.drift_rows(event_report(spark, sf_dir)).select(
        "feature", in_e4("psi", "psi_e4"), in_e4("ks_statistic", "ks_e4"), in_e4("p_value", "p_e4"), "status", "drift_detected")


@query("j_report_classes", f"""WITH rows AS ({_SPLIT}) SELECT CASE WHEN is_ref THEN 'reference' ELSE 'current' END AS side, event_type,
  CAST(round(round_even(count(*) / sum(count(*)) OVER (PARTITION BY is_ref), 4) * 10000) AS BIGINT) AS share_e4,
  (SELECT count(*) FROM rows WHERE is_ref) AS reference_records, (SELECT count(*) FROM rows WHERE NOT is_ref) AS current_records
FROM rows GROUP BY is_ref, event_type""")
def report_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = event_report(spark, sf_dir)
    sides = F.explode(F.create_map(
        F.lit("reference"), F.col("class_distribution.reference"), F.lit("current"), F.col("class_distribution.current")))
    opened = report.select("reference_records", "current_records", sides.alias("side", "shares"))
    return opened.select("side", "reference_records", "current_records", F.explode("shares").alias("event_type", "share")).select(
        "side", "event_type", in_e4("share", "share_e4"), "reference_records", "current_records")


_STAR_SPLIT = f"""rows AS (SELECT *, row_number() OVER (ORDER BY full_date, accident_index, latitude, longitude, speed_limit, temperature_c) - 1 < floor(count(*) OVER () * 0.70::DOUBLE) AS is_ref
  FROM (SELECT accident_index, full_date, latitude, longitude, speed_limit, temperature_c, precipitation_mm, wind_speed_kmh
  FROM fact_incidents JOIN dim_date USING (date_key) JOIN dim_location USING (location_key) JOIN dim_road USING (road_key)
  JOIN dim_weather USING (weather_key)))"""


@query("j_star_drift", f"""WITH {STAR_SQL}, {_STAR_SPLIT}, {ks_sql(tall_sql(DRIFT_FEATURES, 'rows', 'is_ref'))} {_FEATURE_SQL}""")
def star_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadledger.operators.ordering import chronological_split

    rows = star(star_frames(spark, sf_dir), DRIFT_COLUMNS, ["accident_index"])
    # The driver's incident keys repeat, so more columns settle the order of equals.
    split = chronological_split(rows, [F.col(c) for c in (
        "full_date", "accident_index", "latitude", "longitude", "speed_limit", "temperature_c")], [0.70], ["reference", "current"])
    totals = drift.ordered_counts(split, DRIFT_FEATURES, _is_reference())
    return drift.feature_drift(totals).select(
        "feature", "n_ref", "n_cur", in_e4("ks_statistic", "ks_e4"), in_e4("p_value", "p_e4"), in_e4("psi", "psi_e4"),
        "status", "drift_detected")


@query("j_drift_report", f"""WITH {STAR_SQL} SELECT CAST(floor(count(*) * 0.70::DOUBLE) AS BIGINT) AS reference_records,
  CAST(count(*) - floor(count(*) * 0.70::DOUBLE) AS BIGINT) AS current_records, CAST(4 AS INT) AS features FROM fact_incidents""")
def full_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = analyse(star_frames(spark, sf_dir))
    return report.select("reference_records", "current_records", F.size("feature_drift").alias("features"))
