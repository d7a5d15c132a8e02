"""Features, resampling and quality measures."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from roadledger.catalog.feed import STAR_SQL, star_frames
from roadledger.catalog.registry import query, table
from roadledger.functions import calendar, severity
from roadledger.operators import features, metrics, resample
from roadledger.plans.star import TRAINING_COLUMNS, star
from roadledger.plans.training import measures

MICRO = "CAST(round(({}) * 1000000) AS BIGINT)"


def micro(column):
    return F.round(column * F.lit(1000000.0)).cast("bigint")


_CYCLE = "2.0::DOUBLE * pi() * hour / 24.0::DOUBLE"


@query("j_feature_table", f"""WITH {STAR_SQL} SELECT accident_index, severity_code, 3 - severity_code AS class, hour::DOUBLE AS hour,
  speed_limit::DOUBLE AS speed_limit, temperature_c, precipitation_mm, visibility_m, wind_speed_kmh,
  number_of_vehicles::DOUBLE AS number_of_vehicles, number_of_casualties::DOUBLE AS number_of_casualties,
  {MICRO.format(f'sin({_CYCLE})')} AS hour_sin, {MICRO.format(f'cos({_CYCLE})')} AS hour_cos, day_name, time_of_day,
  urban_or_rural, road_type, light_conditions, road_surface_conditions, weather_condition
FROM fact_incidents JOIN dim_date USING (date_key) JOIN dim_location USING (location_key) JOIN dim_road USING (road_key)
JOIN dim_weather USING (weather_key) JOIN dim_severity USING (severity_key)""")
def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.feature_table(star(star_frames(spark, sf_dir), TRAINING_COLUMNS), ("accident_index", "severity_code"))
    return features.with_class(rows).withColumns({c: micro(F.col(c)) for c in ("hour_sin", "hour_cos")})


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("j_zscore_onehot", f"""WITH e AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, event_type,
  dayname(ts) AS day_name FROM events),
s AS (SELECT median(value) AS vmed, avg(value) AS vm, stddev_pop(value) AS vs, avg(k) AS km, stddev_pop(k) AS ks FROM e)
SELECT event_id, {MICRO.format('(coalesce(value, vmed) - vm) / vs')} AS z_value, {MICRO.format('(k - km) / ks')} AS z_k, """ + ", ".join(
    f"CAST(event_type = '{t}' AS INT) AS is_{t}" for t in EVENT_TYPES) + ", " + ", ".join(
    f"CAST(day_name = '{d}' AS INT) AS is_{d.lower()}" for d in sorted(calendar.DAY_NAMES)) + " FROM e CROSS JOIN s")
def zscore_onehot(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        F.from_json("props", "k int")["k"].cast("double").alias("k"), "event_type",
        calendar.day_name(F.col("ts")).alias("day_name"))
    fitted = features.fit_preprocessor(events, ["value", "k"], ["event_type", "day_name"])
    v = F.col("v")
    names = [f"is_{t}" for t in EVENT_TYPES] + [f"is_{d.lower()}" for d in sorted(calendar.DAY_NAMES)]
    return fitted.transform(events).select("event_id", vector_to_array("features").alias("v")).select(
        "event_id", micro(v[0]).alias("z_value"), micro(v[1]).alias("z_k"),
        *[v[i + 2].cast("int").alias(n) for i, n in enumerate(names)])


@query("j_unseen_category", """SELECT event_id, CAST(event_type IN ('click', 'error', 'purchase', 'signup') AS INT) AS known FROM events""")
def unseen_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An indicator fitted without one event type leaves that type all zeros."""
    events = table(spark, sf_dir, "events").select("event_id", "value", "event_type")
    fitted = features.fit_preprocessor(events.where("event_type <> 'view'"), ["value"], ["event_type"])
    vector = vector_to_array("features")
    slots = F.slice(vector, F.lit(2), F.size(vector) - 1)  # all indicators; the first slot is the number
    return fitted.transform(events).select(
        "event_id", F.aggregate(slots, F.lit(0.0), lambda a, x: a + x).cast("int").alias("known"))


@query("j_smote", """SELECT label, max(n) OVER () AS records, max(n) OVER () - n AS synthetic, 0::BIGINT AS outside_range
FROM (SELECT label, count(*) AS n FROM embeddings GROUP BY label)""")
def smote(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("vec"))
    grown = resample.smote(vectors, "label", "vec", ["vec_id"])
    # Bounds of every dimension within a class; a synthetic row must lie inside them.
    dims = range(64)
    bounds = vectors.groupBy("label").agg(F.array(*[F.min(F.col("vec")[i]) for i in dims]).alias("low"),
                                          F.array(*[F.max(F.col("vec")[i]) for i in dims]).alias("high"))
    outside = F.exists(F.arrays_zip("vec", "low", "high"),
                       lambda e: (e["vec"] < e["low"] - 1e-9) | (e["vec"] > e["high"] + 1e-9))
    return grown.join(bounds, "label").groupBy("label").agg(
        F.count("*").alias("records"), F.count_if("is_synthetic").alias("synthetic"),
        F.count_if(outside).alias("outside_range"))


JUDGED = {
    "label": "CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN 1 ELSE 2 END",
    "prediction": "CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_returnflag = 'N' AND l_quantity > 20 THEN 1 ELSE 2 END",
    "p_0": "l_discount", "p_1": "l_tax", "p_2": "l_extendedprice",
}
JUDGED_SQL = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in JUDGED.items()) + " FROM lineitem JOIN orders ON l_orderkey = o_orderkey"


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.expr("l_orderkey = o_orderkey")).selectExpr(*[f"{e} AS {c}" for c, e in JUDGED.items()])


@query("j_confusion", f"""SELECT CAST(label AS INT) AS label, count(*) FILTER (prediction = 0) AS predicted_0,
  count(*) FILTER (prediction = 1) AS predicted_1, count(*) FILTER (prediction = 2) AS predicted_2 FROM ({JUDGED_SQL}) GROUP BY 1""")
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_matrix(judged(spark, sf_dir), "label", "prediction", 3)


_REPORT_SQL = f"""SELECT c AS label, hits / nullif(predicted, 0) AS precision, hits / nullif(support, 0) AS recall,
  2 * hits / nullif(predicted + support, 0) AS f1, support FROM (SELECT CAST(c AS INT) AS c,
  count(*) FILTER (label = c) AS support, count(*) FILTER (prediction = c) AS predicted, count(*) FILTER (label = c AND prediction = c) AS hits
  FROM ({JUDGED_SQL}) CROSS JOIN (SELECT unnest([0, 1, 2]) AS c) GROUP BY 1)"""


@query("j_report", f"""SELECT label, {MICRO.format('precision')} AS precision, {MICRO.format('recall')} AS recall,
  {MICRO.format('f1')} AS f1, support FROM ({_REPORT_SQL})""")
def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures(judged(spark, sf_dir), "label", "prediction")["report"].select(
        "label", *[micro(F.col(c)).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("j_averages", f"""SELECT {MICRO.format('sum(recall * support) / sum(support)')} AS accuracy, {MICRO.format('avg(f1)')} AS macro_f1,
  {MICRO.format('sum(f1 * support) / sum(support)')} AS weighted_f1 FROM ({_REPORT_SQL})""")
def averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures(judged(spark, sf_dir), "label", "prediction")["averages"].select(
        *[micro(F.col(c)).alias(c) for c in ("accuracy", "macro_f1", "weighted_f1")])


@query("j_auc_ovr", f"""WITH j AS ({JUDGED_SQL}), t AS (SELECT 0 AS class, p_0 AS score, label = 0 AS member FROM j
  UNION ALL SELECT 1, p_1, label = 1 FROM j UNION ALL SELECT 2, p_2, label = 2 FROM j),
g AS (SELECT class, score, count(*) FILTER (member) AS pos, count(*) FILTER (NOT member) AS neg FROM t GROUP BY 1, 2),
w AS (SELECT class, pos, neg, sum(neg) OVER (PARTITION BY class ORDER BY score) - neg AS below FROM g),
a AS (SELECT class, sum(pos * (below + 0.5::DOUBLE * neg)) / (sum(pos)::DOUBLE * sum(neg)) AS auc FROM w GROUP BY 1)
SELECT CAST(class AS INT) AS class, {MICRO.format('auc')} AS auc, {MICRO.format('avg(auc) OVER ()')} AS macro FROM a""")
def auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_class = metrics.auc_by_class(judged(spark, sf_dir), "label", {c: f"p_{c}" for c in range(3)})
    macro = metrics.auc_macro(by_class)  # one row
    return by_class.join(F.broadcast(macro)).select("class", micro(F.col("auc")).alias("auc"), micro(F.col("roc_auc")).alias("macro"))


@query("d_prediction_labels", f"""SELECT label, CASE label WHEN 0 THEN 'Slight' WHEN 1 THEN 'Serious' ELSE 'Fatal' END AS name,
  CAST(3 - label AS INT) AS code, count(*) AS records FROM ({JUDGED_SQL}) GROUP BY 1""")
def prediction_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = judged(spark, sf_dir).groupBy("label").agg(F.count("*").alias("records"))
    return counts.select("label", severity.class_label(F.col("label")).alias("name"),
                         severity.class_severity_code(F.col("label")).alias("code"), "records")
