"""Scalar expressions against known answers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from roadledger.functions import calendar, cleaning, geo, severity, weather


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_time_of_day_edges(spark):
    rows = spark.createDataFrame([(h,) for h in (0, 5, 6, 9, 10, 15, 16, 19, 20, 23)], "h int")
    assert [r[0] for r in rows.select(calendar.time_of_day(F.col("h"))).collect()] == [
        "Night", "Night", "Morning Rush", "Morning Rush", "Midday", "Midday", "Evening Rush", "Evening Rush", "Night", "Night"]


@pytest.mark.parametrize("date, time, expected", [
    ("2024-02-29", "23:59:59", dt.datetime(2024, 2, 29, 23, 59)),
    ("18/01/2024", "07:05", dt.datetime(2024, 1, 18, 7, 5)),
    ("2023-02-29", "10:00", dt.datetime(2024, 6, 1, 12, 0)),
    ("99999999", "10:00", dt.datetime(2024, 6, 1, 12, 0)),
    ("2024-01-01", "25:00", dt.datetime(2024, 6, 1, 12, 0)),
    ("2024-01-01", None, dt.datetime(2024, 6, 1, 12, 0)),
])
def test_incident_time(spark, date, time, expected):
    assert one(spark, calendar.incident_time(F.lit(date), F.lit(time).cast("string"))) == expected


def test_month_first_dates(spark):
    assert one(spark, calendar.parse_when(F.lit("02/01/2024"), F.lit("01:00"), day_first=False)) == dt.datetime(2024, 2, 1, 1)


def test_calendar_columns(spark):
    ts = F.lit("2024-12-29 17:30:00").cast("timestamp_ntz")
    row = spark.range(1).select(*[c.alias(n) for n, c in calendar.calendar_columns(ts).items()]).first()
    assert row.asDict() == {
        "date_key": 2024122917, "full_date": dt.date(2024, 12, 29), "year": 2024, "quarter": 4, "month": 12,
        "month_name": "December", "day_of_month": 29, "day_of_week": 6, "day_name": "Sunday", "is_weekend": True,
        "hour": 17, "time_of_day": "Evening Rush"}


def test_weekend_label_reads_any_flag(spark):
    for flag in (F.lit(True), F.lit(1), F.lit("True"), F.lit("true"), F.lit("1")):
        assert one(spark, calendar.weekend_label(flag)) == "Weekend (Sat-Sun)"
    assert one(spark, calendar.weekend_label(F.lit(0))) == "Weekday (Mon-Fri)"


# Known answers of the weather inference.
@pytest.mark.parametrize("condition, expected", [
    ("Fine no high winds", (14.5, 0.0, 10000.0, 12.0, "Low")),
    ("Fine + high winds", (14.5, 0.0, 10000.0, 12.0, "Low")),
    ("Raining no high winds", (8.0, 3.5, 4000.0, 28.0, "Moderate")),
    ("Raining + high winds", (8.0, 3.5, 4000.0, 28.0, "Moderate")),
    ("Snowing", (1.5, 1.0, 800.0, 16.0, "Severe")),
    ("Snowing + high winds", (1.5, 1.0, 800.0, 28.0, "Severe")),
    ("Fog or mist", (10.0, 1.0, 800.0, 16.0, "Moderate")),
    ("1", (10.0, 1.0, 800.0, 16.0, "Moderate")),
    (None, (10.0, 1.0, 800.0, 16.0, "Moderate")),
])
def test_weather_inference(spark, condition, expected):
    rows = spark.createDataFrame([(condition,)], "c string")
    assert tuple(rows.select(*weather.inferred_columns(F.col("c")).values()).first()) == expected


def test_weather_codes(spark):
    rows = spark.createDataFrame([(0,), (95,), (99,), (None,)], "c int")
    assert [r[0] for r in rows.select(weather.wmo_description(F.col("c"))).collect()] == [
        "Clear sky", "Thunderstorm", "Clear / Normal", "Clear / Normal"]


def test_severity(spark):
    rows = spark.createDataFrame([("1",), ("Fatal",), ("2",), ("Slight",), ("x",), (None,)], "s string")
    code = severity.severity_code(F.col("s"))
    assert [tuple(r) for r in rows.select(code, severity.class_index(code), severity.class_label(severity.class_index(code))).collect()] == [
        (1, 2, "Fatal"), (1, 2, "Fatal"), (2, 1, "Serious"), (3, 0, "Slight"), (3, 0, "Slight"), (3, 0, "Slight")]


def test_rule_scorer(spark):
    p = severity.rule_probabilities(F.lit(9), F.lit(70), F.lit(9), F.lit("Darkness"), F.lit("Fog or mist"))
    risk = 0.05 + 0.12 * 4 + 0.005 * 50 + 0.05 * 4 + 0.1 + 0.08
    fatal, serious = min(0.02 + 0.25 * risk / 1.5, 0.45), min(0.15 + 0.35 * risk / 1.5, 0.5)
    slight = max(0.05, 1 - fatal - serious)
    total = fatal + serious + slight
    assert list(spark.range(1).select(*p).first()) == pytest.approx([slight / total, serious / total, fatal / total])
    empty = F.lit(None).cast("int")
    defaults = severity.rule_probabilities(empty, empty, empty, F.lit(None).cast("string"), F.lit(None).cast("string"))
    assert sum(spark.range(1).select(*defaults).first()) == pytest.approx(1.0)


def test_risk_score_and_ties(spark):
    p = [F.lit(0.4), F.lit(0.4), F.lit(0.2)]
    assert one(spark, severity.risk_score(p)) == 0.44
    assert one(spark, severity.arg_max(p)) == 0


def test_cleaning(spark):
    rows = spark.createDataFrame([("1.5",), ("x",), (None,), ("NaN",)], "t string")
    assert [r[0] for r in rows.select(cleaning.number_or_zero(F.col("t"))).collect()] == [1.5, 0.0, 0.0, 0.0]
    assert one(spark, cleaning.text_or_unknown(F.lit(None).cast("string"))) == "Unknown"


def test_coordinates(spark):
    assert float(one(spark, geo.grid(F.lit("51.505"), 2))) == 51.51
    assert one(spark, geo.request_coordinate(F.lit(51.123456))) == 51.1235


def test_hex_cells_are_compact(spark):
    """No point is farther from its cell's centre than the cell's radius."""
    import math

    rows = spark.range(2000).select((F.lit(50.0) + F.rand(1) * 5).alias("la"), (F.lit(-3.0) + F.rand(2) * 4).alias("lo"))
    cells = geo.hex_cell(F.col("la"), F.col("lo"), 5000.0)
    to_m = math.pi / 180 * geo.EARTH_RADIUS_M
    for r in rows.select("la", "lo", *[c.alias(n) for n, c in cells.items()]).collect():
        x, y = r["lo"] * to_m * math.cos(math.radians(55.0)), r["la"] * to_m
        cx, cy = 5000 * math.sqrt(3) * (r["hex_q"] + r["hex_r"] / 2), 5000 * 1.5 * r["hex_r"]
        assert math.hypot(x - cx, y - cy) <= 5000 * 1.0001
