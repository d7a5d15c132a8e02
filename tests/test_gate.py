"""Quality gate: bounds, order of the rules, repeats, accounting, envelopes, scoring input."""

import json

import pytest
from pyspark.sql import functions as F

from roadledger.operators import gate
from roadledger.schemas import STG_INCIDENTS

GOOD = {"accident_index": None, "accident_date": "2024-03-01", "accident_time": "08:15", "latitude": 51.5,
        "longitude": -0.1, "accident_severity": "3", "number_of_vehicles": 2, "number_of_casualties": 1,
        "speed_limit": 30, "road_type": "Single", "light_conditions": "Daylight", "weather_conditions": "Fine",
        "road_surface_conditions": "Dry", "urban_or_rural_area": "Urban", "local_authority": "A", "batch_id": "b1"}


def staged(spark, *rows):
    names = [*GOOD, "arrival"]
    kinds = {f.name: f.dataType.simpleString() for f in STG_INCIDENTS.fields}
    layout = ", ".join(f"{n} {'double' if n in ('latitude', 'longitude') else kinds[n]}" for n in names)
    data = [tuple({**GOOD, "accident_index": f"k{i}", **row, "arrival": i}[n] for n in names) for i, row in enumerate(rows)]
    return spark.createDataFrame(data, layout)


def reasons(spark, *rows):
    found = gate.incident_gate(staged(spark, *rows)).orderBy("arrival").collect()
    return [r["rejection_reason"] and r["rejection_reason"].split(":")[0] for r in found]


def test_single_rules(spark):
    cases = [
        ({"latitude": 49.0}, None), ({"latitude": 61.5}, None), ({"longitude": -8.5}, None), ({"longitude": 2.5}, None),
        ({"latitude": None}, "INVALID_COORDINATES"), ({"latitude": 61.51}, "INVALID_COORDINATES"),
        ({"longitude": 2.51}, "INVALID_COORDINATES"), ({"latitude": float("nan")}, "INVALID_COORDINATES"),
        ({"latitude": 10.0, "speed_limit": 0}, "INVALID_COORDINATES"),
        ({"accident_date": None}, "MISSING_DATETIME"), ({"accident_date": "2024-1"}, "MISSING_DATETIME"),
        ({"accident_date": "99999999"}, None),
        ({"speed_limit": None}, "INVALID_SPEED_LIMIT"), ({"speed_limit": 0}, "INVALID_SPEED_LIMIT"),
        ({"speed_limit": -1}, "INVALID_SPEED_LIMIT"), ({"speed_limit": 101}, "INVALID_SPEED_LIMIT"),
        ({"speed_limit": 5}, None), ({"speed_limit": 100}, None),
        ({"accident_severity": "1"}, None), ({"accident_severity": "Fatal"}, None),
        ({"accident_severity": None}, "INVALID_SEVERITY"), ({"accident_severity": "1.0"}, "INVALID_SEVERITY"),
        ({"accident_severity": "4"}, "INVALID_SEVERITY"), ({"accident_severity": "fatal"}, "INVALID_SEVERITY"),
    ]
    assert reasons(spark, *[row for row, _ in cases]) == [expected for _, expected in cases]


def test_repeats(spark):
    rows = [{"accident_index": "a"}, {"accident_index": "a"}, {"accident_index": "b", "speed_limit": 0},
            {"accident_index": "b"}, {"accident_index": None}, {"accident_index": None}]
    assert reasons(spark, *rows) == [None, "DUPLICATE_ACCIDENT_INDEX", "INVALID_SPEED_LIMIT", "DUPLICATE_ACCIDENT_INDEX",
                                     None, "DUPLICATE_ACCIDENT_INDEX"]


def test_hot_key_is_judged_whole(spark):
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("key"), F.col("id").alias("arrival"))
    from roadledger.operators.dedup import flag_repeats, keep_first

    flagged = flag_repeats(rows, ["key"], ["arrival"], ["arrival"])
    assert flagged.where("is_repeat").count() == 9999
    assert flagged.where("key = 'hot' AND NOT is_repeat").first()["arrival"] == 0
    assert keep_first(rows, ["key"], ["arrival"]).count() == 20001


def test_accounting_and_reasons(spark):
    gated = gate.incident_gate(staged(spark, {}, {"speed_limit": 0}, {"speed_limit": 0}, {"accident_date": None}))
    assert gate.accounting(gated).first().asDict() == {"total": 4, "valid": 1, "rejected": 3}
    assert {r[0].split(":")[0]: r[1] for r in gate.reason_counts(gated).collect()} == {
        "INVALID_SPEED_LIMIT": 2, "MISSING_DATETIME": 1}
    assert gate.passed(gated).count() == 1


def test_empty_input(spark):
    gated = gate.incident_gate(staged(spark, {}).where("false"))
    assert gate.accounting(gated).first().asDict() == {"total": 0, "valid": 0, "rejected": 0}


def test_envelope_keeps_nulls(spark):
    gated = gate.incident_gate(staged(spark, {"accident_date": None}, {"accident_index": None, "speed_limit": 0}))
    found = gate.envelopes(gated, "stg", "accident_index", list(GOOD), "arrival").orderBy("arrival").collect()
    assert [r["record_identifier"] for r in found] == ["k0", "None"]
    payload = json.loads(found[0]["raw_payload"])
    assert payload["accident_date"] is None and payload["speed_limit"] == 30
    unnamed = gate.envelopes(gated.drop("accident_index"), "stg", "accident_index", ["speed_limit"], "arrival")
    assert unnamed.orderBy("arrival").first()["record_identifier"] == "ROW_0"


def test_speed_floor_is_a_parameter(spark):
    gated = gate.incident_gate(staged(spark, {"speed_limit": 5}), lowest_speed=10)
    assert gate.accounting(gated).first()["rejected"] == 1


def test_scoring_input(spark):
    rows = spark.createDataFrame(
        [(7, 51.5, 0.0, None, 2), (24, 51.5, 0.0, 30, 2), (7, None, 0.0, 30, 2), (7, 51.5, 0.0, 5, 2), (7, 51.5, 0.0, 30, 21)],
        "hour int, latitude double, longitude double, speed_limit int, number_of_vehicles int")
    found = gate.scoring_input(rows).collect()
    assert [r["rejection_reason"] and r["rejection_reason"].split(":")[0] for r in found] == [
        None, "INVALID_HOUR", "INVALID_LATITUDE", "INVALID_SPEED_LIMIT", "INVALID_NUMBER_OF_VEHICLES"]
    assert found[0]["speed_limit"] == 30 and found[0]["day_name"] == "Friday" and found[0]["visibility_m"] == 10000.0


@pytest.mark.parametrize("chosen, left", [(["Urban"], 1), ([], 0), (["Urban", "Rural"], 2)])
def test_slicers(spark, chosen, left):
    rows = staged(spark, {}, {"urban_or_rural_area": "Rural"})
    assert gate.in_any(rows, urban_or_rural_area=chosen).count() == left


def test_many_repeats_leave_the_wide_rows_in_place(spark, monkeypatch):
    from roadledger.operators import joins
    from roadledger.operators.dedup import flag_repeats
    from roadledger.session import written

    monkeypatch.setattr(joins, "SMALL_TABLE", 0)  # as if no table were small
    rows = written(spark.range(200_000).selectExpr(
        "id % 50000 AS key", "-id AS arrival", "IF(id % 7 = 0, 'a', 'b') AS file", "id + 8589934592 * (id % 3) AS row", "repeat('x', 20) AS wide"), "r")
    flagged = flag_repeats(rows, ["key"], ["arrival"], ["file", "row"])
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert flagged.groupBy("is_repeat").count().orderBy("is_repeat").collect() == [(False, 50_000), (True, 150_000)]
    assert flagged.where("is_repeat <> (arrival > -150000)").isEmpty()


def test_repeats_of_ids_with_nulls_or_copies(spark):
    from roadledger.operators.dedup import flag_repeats, flag_repeats_by_join

    held = [("a", 1, "f", 0), ("a", 2, "f", 1), ("a", 3, None, 2), ("b", 1, "f", None), ("b", 0, "g", 1), (None, 1, "g", 2), (None, 2, "g", 3)]
    for rows in (held, held + [("c", 1, "f", 9), ("c", 2, "f", 10), ("c", 2, "f", 10)]):
        df = spark.createDataFrame(rows, "key string, arrival int, file string, row bigint")
        made = [f(df, ["key"], ["arrival"], ["file", "row"]).select(*df.columns, "is_repeat").collect()
                for f in (flag_repeats, flag_repeats_by_join)]
        assert sorted(map(str, made[0])) == sorted(map(str, made[1]))


def test_row_ids_are_narrow_and_are_not_sorted(spark, tmp_path):
    """Numbers of files instead of their paths, and bits that are added up as numbers: sorts of ids spilled at size."""
    from roadledger.catalog.registry import file_of
    from roadledger.operators.dedup import has_bit, id_words, row_bits, unique_ids

    for number, name in enumerate(["b c", "a"]):
        spark.range(3).selectExpr(f"id + 10 * {number} AS id").coalesce(1).write.parquet(f"{tmp_path}/t/part={name}")
    rows = spark.read.schema("id bigint").parquet(f"{tmp_path}/t")
    assert {(r["n"], r["id"] // 10) for r in rows.select(file_of(rows).alias("n"), "id").collect()} == {(1, 1), (2, 0)}
    assert [r.n for r in rows.where("false").select(file_of(rows.where("false")).alias("n")).collect()] == []

    numbers = [0, 1, 63, 64, 127, 32766, 32767, 32768, 32769, 65536, 8589934592 * 3 + 5, None]
    ids = spark.createDataFrame([(f, n) for f in (1, 2, None) for n in numbers], "f bigint, n bigint")
    assert "SortAggregate" not in id_words(ids, ["f", "n"])._jdf.queryExecution().toString()
    assert unique_ids(ids, ["f", "n"]) and not unique_ids(ids.unionAll(ids.where("f = 2 AND n = 64")), ["f", "n"])
    kept = ids.where("n % 2 = 0 OR f = 2")
    bits = row_bits(kept, ["f", "n"]).withColumnRenamed("f", "g")
    found = ids.dropna().join(bits, F.expr("f = g AND bitmap_bucket_number(n) = _bucket"), "left")
    marked = found.select("f", "n", F.coalesce(has_bit("_bits", "n"), F.lit(False)).alias("there")).collect()
    assert len(marked) == 22 and all(r["there"] == (r["n"] % 2 == 0 or r["f"] == 2) for r in marked)
