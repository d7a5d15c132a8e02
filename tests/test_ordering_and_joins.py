"""Row numbers, running totals, quantiles, splits, lookups and salted joins against brute force."""

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from roadledger.operators import joins, ordering, skipping
from roadledger.session import written


def test_row_numbers_equal_a_global_window(spark):
    rows = spark.range(5000).select("id", (F.xxhash64("id") % 50).alias("v"))
    ours = ordering.number_rows(rows, [F.col("v"), F.col("id")])
    window = rows.withColumn("row_number", F.row_number().over(Window.orderBy("v", "id")).cast("bigint"))
    assert ours.exceptAll(window).isEmpty() and ours.count() == 5000


def test_row_numbers_of_nothing(spark):
    assert ordering.number_rows(spark.range(0), [F.col("id")]).count() == 0


def test_running_totals(spark):
    rows = spark.range(3000).select((F.col("id") % 2).alias("g"), F.col("id").alias("v"), (F.col("id") % 7).alias("n"))
    got = ordering.running_totals(rows, ["g"], "v", ["n"])
    w = Window.partitionBy("g").orderBy("v")
    expected = rows.select("*", F.sum("n").over(w).alias("n_upto"), F.sum("n").over(Window.partitionBy("g")).alias("n_total"))
    assert got.exceptAll(expected).isEmpty() and got.count() == 3000


@pytest.mark.parametrize("values", [[5.0], [1.0, 2.0], [1.0] * 50 + [2.0, 9.0], list(np.random.default_rng(3).normal(size=501))])
def test_quantiles_equal_numpy(spark, values):
    p = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    rows = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "x double")
    got = ordering.exact_quantiles(rows, ["x"], p).first()["quantiles"]
    assert got == pytest.approx(list(np.quantile(values, p)), abs=1e-12)


def test_chronological_split(spark):
    n = 2463
    rows = spark.range(n).select("id", F.lit(0).alias("t"))
    parts = ordering.chronological_split(rows, [F.col("t"), F.col("id")], [0.70, 0.70 + 0.15], ["train", "val", "test"])
    sizes = {r["split"]: (r["count"], r["low"], r["high"]) for r in parts.groupBy("split").agg(
        F.count("*").alias("count"), F.min("id").alias("low"), F.max("id").alias("high")).collect()}
    assert sizes == {"train": (1724, 0, 1723), "val": (369, 1724, 2092), "test": (370, 2093, 2462)}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, how):
    left = spark.range(4000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, 7).otherwise(F.col("id")).cast("bigint").alias("k"))
    right = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    plain = left.join(right, ["k"], how)
    salted = joins.salted_join(left, right, ["k"], how, hot=[(7,), (None,)])
    assert salted.exceptAll(plain.select(*salted.columns)).isEmpty() and salted.count() == plain.count()


def test_salted_join_with_null_safe_and_array_keys(spark):
    left = spark.range(900).select("id", F.when(F.col("id") % 3 > 0, F.array(F.lit(1.5), (F.col("id") % 3).cast("double"))).alias("k"))
    right = spark.createDataFrame([([1.5, 1.0], "a"), ([1.5, 2.0], "b"), (None, "none")], "k array<double>, w string")
    got = joins.salted_join(left, right, ["k"], "left", hot=[([1.5, 1.0],), (None,)], null_safe=True)
    assert got.columns == ["id", "k", "w"]
    assert {r["w"]: r["count"] for r in got.groupBy("w").count().collect()} == {"a": 300, "b": 300, "none": 300}


def test_sized_join_takes_both_ways(spark, monkeypatch):
    left = spark.range(1000).select("id", (F.col("id") % 5).alias("k"))
    right = spark.range(4).select(F.col("id").alias("k"), F.lit("x").alias("w"))
    dims = [(right.withColumnRenamed("k", "d_key"), "d_key", ["w"])]
    facts = left.withColumnRenamed("k", "d_key")
    small, small_star = joins.sized_join(left, right, ["k"], "left"), joins.star_join(facts, dims, ["id"])
    monkeypatch.setattr(joins, "SMALL_TABLE", 2)
    large, large_star = joins.sized_join(left, right, ["k"], "left"), joins.star_join(facts, dims, ["id"])
    assert small.exceptAll(large).isEmpty() and large.count() == 1000
    assert small_star.exceptAll(large_star).isEmpty() and large_star.count() == 800


def test_a_flat_table_has_no_hot_key(spark):
    assert joins.hot_keys(spark.range(200_000).select((F.col("id") % 2000).alias("k")), ["k"], 0.5) == []


def test_only_new_to_history(spark, monkeypatch):
    held = spark.createDataFrame([("a",), ("b",), (None,), ("z",)], "k string")
    rows = spark.createDataFrame([("a", 1), ("c", 2), (None, 3), ("c", 4)], "k string, n int")
    for _ in range(2):
        assert sorted(r["n"] for r in joins.only_new_to_history(rows, held, ["k"]).collect()) == [2, 4]
        monkeypatch.setattr(joins, "SMALL_TABLE", 0)


@pytest.mark.parametrize("ties", [False, True])
def test_split_with_null_and_equal_order_values(spark, ties):
    rows = spark.range(100).select("id", F.when(F.col("id") >= 40, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("t"))
    order = [F.col("t")] if ties else [F.col("t"), F.col("id")]
    parts = ordering.chronological_split(rows, order, [0.25, 0.5], ["a", "b", "c"])
    found = {r["split"]: (r["n"], r["nulls"]) for r in parts.groupBy("split").agg(
        F.count("*").alias("n"), F.count_if(F.col("t").isNull()).alias("nulls")).collect()}
    assert found == {"a": (25, 25), "b": (25, 15), "c": (50, 0)}


def test_hot_keys_are_found(spark):
    rows = spark.range(50000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") + 10).alias("k"))
    assert (1,) in joins.hot_keys(rows, ["k"], 0.05)


def test_salted_join_refuses_outer(spark):
    with pytest.raises(ValueError):
        joins.salted_join(spark.range(1), spark.range(1), ["id"], "full")


def test_lookup_never_multiplies(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, c string")
    dim = spark.createDataFrame([(5, "a"), (4, "a"), (6, None)], "key int, c2 string")
    plain = joins.lookup_key(facts, dim, {"c": "c2"}, "key")
    assert {r["id"]: r["key"] for r in plain.collect()} == {1: 4, 2: 1, 3: 1}
    safe = joins.lookup_key(facts, dim, {"c": "c2"}, "key", default=-1, null_safe=True)
    assert {r["id"]: r["key"] for r in safe.collect()} == {1: 4, 2: -1, 3: 6}


def test_only_new_treats_nulls_as_equal(spark):
    new = spark.createDataFrame([("a", None), ("b", 1), ("c", 2)], "x string, y int")
    old = spark.createDataFrame([("a", None), ("b", 2)], "x string, y int")
    assert sorted(r["x"] for r in joins.only_new(new, old, ["x", "y"]).collect()) == ["b", "c"]


def test_checks(spark):
    rows = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert [tuple(r) for r in joins.key_violations(rows, ["k"]).collect()] == [(1, 2)]
    parents = spark.createDataFrame([(1,)], "p int")
    assert [r["k"] for r in joins.missing_parents(rows, parents, "k", "p").collect()] == [2]


def test_filters_leave_untouched_months_unread(spark, tmp_path):
    """Months without hits are no input of the plan; nothing is missed, also with nulls and several segments."""
    rows = [(None if k == 7 else f"k{k}", 202401 + k % 12, k) for k in range(6000)] + [("late", None, 0), ("k1", 202403, 0)]
    history = spark.createDataFrame(rows, "k string, month int, n int")
    history.write.partitionBy("month").parquet(path := str(tmp_path / "history"))
    history = spark.read.schema("k string, month int, n int").parquet(path)
    half = F.coalesce(F.col("n") % 2, F.lit(0)) == 0
    segments = [skipping.key_filters(history.where(half), ["k"], "month", "a"), skipping.key_filters(history.where(~half), ["k"], "month", "b")]
    filters = written(segments[0].unionByName(segments[1]), "filters")
    batch = written(spark.createDataFrame([("k1",), ("k14",), ("k25",), ("new",), ("newer",)], "k string"), "batch")
    months = skipping.possible_parts(batch, filters, ["k"], "month")
    assert {202402, 202403} <= set(months) and len(months) < 5
    kept = skipping.in_parts(history, "month", months)
    assert {f.rsplit("month=", 1)[1].split("/")[0] for f in kept.inputFiles()} >= {str(m) for m in months}
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [month" in plan
    read = {r.p for r in kept.select(F.regexp_extract("_metadata.file_path", "month=([^/]+)", 1).alias("p")).distinct().collect()}
    assert read == {str(m) for m in months}
    assert sorted(r.k for r in skipping.only_new_by_filters(batch, history, filters, ["k"], "month").collect()) == ["new", "newer"]
    odd = written(spark.createDataFrame([(None,), ("late",), ("nowhere",)], "k string"), "batch")
    assert [r.k for r in skipping.only_new_by_filters(odd, history, filters, ["k"], "month").collect()] == ["nowhere"]
    none = filters.where("false")
    assert skipping.possible_parts(batch, none, ["k"], "month") == []


def test_filters_name_few_partitions_wrongly(spark):
    rows = spark.range(40_000).selectExpr("concat('k', id) AS k", "cast(id % 4 AS int) AS month")
    filters = written(skipping.key_filters(written(rows, "rows"), ["k"], "month", "a"), "filters")
    first, second = skipping._hashes(["k"])
    absent = spark.range(20_000).selectExpr("concat('x', id) AS k").select("k", first.alias("h1"), second.alias("h2"))
    tried = absent.crossJoin(F.broadcast(filters.select("month", "blocks").distinct()))  # four rows
    met = tried.withColumn("block", skipping._block(F.col("h1"), F.col("blocks"))).join(filters, ["month", "blocks", "block"])
    for k in range(skipping.WORDS):
        met = met.where(F.getbit(f"w{k}", skipping._bit(F.col("h2"), k)) == 1)
    assert met.count() <= 20
