"""The feed of incidents: what its joins move, and that their order changes no row."""

import re

import pytest

from oracle_check import connect, difference
from roadledger.catalog import feed as feeds
from roadledger.catalog.registry import LAYOUTS

DAY = "timestamp_ntz'2024-03-0{}'"


@pytest.fixture
def tables(spark, tmp_path):
    """Small tables with keys that repeat, have no partner or are null."""
    lines = [f"({o}, {p}, {s}, {n}, {q}D, 10D, {d}D, {t}D, '{r}', 'F', {DAY.format(1 + n)})" for o, p, s, n, q, d, t, r in (
        (1, 1, 1, 1, 50, 0.1, 0.08, "R"), (1, 2, 2, 2, 7, 0.1, 0.0, "A"), (2, 2, 1, 1, 49, 0.0, 0.08, "N"),
        (2, 3, 3, 2, 3, 0.0, 0.0, "R"), (9, 1, 1, 1, 4, 0.0, 0.0, "A"), (1, 9, 1, 3, 4, 0.0, 0.0, "A"),
        (1, 1, 9, 4, 4, 0.0, 0.0, "A"), ("NULL", 1, 1, 5, 4, 0.0, 0.0, "A"), (1, "NULL", 1, 6, 4, 0.0, 0.0, "A"),
        (1, 1, "NULL", 7, 4, 0.0, 0.0, "A"))]
    rows = {
        "lineitem": lines,
        "orders": [f"(1, 5, 'F', 1D, {DAY.format(1)}, '1-URGENT')", f"(2, 6, 'P', 1D, {DAY.format(2)}, '2-HIGH')",
                   f"(2, 7, 'O', 1D, {DAY.format(3)}, '5-LOW')", f"(NULL, 7, 'O', 1D, {DAY.format(3)}, '5-LOW')"],
        "part": ["(1, 'a', 'b', 'SMALL', 1, 1D)", "(2, 'a', 'b', NULL, 7, 1D)", "(3, 'a', 'b', 'LARGE', 3, 1D)",
                 "(3, 'a', 'b', 'LARGE', 4, 1D)", "(NULL, 'a', 'b', 'LARGE', 4, 1D)"],
        "supplier": ["(1, 'a', 1, 1D)", "(2, 'a', 2, 1D)", "(2, 'a', 1, 1D)", "(3, 'a', NULL, 1D)", "(NULL, 'a', 1, 1D)"],
        "nation": ["(1, 'PERU', 1)", "(2, 'CHINA', 2)"],
        "region": ["(1, 'AMERICA')", "(2, 'ASIA')"],
    }
    for name, values in rows.items():
        columns = [c.split() for c in LAYOUTS[name].split(", ")]
        spark.sql(f"SELECT * FROM VALUES {', '.join(values)} AS t({', '.join(c for c, _ in columns)})").selectExpr(
            *[f"CAST({c} AS {kind}) AS {c}" for c, kind in columns]).coalesce(1).write.parquet(str(tmp_path / "made" / name))
        next((tmp_path / "made" / name).glob("*.parquet")).rename(tmp_path / f"{name}.parquet")
    return str(tmp_path)


def moved_by(df):
    """The keys that rows are dealt by, as the plan without broadcasts of Spark's own choice has them."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sorted(set(re.findall(r"hashpartitioning\((l_\w+)#", plan)))


@pytest.fixture
def large(spark):
    """A session that takes no table for small by itself, as with large ones."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lines_move_to_parts_and_then_orders_only(spark, tables, large):
    """Beside tables too large to broadcast, lines are shuffled twice, and not with what orders add (F19, F20)."""
    feed = feeds.feed(spark, tables).select(*feeds.FEED)
    assert moved_by(feed) == ["l_orderkey", "l_partkey"]
    plan = feed._jdf.queryExecution().optimizedPlan()
    joins = re.findall(r"Join Inner, \((\w+)#\d+L? = (\w+)#", plan.toString())
    assert joins.index(("l_orderkey", "o_orderkey")) < joins.index(("l_partkey", "p_partkey"))  # the outer join comes first in print


@pytest.mark.parametrize("limit", [feeds.NARROW_TABLE, 0])
def test_order_of_the_joins_changes_no_row(spark, tables, large, monkeypatch, limit):
    monkeypatch.setattr(feeds, "NARROW_TABLE", limit)
    feed = feeds.feed(spark, tables).drop(*feeds.ROW_ID)
    assert moved_by(feed) == ["l_orderkey", "l_partkey"] + ([] if limit else ["l_suppkey"])
    assert feed.count() > 0 and difference(feed, connect(tables), feeds.FEED_SQL) is None
