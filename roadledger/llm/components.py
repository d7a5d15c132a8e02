"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadledger.llm.common import dropped
from roadledger.session import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the least node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")), "least")
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them; ``a`` is the larger end of every edge."""
    least = written(edges.groupBy("a").agg(F.min("b").alias("low")), "least")
    others = edges.join(least, "a").where("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return others.unionByName(least.select("a", F.col("low").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: bigint); the component is its least node.

    Each round is written to the work folder; the rounds needed grow with the logarithm of the largest component.
    Hubs are reduced by map-side minima, which are stored, so that AQE can split the join of a hub's neighbours
    with its one minimum. Loops, repeated and reversed links do no harm; no links give no rows.
    """
    spark = links.sparkSession
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        large = written(_large_star(edges), "large-star")
        small = written(_small_star(large), "small-star")
        dropped(spark, edges, large)
        edges, before = small, mark
        mark = _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
