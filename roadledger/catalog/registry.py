"""Where the catalog modules put their queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query and, if there is one, the SQL that must give the same rows."""

    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


# Layouts of the driver tables; declared, so that reading one starts no job to look for its schema.
LAYOUTS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                 "l_shipdate timestamp_ntz"),
    "events": ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"),
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


# Up to as many files a file's number is found in a list; paths of more are kept as they are.
LISTED_FILES = 64


def file_of(rows: DataFrame) -> Column:
    """What tells the files of a stored table apart and puts them in order: the number of a row's file in path order, which
    is far narrower in sorts and shuffles than its path."""
    path = F.col("_metadata.file_path")
    paths = sorted(r[0] for r in rows.select(path).distinct().limit(LISTED_FILES + 1).collect())
    if len(paths) > LISTED_FILES:
        return path
    return F.array_position(F.array(*[F.lit(p) for p in paths]).cast("array<string>"), path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(LAYOUTS[name]).parquet(f"{sf_dir}/{name}.parquet")
