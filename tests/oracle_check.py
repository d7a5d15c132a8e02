"""Compares the registered queries with their SQL: python tests/oracle_check.py [sf_dir] [name ...]

Columns are put in name order, rows are compared as sorted multisets, values exactly.
"""

from __future__ import annotations

import glob
import os
import sys
import tempfile
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def as_table(arrow):
    names = sorted(arrow.column_names)
    rows = list(zip(*[arrow.column(n).to_pylist() for n in names])) if arrow.num_rows else []
    return names, sorted(rows, key=repr), {n: str(arrow.schema.field(n).type) for n in names}


def difference(spark_df, con, sql: str) -> str | None:
    """None if both give the same rows, else a description."""
    left, right = as_table(spark_df.toArrow()), as_table(con.execute(sql).to_arrow_table())
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}"
    soft = {"large_string": "string"}
    kinds = {n: (left[2][n], right[2][n]) for n in left[0]
             if soft.get(left[2][n], left[2][n]) != soft.get(right[2][n], right[2][n])}
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} / {len(right[1])} {kinds or ''}"
    wrong = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(left[1])} rows differ, first {left[0]}: {wrong[0][0]} / {wrong[0][1]} {kinds or ''}"
    return f"types {kinds}" if kinds else None


def main() -> int:
    from roadledger.catalog import ORACLES, QUERIES
    from roadledger.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("oracle_check", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g",
                          spark__checkpoint__dir=tempfile.mkdtemp(prefix="oracle-"))
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                found = difference(df, con, ORACLES[name])
            else:
                found = f"no SQL, {df.count()} rows"
        except Exception as error:
            found = "ERROR " + str(error).split("JVM stacktrace")[0][:600]
            if "-v" in os.environ.get("CHECK_FLAGS", ""):
                traceback.print_exc()
        bad += found is not None
        print(f"{time.time() - start:7.2f}s  {name:24s} {'ok' if found is None else found}", flush=True)
    spark.stop()
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
