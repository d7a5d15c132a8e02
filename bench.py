"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import contextlib
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "e_hourly_events", "e_hourly_mart", "e_risk_mart", "e_hotspots", "e_kpis", "e_cross_counts", "e_rollup",
    "e_quantiles", "c_star_dashboard", "c_anti_new", "f_keep_first", "f_chrono_split", "b_gate_accounting",
    "p_dim_date", "p_dim_location", "p_fact", "p_mart_refresh", "j_psi", "j_feature_drift", "j_auc_ovr", "j_report",
    "j_smote", "j_train_forest", "a_csv_scan_skip", "h_stream_ingest",
]


def main() -> None:
    from roadledger.catalog import QUERIES
    from roadledger.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    with contextlib.redirect_stdout(sys.stderr), tempfile.TemporaryDirectory(prefix="bench-") as work:
        spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="12g",
                              spark__checkpoint__dir=work)
        spark.sparkContext.setLogLevel("ERROR")
        # One pass over the fact table first, so that the start of the JVM is not counted as a query.
        spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
        times = {}
        for name in HEADLINE:
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
        spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
