"""Times the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import pathlib
import sys
import time

HEADLINE = [
    "p1_stg_transactions",
    "fct_daily_revenue",
    "dim_merchants",
    "fct_merchant_rollup",
    "fct_anomaly_summary",
    "w7_running_zscore",
    "w7_running_zscore_sliced",
    "t1_top_merchants",
    "a7_kpis",
    "a8_hourly_volume",
    "a17_pivot",
    "u3_symmetric_except",
    "u4_unpivot",
    "f8_generate_surrogate_key",
    "q14_mutually_exclusive_ranges",
    "q17_relationships_where",
    "q18_sequential_values",
    "q19_unique_combination",
    "q21_schema_contract",
    "d9_quality_report",
    "model_checks",
    "x3_zscore_anomaly",
    "x2_daily_spend",
]
#: queries whose throughput is reported, with the table they read row by row
THROUGHPUT = {"w7_running_zscore": "events", "x3_zscore_anomaly": "events", "x2_daily_spend": "events"}


def timed(run, spark, sf_dir) -> float:
    start = time.perf_counter()
    # Every row is computed; nothing is fetched to the driver.
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))
    from tillstream.queries import QUERIES
    from tillstream.session import local_session

    spark = local_session(cpus, "bench", **{"spark.sql.shuffle.partitions": cpus})
    wanted = sys.argv[1:] or HEADLINE
    for name in ("w7_running_zscore", "t1_top_merchants"):  # start the JVM code paths and Python workers
        timed(QUERIES[name], spark, sf_dir)
    seconds = {}
    for name in wanted:
        seconds[name] = round(min(timed(QUERIES[name], spark, sf_dir) for _ in range(2)), 3)
        print(f"{name}: {seconds[name]} s", file=sys.stderr, flush=True)
    rows = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in set(THROUGHPUT.values())}
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": pathlib.Path(sf_dir).name.removeprefix("sf"),
        "rows_per_sec": {n: round(rows[t] / seconds[n]) for n, t in THROUGHPUT.items() if n in seconds},
        "cpus": cpus,
    }
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
