"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_RUNS     timed runs per query, the median counts (default 3, after one warm-up)
BENCH_ALL      time every registered query once instead
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from millrace.session import get_session
from registry import QUERIES

HEADLINE = [
    "src13_map_codes", "cln01_indicators", "cln02_housing", "cln03_bars", "dim01_time", "dim03_region", "dim04_value",
    "dim08_asset_value", "fct01_indicator", "fct02_housing", "fct03_asset", "fct04_fact_value", "jn02_star_chain",
    "agg01_asset_month", "agg02_asset_year", "agg04_asset_lifetime", "agg06_state_year", "win02_dense_key_columns",
    "win03_first_per_id", "yoy01_asset", "api01_inflation_adjusted", "api03_housing_monthly", "api04_asset_daily",
    "dq02_foreign_keys", "doc01_asset_day", "doc03_housing", "doc09_asset_trend", "emb01_embed", "vec01_top_k",
    "vec04_top_k_indicators", "vec07_balanced", "vec12_question_analysis", "str01_bars_from_trades", "str04_upsert_by_year",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    everything = bool(os.environ.get("BENCH_ALL"))
    runs = 1 if everything else int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    # The clean and star tables are built here, once, as a deployment would.
    built = run(spark, "api04_asset_daily", sf_dir)
    times = {}
    for name in list(QUERIES) if everything else HEADLINE:
        if not everything:
            run(spark, name, sf_dir)
        times[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(runs)), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "build_seconds": round(built, 3), "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
