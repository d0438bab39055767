"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local threads (default 8). Each query
runs once to warm up and then BENCH_RUNS times (default 1); the best time counts. Queries that train
forests and nets come last and run once. Every run computes all rows and all columns. The line is printed
anew after every query, so the last one holds whatever has been measured when the time is up.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import SparkSession

from seasonlens.queries import QUERIES
from seasonlens.session import release, with_defaults

HEADLINE = [
    "w11_history", "w11_history_hot", "w12_history", "w12_defence", "w_running", "w_rank",
    "p_flags", "p_encode", "j_prev_week", "j_context", "j_context_name", "j_inner_multi", "j_roster",
    "a_game_totals", "a_metrics", "o_topk", "u_home_away", "m_split", "m_scale", "m_ols1",
    "f1_features", "f2_features", "f3_features", "f4_defence_rank",
    "q1_leaderboard_all", "q2_compare", "q3_snapshot", "q5_choices",
    "m_ols", "m_forest", "f5_predictions", "m_ensemble",
]
ONCE = {"m_forest", "m_ensemble", "f5_predictions"}


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        with_defaults(SparkSession.builder.master(f"local[{cpus}]").appName("bench"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    scale = re.search(r"sf([\d.]+)", sf_dir)
    times = {}
    for name in names:
        if name not in ONCE:
            seconds(spark, name, sf_dir)
        times[name] = round(min(seconds(spark, name, sf_dir) for _ in range(1 if name in ONCE else runs)), 3)
        release(spark)
        print(json.dumps({
            "metric": "total_wall_time",
            "value": round(sum(times.values()), 3),
            "unit": "sec",
            "queries": times,
            "sf": float(scale.group(1)) if scale else sf_dir,
        }), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
