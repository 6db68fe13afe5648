"""Times the headline queries and prints one JSON line."""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from matchvault import build_session  # noqa: E402
from matchvault.plans.catalogue import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = [
    "latest_standings", "snapshot_delta", "snapshot_delta_repeated_keys", "hub_load",
    "scd2_satellite", "scd2_incremental", "link_merge", "pit_table", "dimension_view", "match_wide",
    "side_unpivot", "player_log_wide", "season_totals_a", "home_form", "overall_form", "gap_fill",
    "quartiles_by_class", "temporal_tail_split", "roc_curve", "model_leaderboard",
    "top_predictions", "upsert_latest",
]


def run(spark, name):
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    spark = build_session(
        f"local[{CPUS}]",
        "matchvault-bench",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    times = {}
    for name in names:
        run(spark, name)  # warm-up
        times[name] = round(statistics.median(run(spark, name) for _ in range(RUNS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
