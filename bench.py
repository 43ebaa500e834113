"""Time the headline queries from the raw tables and print one JSON line.

Each query starts without kept data and runs to a sink that discards rows. BENCH_SF_DIR names the
tables, BENCH_CPUS the cores. The median of BENCH_RUNS runs counts (3 by default); the first run of
each query also compiles its code and is not counted.
"""

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tradewind.session import build_session
from tradewind.testbed.registry import build_queries

HEADLINE = [
    # raw tables to signal tables
    "category_trends",
    "search_signals",
    "social_buzz",
    "consumer_spend",
    "retail_vs_ecomm",
    # raw feeds and cleaning over every raw row
    "src_listings",
    "src_bestsellers",
    "src_search_interest",
    "src_social_posts",
    "src_spend_csv",
    "clean_category_trends",
    "clean_search_signals",
    "clean_social_buzz",
    "clean_consumer_spend",
    # scoring, read models and analytical queries, all from the raw tables
    "upsert",
    "niche_scores",
    "mv_category_leaderboard",
    "mv_channel_comparison",
    "mv_niche_finder",
    "mv_trends_explorer",
    "wf_sell_through_delta",
    "wf_moving_avg",
    "wf_interest_momentum",
    "wf_buzz_momentum",
    "wf_rank_change",
    "wf_percentile",
    "cte_score_breakdown",
    "cte_rising_categories",
    "cte_channel_gap",
    "cte_deep_dive",
    "cte_top_entries",
    "market_gauge",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = build_queries()
    seconds = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):
            spark.catalog.clearCache()
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries, each from raw tables",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": cpus,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
