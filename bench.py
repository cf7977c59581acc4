"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sportlake.plans.registry import QUERIES  # noqa: E402
from sportlake.session import local_session  # noqa: E402

HEADLINE = [
    "counters",
    "ratios",
    "profile_totals",
    "rating_history",
    "final_profile",
    "chemistry",
    "cold_start",
    "assign_nearest",
    "predict_grid",
    "roster_checks",
    "player_profile",
    "win_chance",
    "fixture_answers",
    "match_details",
    "resolve_contains",
    "json_appearances",
    "stream_ratings",
    "stream_chemistry",
    "kmeans_cold_start",
    "resolve_players",
    "win_chance_answers",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    QUERIES["profile_totals"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    scale = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
