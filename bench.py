"""Wall time of the registered queries, as one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]

Each query runs to the end into a ``noop`` sink. The data is read once before, so that the
first query does not pay for starting the engine.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from registry import ENTRIES
from touchline.session import local_session

HEADLINES = [
    "standings_current",
    "standings_one_pass",
    "standings_versions",
    "weekly_rankings",
    "weekly_rankings_inclusive",
    "streaks",
    "event_streaks",
    "daily_event_state",
    "match_facts",
    "per_side",
    "opponent_self_join",
    "playoff_matches",
    "points_by_venue",
    "latest_row_dedup",
    "id_batches",
    "stage_matches",
    "land_matches",
    "orphans_anti_join",
    "conditional_counts",
    "slugify",
    "dq_relationships",
    "dq_no_overlap",
    "dq_suite",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, "bench")
    names = sys.argv[1:] or HEADLINES

    def run(name: str) -> float:
        started = time.perf_counter()
        ENTRIES[name].query(spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    for table in ("orders", "lineitem", "events", "customer"):
        spark.read.parquet(f"{folder}/{table}.parquet").write.format("noop").mode("overwrite").save()
    run("standings_current")
    seconds = {name: round(run(name), 3) for name in names}
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
