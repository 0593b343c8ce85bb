"""Headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line.

A query's time covers building the plan and computing every output column of every row (a write
to the ``noop`` sink). One untimed query warms the JVM up.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from entry_queries import QUERIES  # noqa: E402
from fieldspark.session import local_session  # noqa: E402

HEADLINE = [
    "daily_regional_mean", "climatology", "series_align", "grid_stride",
    "double_entry_diff", "distinct_entry_diff", "full_join_diff", "grouped_entry_diff", "missing_keys",
    "collapse_events", "soak_time", "prior_event_asof",
    "count_summary", "cpue", "cpue_by_type", "weekly_totals", "explore_summary", "explore_map",
    "zone_density", "size_distribution", "weighted_sample", "biomass_model",
    "pivot_stats", "derived_metrics", "zone_table", "label_by_year",
    "box_summary", "log_histogram", "exp_fit", "last_per_group",
]


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cpus, partitions=8)
    QUERIES["cpue"](spark, directory).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in chosen:
        start = time.perf_counter()
        QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", directory)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall-clock",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
