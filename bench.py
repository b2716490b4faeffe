"""Seconds per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and is then timed once, computing every output row.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from tieout.catalogue import QUERIES
from tieout.session import local

HEADLINE = (
    "cdc_latest_per_key",
    "cdc_apply_changes",
    "cut_landed_counts",
    "cut_longest_complete_prefix",
    "deliveries_check_parts",
    "deliveries_publish_verdicts",
    "deliveries_current_rows",
    "deliveries_independent_check",
    "gate_cell_totals",
    "gate_breaks",
    "gate_row_diff_of_repeated_keys",
    "release_read_head",
    "events_dedup",
    "features_as_of",
    "quality_evaluate",
    "serving_daily_rollup",
    "signals_score",
)


def timed(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = local(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in wanted:
        timed(QUERIES[name], spark, folder)
        seconds[name] = round(timed(QUERIES[name], spark, folder), 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total seconds over the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
