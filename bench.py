"""Time the headline queries: one JSON line on stdout.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_QUERIES``
a comma list of queries (``all`` for every one), ``BENCH_RUNS`` the warm runs
of which the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tidemark.registry import QUERIES
from tidemark.session import local_session

HEADLINE = [
    "scan_incremental",
    "coerce_types",
    "split_properties",
    "flatten_envelope",
    "clinical_observation",
    "redact_email",
    "scd1_apply",
    "scd1_apply_probe",
    "scd2_apply",
    "apply_deletes",
    "snapshot_diff",
    "latest_per_key",
    "dedupe_rows",
    "per_key_since",
    "changed_parent_children",
    "inherit_parent",
    "junction",
    "fan_out",
    "tree_walk",
    "messages_per_channel",
    "messages_with_replies",
    "report_daily",
    "ts_summary_daily",
    "ts_time_weighted",
    "ts_interpolate",
    "ts_plot",
    "values_at",
    "column_population",
    "nested_paths",
    "stream_upsert",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if asked == "all" else asked.split(",") if asked else HEADLINE
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, os.environ.get("BENCH_MEMORY", "8g"))
    seconds: dict[str, float] = {}
    for name in names:
        took = []
        for run in range(runs + 1):
            began = time.perf_counter()
            # every column is worked out, nothing is written or brought back
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            if run or runs == 0:
                took.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(took), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    line = {
        "metric": "headline queries, total of median warm seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main()
