"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. Each query is planned and run twice, every
row computed and discarded; the faster run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tallymark.queries import QUERIES
from tallymark.session import local_session

HEADLINE = [
    "profile_lineitem",
    "profile_all_checks",
    "check_summary",
    "hash_profile_md5",
    "hash_profile_compare",
    "table_equality",
    "bag_diff",
    "row_status_counts",
    "cell_diff_keyed",
    "cell_diff_unique_key",
    "column_mismatch",
    "keyed_diff_duplicates",
    "cell_diff_positional",
    "cell_diff_positional_repeats",
    "custom_query_compare",
    "job_summary",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, "bench")
    times = {}
    for name in names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
    print(
        json.dumps(
            {
                "metric": "reconciliation queries, total time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
