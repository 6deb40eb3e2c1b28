"""Benchmark the headline queries; prints one JSON line.

Each query is timed end to end as a user runs it: plan construction plus a
full execution into Spark's ``noop`` sink (every row is computed, nothing is
collected to the driver).  ``BENCH_SF_DIR`` (default /root/testdata/sf0.1)
and ``BENCH_CPUS`` (default 8) select the data and ``local[N]``.

Before timing, every headline query runs once on the smallest tables
(``BENCH_WARM_DIR``, default /root/testdata/sf0.001; not counted): it warms the
JVM's JIT and Spark's generated-code cache, as in a long-running session, so
the timings measure the work on the benchmark data rather than compilation.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tempolith.plans import catalog  # noqa: E402
from tempolith.session import get_spark  # noqa: E402

HEADLINE = [
    "player_features",          # P4 flagship: full leakage-safe feature build
    "ewm_features_gaps",        # W7-W8 with NULL gaps
    "expanding_mean_date_rank",  # W2 + W3 (second exchange on date)
    "rolling_stats",            # W4-W6
    "allowed_ratio",            # W19-W20 (daily sums + EWM + ranks)
    "active_intervals",         # W24 active-set reconstruction
    "interval_counters",        # C11 + D8
    "on_off_split",             # D5-D7
    "availability",             # P1 (names, dates, status parsing, union, dedupe)
    "enrich_lineitem",          # C1, C2, C13 joins over lineitem
    "members_roster",           # C12, D9, U4
    "top_lines",                # S2
    "evaluation_table",         # M15-M19
    "entity_keys",              # F1, F2 over whole documents
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(app="tempolith-bench", master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus))
    catalog.load_all()
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    for name in HEADLINE:                      # warm-up on the smallest tables, not counted
        catalog.QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.time()
        df = catalog.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
