"""Summarise the physical plans of registered queries (static plan, AQE off).

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
For each query: exchanges (with their partitioning keys), join strategies,
sorts, window operators, and the parquet scans' pushed filters / read schema.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tempolith.plans import catalog  # noqa: E402
from tempolith.session import get_spark  # noqa: E402

QUERIES = ["player_features", "ewm_features", "expanding_mean_date_rank", "rolling_stats", "allowed_ratio",
           "active_intervals", "interval_counters", "on_off_split", "availability", "enrich_lineitem",
           "members_roster", "top_lines", "evaluation_table", "entity_keys", "exclude_since_flag",
           "late_customers", "std_scale_fit"]


def summarise(plan: str) -> dict:
    lines = plan.splitlines()
    ex = [re.sub(r"#\d+L?", "", m.group(1)) for l in lines
          if (m := re.search(r"Exchange (\w+partitioning\([^)]*\)|SinglePartition|RoundRobinPartitioning\(\d+\))", l))]
    joins = [m.group(1) for l in lines if (m := re.search(r"\b(BroadcastHashJoin|SortMergeJoin|BroadcastNestedLoopJoin|"
                                                          r"ShuffledHashJoin|CartesianProduct)\b", l))]
    scans = []
    for l in lines:
        if "FileScan parquet" in l:
            t = re.search(r"/([a-z_]+)\.parquet", l)
            r = re.search(r"ReadSchema: struct<([^>]*)>", l)
            p = re.search(r"PushedFilters: \[([^\]]*)\]", l)
            scans.append(f"{t.group(1) if t else '?'}({(r.group(1) if r else '')[:80]}; pushed: "
                         f"{(p.group(1) if p else '')[:80] or '-'})")
    return {"exchanges": ex, "joins": joins, "sorts": sum(1 for l in lines if re.search(r"\bSort \[", l)),
            "windows": sum(1 for l in lines if re.search(r"\bWindow(GroupLimit)? \[", l) or " Window " in l),
            "scans": sorted(set(scans))}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark(master="local[4]", shuffle_partitions=8, extra={"spark.sql.adaptive.enabled": "false"})
    catalog.load_all()
    print("# Physical plan summary (static plans, AQE off)\n")
    print("Generated by `tools/plan_report.py`. With AQE on, small exchanges additionally become "
          "broadcasts and partitions coalesce at run time. Stages before a checkpoint have run when the "
          "plan is made and are not listed.\n")
    for name in QUERIES:
        df = catalog.QUERIES[name](spark, sf)
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        print(f"## {name}\n")
        print(f"* exchanges ({len(s['exchanges'])}): " + ("; ".join(s["exchanges"]) or "none"))
        print(f"* joins: {', '.join(s['joins']) or 'none'}")
        print(f"* sorts: {s['sorts']}, window operators: {s['windows']}")
        for sc in s["scans"]:
            print(f"* scan {sc}")
        print()


if __name__ == "__main__":
    main()
