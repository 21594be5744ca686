"""Summarise the physical plan of every registered query (joins, exchanges, scans).

Usage: ``python tests/plan_report.py [sf_dir] > PLANS.md``
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

JOINS = r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)"


def main(argv):
    from tessera.session import build_session
    from tessera.plans.registry import QUERIES

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tests/plan_report.py` on `{sf_dir}` (AQE on, local[8]). Sizing jobs that run while a")
    print("query is built (polygon-side checkpoints, nearest rounds) are not part of the final plan shown.\n")
    print("| query | joins | exchanges | parquet columns read |")
    print("|---|---|---|---|")
    for name, fn in QUERIES.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        joins = re.findall(JOINS, plan)
        joins_s = ", ".join(f"{j}×{joins.count(j)}" for j in sorted(set(joins))) or "-"
        exchanges = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", plan))
        reads = sorted(set(re.findall(r"ReadSchema: struct<([^>]*)>", plan)))
        reads_s = "; ".join(r.replace(":", " ") for r in reads) or "(checkpointed / generated input)"
        print(f"| {name} | {joins_s} | {exchanges} | {reads_s} |")


if __name__ == "__main__":
    main(sys.argv)
