"""Write PLANS.md: a physical-plan summary of every registered query.

Usage: python scripts/plan_report.py [sf_dir] > PLANS.md

Per query: exchanges, join and aggregate operators, windows, Python nodes,
and each scan's pushed filters and read schema.  Broadcast joins are
disabled while planning so the plans show the shapes used at scale (where
AQE may still turn a small side into a broadcast at run time)."""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyfold.plans.catalog import QUERIES  # noqa: E402
from tallyfold.session import build_session  # noqa: E402

NODES = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition", "SortMergeJoin",
         "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "HashAggregate",
         "SortAggregate", "ObjectHashAggregate", "Window", "Generate", "Union", "Expand", "ArrowEvalPython",
         "BatchEvalPython"]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")  # filters and columns of a scan in full
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    print("# PLANS\n")
    print("Physical plans of the registered queries (`scripts/plan_report.py`, broadcast joins off so the")
    print("plans show their at-scale shape). Counts are operators in the plan; `scans` lists each Parquet")
    print("scan's pushed filters and read columns. A query that writes or runs a stream when called shows")
    print("the plan of what it reads back; the jobs before it are in its operator.\n")
    for name, q in QUERIES.items():
        plan = q(spark, sf)._jdf.queryExecution().executedPlan().toString()
        c = Counter()
        for node in NODES:
            c[node] = plan.count(node)
        print(f"## {name}\n")
        print(", ".join(f"{k}: {v}" for k, v in c.items() if v) or "no exchange")
        for line in plan.splitlines():
            if "FileScan parquet" in line:
                pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", line)
                schema = re.search(r"ReadSchema: (struct<.*?>)", line)
                print(f"\n- scan: pushed [{pushed.group(1) if pushed else ''}], reads `{schema.group(1) if schema else ''}`")
        print()


if __name__ == "__main__":
    main()
