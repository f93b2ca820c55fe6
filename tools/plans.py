"""Summarize the physical plan of every registered query.

    python tools/plans.py [sf_dir] > PLANS.md

For each query: shuffle exchanges, broadcast exchanges, join strategies,
aggregate strategies, windows, and whether filters reached the parquet scans.
The plans are the initial (pre-AQE) physical plans, so at small scale a
sort-merge join listed here may still become a broadcast join at run time.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martlet.plans import catalog  # noqa: E402
from martlet.session import local_session  # noqa: E402

NODES = [
    "Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange RoundRobinPartitioning",
    "Exchange SinglePartition", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin",
    "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "HashAggregate",
    "SortAggregate", "ObjectHashAggregate", "WindowGroupLimit", "Window", "TakeOrderedAndProject",
    "Generate", "Union", "BatchEvalPython", "ArrowEvalPython",
]


def summarize(plan: str) -> dict[str, int]:
    c = Counter()
    for line in plan.splitlines():
        body = re.sub(r"^[\s:+\-*]*", "", line)
        for n in NODES:
            if body.startswith(n):
                c[n] += 1
                break
    c["scans with pushed filters"] = len(re.findall(r"PushedFilters: \[[^\]]+\]", plan))
    c["parquet scans"] = plan.count("FileScan parquet")
    return c


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, shuffle_partitions=16)
    print("# Physical plan summary\n")
    print(f"Generated by `tools/plans.py` over `{sf_dir}` (initial plans, before AQE re-planning).\n")
    cols = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
            "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "BroadcastNestedLoopJoin",
            "HashAggregate", "SortAggregate", "ObjectHashAggregate", "WindowGroupLimit", "Window",
            "TakeOrderedAndProject", "BatchEvalPython", "parquet scans", "scans with pushed filters"]
    short = ["hash exch", "range exch", "single exch", "bcast exch", "SMJ", "BHJ", "BNLJ", "HashAgg",
             "SortAgg", "ObjHashAgg", "WinGroupLimit", "Window", "TopK", "PythonUDF", "scans",
             "pushed"]
    print("| query | " + " | ".join(short) + " |")
    print("|---|" + "---|" * len(short))
    for name, fn in catalog.QUERIES.items():
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        c = summarize(plan)
        print(f"| {name} | " + " | ".join(str(c.get(k, 0)) for k in cols) + " |", flush=True)


if __name__ == "__main__":
    main()
