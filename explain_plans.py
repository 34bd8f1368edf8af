"""Summarise the executed (final adaptive) plans of the key queries.

Usage: python explain_plans.py [sf_dir] [query ...]
Prints, per query: operator counts (exchanges, join strategies, aggregates, windows, Python
nodes) and, for every parquet scan, its pushed filters and read schema width.
"""

from __future__ import annotations

import re
import sys
from collections import Counter

sys.path.insert(0, __file__.rsplit("/", 1)[0])

from poolwright.registry import QUERIES  # noqa: E402
from poolwright.session import local_session  # noqa: E402

NODES = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition", "BroadcastExchange",
         "ReusedExchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
         "CartesianProduct", "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Window", "WholeStageCodegen",
         "BatchEvalPython", "ArrowEvalPython", "Scan ExistingRDD"]
DEFAULT = ["c20_features_all", "fs_fair_share", "ap6_placements_refreshed", "m04_rules", "c13_open_callbacks"]


def summarize(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[0]  # the adaptive plan prints the final plan first
    counts = {k: plan.count(k) for k in NODES if plan.count(k)}
    scans = Counter()
    for line in plan.splitlines():
        if "FileScan parquet" not in line:
            continue
        table = re.search(r"/(\w+)\.parquet", line)
        pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
        schema = re.search(r"ReadSchema: struct<([^>]*)>", line)
        width = len(schema.group(1).split(",")) if schema and schema.group(1) else 0
        scans[(table.group(1) if table else "other", width, (pushed.group(1) if pushed else "")[:120])] += 1
    lines = [f"  {k}: {v}" for k, v in counts.items()]
    lines += [f"  scan {t:12s} cols={n} x{c} pushed=[{p}]" for (t, n, p), c in sorted(scans.items())]
    return "\n".join(lines)


def main(argv):
    sf_dir = next((a for a in argv if a.startswith("/")), "/root/testdata/sf0.1")
    names = [a for a in argv if not a.startswith("/")] or DEFAULT
    spark = local_session(shuffle_partitions=16, app="poolwright-explain")
    for name in names:
        print(f"== {name}")
        print(summarize(QUERIES[name][0](spark, sf_dir)))


if __name__ == "__main__":
    main(sys.argv[1:])
