"""Summarise the physical plan of every registered query.

For each query: shuffles by kind, join strategies, aggregates, generators,
Python stages, and every Parquet scan's columns and pushed filters. The plan
is the one Spark prepares before running (adaptive execution may still turn
a sort-merge join into a broadcast join, or coalesce partitions, at runtime).

Usage: python -m tessera.plans.plan_report [sf_dir] > PLANS.md
"""

from __future__ import annotations

import re
import sys
from collections import Counter

_KINDS = [
    ("hash shuffle", r"Exchange hashpartitioning"),
    ("range shuffle", r"Exchange rangepartitioning"),
    ("single-partition shuffle", r"Exchange SinglePartition"),
    ("round-robin shuffle", r"Exchange RoundRobinPartitioning"),
    ("broadcast", r"BroadcastExchange"),
    ("sort-merge join", r"SortMergeJoin"),
    ("broadcast hash join", r"BroadcastHashJoin"),
    ("shuffled hash join", r"ShuffledHashJoin"),
    ("nested-loop join", r"BroadcastNestedLoopJoin|CartesianProduct"),
    ("hash aggregate", r"HashAggregate|ObjectHashAggregate|SortAggregate"),
    ("window", r"\bWindow\b"),
    ("group limit", r"WindowGroupLimit"),
    ("generate", r"\bGenerate\b"),
    ("Python (Arrow)", r"MapInPandas|ArrowEvalPython|FlatMapGroupsInPandas"),
    ("Python (row UDF)", r"BatchEvalPython"),
    ("checkpointed input", r"Scan ExistingRDD|LogicalRDD"),
]


_NOTES = """
Notes:

- The only single-partition steps are bounded tables: the per-partition row
  counts of `with_row_index` / `zip_rows` (one row per partition), which are
  then broadcast.
- Broadcasts are Spark's own size-checked choices (statistics below
  `spark.sql.autoBroadcastJoinThreshold`, or AQE runtime sizes), except the
  hot-key / hot-cube lists, which this package counts before broadcasting.
- The distance joins' hot-cube test and the crawl depth run as separate small
  jobs before the query is planned, so they do not appear here.
- Scans of `roundtrip-*` / `stream-*` folders read files the same query wrote
  first (round trips, streaming output); checkpointed inputs read checkpoints.
"""


def summarise(plan: str) -> dict:
    counts = {}
    for label, pattern in _KINDS:
        n = len(re.findall(pattern, plan))
        if n:
            counts[label] = n
    scans = []
    for line in plan.splitlines():
        if "FileScan" not in line:
            continue
        loc = re.search(r"Location: \w+\((\d+) paths?\)\[([^,\]]*)", line)
        table = "?"
        if loc:
            first = loc.group(2).rstrip("/").rsplit("/", 1)[-1].removesuffix(".parquet")
            table = first if loc.group(1) == "1" else f"{first} (+{int(loc.group(1)) - 1} more)"
        schema = re.search(r"ReadSchema: (\S+)", line)
        pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
        scans.append((table, schema.group(1) if schema else "?", pushed.group(1) if pushed else ""))
    return {"ops": counts, "scans": scans}


def main(argv) -> int:
    sys.path.insert(0, ".")
    from tessera.plans.registry import queries
    from tessera.session import get_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 16)
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `python -m tessera.plans.plan_report {sf_dir}` (Spark {spark.version}, "
          "AQE on, 16 shuffle partitions). Plans are as prepared before running; adaptive execution "
          "may still switch a sort-merge join to a broadcast join or coalesce partitions at runtime.\n")
    print("| Query | Operators | Parquet scans (columns read; pushed filters) |")
    print("| --- | --- | --- |")
    totals = Counter()
    for name, fn in queries().items():
        df = fn(spark, sf_dir)
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        totals.update(s["ops"])
        ops = ", ".join(f"{k} x{v}" for k, v in s["ops"].items()) or "projection only"
        scans = "<br>".join(f"{t}: `{c}`" + (f"; `{p}`" if p else "") for t, c, p in s["scans"])
        print(f"| {name} | {ops} | {scans} |")
    print("\nTotals over all queries: " + ", ".join(f"{k} {v}" for k, v in sorted(totals.items())) + ".")
    print(_NOTES)
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
