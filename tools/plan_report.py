"""Plan-shape report of every registered query (from the physical plan).

    python tools/plan_report.py [sf_dir]

Per query: hash shuffles, broadcasts, single-partition exchanges (global
windows / global sorts / final one-row aggregates), window operators without a
partition key, sort aggregates, Expand (multi-distinct), cartesian and
nested-loop joins, scalar subqueries. Prints one JSON line per query and a
summary line.
"""

from __future__ import annotations

import json
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def _single_partition_windows(plan: str) -> int:
    """Window operators fed by an ``Exchange SinglePartition`` (no partition key)."""
    lines = plan.splitlines()
    n = 0
    for i, line in enumerate(lines):
        if "Window [" in line and "WindowGroupLimit" not in line:
            for nxt in lines[i + 1:i + 6]:
                if "Exchange" in nxt:
                    n += "SinglePartition" in nxt
                    break
    return n


def shape(plan: str) -> dict:
    return {
        "windows": plan.count("Window ["),
        "single_partition_windows": _single_partition_windows(plan),
        "hash_shuffles": len(re.findall(r"Exchange hashpartitioning", plan)),
        "range_shuffles": len(re.findall(r"Exchange rangepartitioning", plan)),
        "single_partition_exchanges": len(re.findall(r"Exchange SinglePartition", plan)),
        "broadcasts": len(re.findall(r"BroadcastExchange", plan)),
        "sort_aggregates": plan.count("SortAggregate"),
        "expand": plan.count("Expand ["),
        "cartesian": plan.count("CartesianProduct") + plan.count("BroadcastNestedLoopJoin"),
        "scalar_subqueries": plan.count("Subquery subquery"),
        "take_ordered": plan.count("TakeOrderedAndProject"),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    from retailyze.plans import QUERIES
    from retailyze.session import get_spark
    spark = get_spark("local[4]", shuffle_partitions=8)
    total: dict[str, int] = {}
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = shape(plan)
        for k, v in s.items():
            total[k] = total.get(k, 0) + (1 if v else 0)
        print(json.dumps({"query": name, **s}))
    print(json.dumps({"queries": len(QUERIES), "queries_with": total}))


if __name__ == "__main__":
    main()
