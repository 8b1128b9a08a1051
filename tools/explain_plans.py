"""Summarise the physical plan of every registered query.

    python tools/explain_plans.py [sf_dir] > PLANS.md

For each query: the number of shuffles and their kinds, join strategies,
top-k / group-limit operators, Python operators, and the parquet scans with
their pushed filters and read schema (from ``explain("formatted")``).
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KINDS = ["BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
         "CartesianProduct", "TakeOrderedAndProject", "WindowGroupLimit", "Window", "Expand",
         "Generate", "MapInPandas", "HashAggregate", "ObjectHashAggregate", "SortAggregate",
         "Scan ExistingRDD", "Subquery"]


def summarise(plan: str) -> list[str]:
    lines = plan.splitlines()
    nodes = Counter()
    for ln in lines:
        m = re.match(r"^\((\d+)\) (.+?)(?: \[codegen id : \d+\])?$", ln.strip())
        if m:
            nodes[m.group(2).split(" [")[0].strip()] += 1
    ex = Counter()
    for ln in lines:
        m = re.match(r"^Arguments: (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)",
                     ln.strip())
        if m:
            ex[m.group(1)] += 1
    out = []
    shuffles = sum(v for k, v in nodes.items() if k == "Exchange")
    reused = nodes.get("ReusedExchange", 0)
    out.append(f"shuffles: {shuffles}" + (f" ({', '.join(f'{k} x{v}' for k, v in ex.items())})" if ex else "")
               + (f"; reused exchanges: {reused}" if reused else ""))
    bx = nodes.get("BroadcastExchange", 0)
    if bx:
        out.append(f"broadcast exchanges: {bx}")
    ops = [f"{k} x{nodes[k]}" for k in KINDS if nodes.get(k)]
    if ops:
        out.append("operators: " + ", ".join(ops))
    scans = re.findall(r"\(\d+\) Scan parquet.*?\nOutput.*?\n.*?Location: [^\[]*\[([^\]]*)\].*?"
                       r"(?:PushedFilters: (\[[^\n]*\]))?\nReadSchema: ([^\n]*)", plan, re.S)
    for loc, pushed, schema in scans:
        name = os.path.basename(loc.rstrip("/"))
        out.append(f"scan {name}: ReadSchema {schema}" + (f"; PushedFilters {pushed}" if pushed and pushed != "[]" else ""))
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from roadlens.registry import QUERIES
    from roadlens.session import build_session
    # static planning shows exchange reuse (AQE applies it only when stages run)
    spark = build_session("local[8]", 8, extra={"spark.sql.adaptive.enabled": "false"})
    print(f"# Physical plans of the registered queries\n\nGenerated by `tools/explain_plans.py {sf_dir}` "
          "with static planning (AQE off) so that exchange reuse is visible; with AQE on, joins may "
          "still become broadcast joins at run time and small partitions are coalesced. Queries that "
          "run a job while being built (checkpoints, streams) show the plan of their final step.\n")
    for name, q in QUERIES.items():
        df = q(spark, sf_dir)
        plan = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        print(f"## {name}\n")
        for ln in summarise(plan):
            print(f"- {ln}")
        print()
    spark.stop()


if __name__ == "__main__":
    main()
