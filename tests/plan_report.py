"""Write PLANS.md: per registered query, the shuffles, join strategies and
broadcasts of the final (post-AQE) physical plan after running it.

    python tests/plan_report.py [sf_dir]              # all queries, into PLANS.md
    python tests/plan_report.py sf_dir name [name..]  # some queries, their rows printed
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shopcube.session import get_session  # noqa: E402

NODES = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange RoundRobin",
         "Exchange SinglePartition", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin",
         "ShuffledHashJoin", "HashAggregate", "ObjectHashAggregate", "SortAggregate", "Window",
         "Expand", "TakeOrderedAndProject", "AQEShuffleRead", "ReusedExchange"]


def summarize(plan: str) -> dict:
    out = {}
    for n in NODES:
        c = plan.count(n)
        if c:
            out[n] = c
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from shopcube.plans.registry import QUERIES
    only = sys.argv[2:]
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    lines = ["# PLANS", "",
             f"Final physical plans (after AQE) of every registered query on `{sf_dir}`, "
             "local[8], shuffle partitions 8.  Counts of plan nodes; generated by "
             "`tests/plan_report.py`.  At sf0.1 AQE broadcasts the order side of the "
             "line-order join by measured size; at scale those joins are sort-merge joins.", "",
             "| query | nodes | scans (columns read) |", "| --- | --- | --- |"]
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        qe = df._jdf.queryExecution()
        plan = qe.executedPlan().toString()
        nodes = ", ".join(f"{k} ×{v}" for k, v in summarize(plan).items())
        scans = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*?Location: [^\[]*\[file:[^\]]*/"
                           r"([a-z]+)\.parquet\]", plan)
        scan_s = "; ".join(f"{t}: {len(cols.split(','))}" for cols, t in scans) or "–"
        lines.append(f"| `{name}` | {nodes} | {scan_s} |")
        print(lines[-1] if only else name, flush=True)
    if only:
        return
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "PLANS.md"), "w") as f:
        f.write("\n".join(lines) + "\n")


if __name__ == "__main__":
    main()
