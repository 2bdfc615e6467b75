"""Audit the final physical plans of the registered batch queries.

    python tools/plan_audit.py [sf_dir]

Per query: shuffle exchanges, broadcast exchanges, and any operator worth a
second look (sort-merge / nested-loop / cartesian joins, single-partition
exchanges, Python evaluation), plus the columns each scan reads.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from streamkit.plans.queries import QUERIES  # noqa: E402
from streamkit.session import build_session  # noqa: E402

FLAGS = ("SortMergeJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "SinglePartition", "BatchEvalPython",
         "ArrowEvalPython", "SortAggregate")


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    print("| query | shuffles | broadcasts | flags | scans |")
    print("|---|---|---|---|---|")
    for name, fn in sorted(QUERIES.items()):
        if name.startswith("stream_"):
            continue
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()  # final AQE plan
        plan = df._jdf.queryExecution().executedPlan().toString()
        shuffles = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)",
                                  plan))
        broadcasts = plan.count("BroadcastExchange")
        flags = [f for f in FLAGS if f in plan]
        scans = sorted(set(re.findall(r"ReadSchema: struct<([^>]*)>", plan)))
        print(f"| {name} | {shuffles} | {broadcasts} | {', '.join(flags) or '-'} | {'; '.join(scans)} |")
    spark.stop()


if __name__ == "__main__":
    main()
