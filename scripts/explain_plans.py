"""Print the physical plan of registered queries, with a one-line summary of
what matters at scale: exchanges (shuffles), broadcasts, join strategies,
scans and their pushed filters / read schemas, and warning signs (nested-loop
or cartesian joins, Python evaluation, windows).

Usage: python scripts/explain_plans.py [sf_dir] [query ...] [--formatted]
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

WARNINGS = ["BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython",
            "ArrowEvalPython", "Window"]


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    formatted = "--formatted" in sys.argv
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    wanted = [a for a in args if not a.startswith("/")]
    from reelsync.session import build_session
    spark = build_session("local[8]", conf={
        "spark.sql.shuffle.partitions": "8",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="plans-ck-", dir="/tmp")})
    from reelsync.plans import QUERIES
    for name, fn in QUERIES.items():
        if (wanted and name not in wanted) or name.startswith("stream") \
                or name == "incremental_documents":
            continue
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|"
                           r"BroadcastNestedLoopJoin|CartesianProduct)", plan)
        summary = {
            "exchanges": plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning")
            + plan.count("Exchange RoundRobin") + plan.count("Exchange SinglePartition"),
            "broadcasts": plan.count("BroadcastExchange"),
            "joins": {j: joins.count(j) for j in sorted(set(joins))},
            "scans": plan.count("FileScan parquet") + plan.count("Scan ExistingRDD"),
            "warnings": [w for w in WARNINGS if w in plan],
        }
        print(f"== {name}: {summary}")
        if formatted:
            df.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
