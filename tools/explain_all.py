"""Write the formatted physical plan of every registered query to a folder and
print a one-line summary per query (shuffles, joins, aggregate kinds).

Usage: python tools/explain_all.py OUT_DIR [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summary(plan: str) -> str:
    main = plan.split("===== Subqueries =====")[0]
    shuffles = len(re.findall(r"Arguments: hashpartitioning", main))
    ranges = len(re.findall(r"Arguments: rangepartitioning", main))
    joins = sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin)", plan)))
    aggs = sorted(set(re.findall(r"(ObjectHashAggregate|SortAggregate|HashAggregate)", plan)))
    python = "PYTHON" if re.search(r"(BatchEvalPython|ArrowEvalPython)", plan) else ""
    cartesian = "CARTESIAN" if re.search(r"(CartesianProduct|BroadcastNestedLoopJoin)", plan) else ""
    return f"hash-shuffles={shuffles} range-shuffles={ranges} joins={joins} aggs={aggs} {python}{cartesian}".strip()


def main() -> None:
    out_dir = sys.argv[1]
    args = sys.argv[2:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)]

    from tidewater.queries import QUERIES
    from tidewater.session import get_session

    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    os.makedirs(out_dir, exist_ok=True)
    for name in names or list(QUERIES):
        df = QUERIES[name](spark, sf_dir)
        plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        with open(os.path.join(out_dir, f"{name}.txt"), "w") as fh:
            fh.write(plan)
        print(f"{name:28s} {summary(plan)}")


if __name__ == "__main__":
    main()
