"""Summarise the final (adaptive) physical plan of every registered query.

    python tools/plan_report.py [sf_dir] > PLANS.md

Counts operators in the executed plan: file scans, shuffle exchanges,
broadcast exchanges, reused exchanges, joins by strategy, windows, and any
nested-loop / cartesian / Expand operators (there should be none but the
unpivot's Expand).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfscope.registry import load_all  # noqa: E402
from shelfscope.session import local_session  # noqa: E402

PATTERNS = {
    "scans": r"FileScan |Scan ExistingRDD|Scan OneRowRelation",
    "shuffles": r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)",
    "broadcasts": r"BroadcastExchange",
    "reused": r"ReusedExchange",
    "bhj": r"BroadcastHashJoin",
    "smj": r"SortMergeJoin",
    "shj": r"ShuffledHashJoin",
    "windows": r"\bWindow \[",
    "nested/cartesian/expand": r"BroadcastNestedLoopJoin|CartesianProduct|Expand \[",
}


def final_plan(df) -> str:
    df.collect()
    txt = df._jdf.queryExecution().executedPlan().toString()
    if "== Final Plan ==" in txt:
        txt = txt.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return txt


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(cores=8, shuffle_partitions=16)
    print("# Executed plans\n")
    print(f"Final adaptive plans of every registered query at `{sf_dir}` (`tools/plan_report.py`). "
          "Queries that first land files (s1-s3, s10, s11, t1) are summarised by their read-back plan.\n")
    print("| query | " + " | ".join(PATTERNS) + " |")
    print("|---|" + "---|" * len(PATTERNS))
    for name, e in load_all().items():
        txt = final_plan(e.fn(spark, sf_dir))
        counts = [str(len(re.findall(p, txt))) for p in PATTERNS.values()]
        print(f"| {name} | " + " | ".join(counts) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
