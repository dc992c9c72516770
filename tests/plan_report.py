"""Print a per-query summary of physical plans as a markdown table.

With broadcast disabled (``--no-broadcast``) the plans show the shape a
multi-TB run takes when no dimension fits the broadcast threshold.

Usage: python tests/plan_report.py [sf_dir] [--no-broadcast]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def summary(df) -> dict:
    text = df._jdf.queryExecution().executedPlan().toString()
    shuffles = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)",
                              text))
    return {
        "shuffles": shuffles,
        "broadcasts": text.count("BroadcastExchange"),
        "smj": text.count("SortMergeJoin"),
        "bhj": text.count("BroadcastHashJoin"),
        "partial_agg": text.count("HashAggregate(keys=") // 2 if "HashAggregate" in text else 0,
        "top_k": ("WindowGroupLimit" in text and "window-group-limit") or
                 ("TakeOrderedAndProject" in text and "take-ordered") or "",
    }


def main(argv):
    from bench import local_session
    from ratelens.plans.catalog import QUERIES

    sf_dir = next((a for a in argv[1:] if not a.startswith("--")), "/root/testdata/sf0.01")
    extra = {}
    if "--no-broadcast" in argv:
        extra = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    spark = local_session(8, 8, extra=extra)
    print("| query | shuffles | SMJ | BHJ | top-k |")
    print("|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        s = summary(fn(spark, sf_dir))
        print(f"| {name} | {s['shuffles']} | {s['smj']} | {s['bhj']} | {s['top_k']} |")


if __name__ == "__main__":
    main(sys.argv)
