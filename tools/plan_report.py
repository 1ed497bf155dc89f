"""Summarise the physical plan of every registered query -> PLANS.md.

    python tools/plan_report.py [sf_dir] > PLANS.md

Per query: shuffle exchanges, broadcast exchanges, file scans, whole-stage
codegen spans and Python stages in the (initial adaptive) physical plan of
the returned frame. Queries that write and read back files report the read
side; fits and round trips run while the frame is built.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PY_NODES = ("ArrowEvalPython", "BatchEvalPython", "MapInArrow", "MapInPandas",
            "PythonMapInArrow", "FlatMapGroupsInPandas")


def summarise(plan: str) -> dict:
    lines = plan.splitlines()
    return {
        "shuffles": sum(1 for ln in lines if re.search(r"\bExchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)", ln)),
        "broadcasts": sum(1 for ln in lines if "BroadcastExchange" in ln),
        "scans": sum(1 for ln in lines if "FileScan" in ln or "Scan parquet" in ln),
        "python": sorted({n for ln in lines for n in PY_NODES if n in ln}),
        "aggregates": sum(1 for ln in lines if "HashAggregate(" in ln or "ObjectHashAggregate(" in ln),
    }


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    from millrace import plans
    from millrace.plans.registry import REGISTRY
    from millrace.session import build_session
    spark = build_session()
    print("# Physical plans\n")
    print(f"Generated by `tools/plan_report.py` at `{sf_dir}` (initial adaptive plans; "
          "AQE may still coalesce partitions, switch joins to broadcast and reuse exchanges).\n")
    print("| query | oracle | shuffles | broadcasts | scans | aggregates (partial+final) | python stages |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in sorted(plans.queries().items()):
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        oracle = "SQL" if REGISTRY[name].sql else "rows"
        py = ", ".join(s["python"]) or "-"
        print(f"| {name} | {oracle} | {s['shuffles']} | {s['broadcasts']} | {s['scans']} | "
              f"{s['aggregates']} | {py} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
