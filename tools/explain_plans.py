"""Audit the physical plan of every registered query.

Usage: python tools/explain_plans.py [sf_dir] > PLANS.md

Two tables: plans as they run at this size, and with broadcast joins off,
which is how joins of large tables run.

For each query: Parquet scans and how many carry pushed filters, shuffle
exchanges, broadcast / sort-merge joins, sort-based aggregates, whether a
single-partition exchange or a Python UDF node appears, and the number of
whole-stage-codegen stages. Plans are the final adaptive plans after the
query ran (AQE has applied run-time statistics).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def facts(plan: str) -> dict:
    scans = re.findall(r"FileScan parquet[^\n]*", plan)
    pushed = [s for s in scans if re.search(r"PushedFilters: \[[^\]]", s)]
    return {
        "scans": len(scans),
        "pushed": len(pushed),
        "exchanges": len(re.findall(r"\bExchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)", plan)),
        "bhj": plan.count("BroadcastHashJoin"),
        "smj": plan.count("SortMergeJoin"),
        "sort_agg": plan.count("SortAggregate"),
        "single_partition": "Exchange SinglePartition" in plan,
        "python": any(k in plan for k in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")),
        "codegen": len(re.findall(r"\*\(\d+\)", plan)),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from lakeforge.plans.catalog import REGISTRY
    from lakeforge.session import build_session

    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    print("# Physical plan audit\n")
    print(f"Generated by `tools/explain_plans.py` on `{sf_dir}` (local[8]).\n")
    for title, threshold in (("As run", None), ("Broadcast joins off", "-1")):
        if threshold:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", threshold)
        print(f"## {title}\n")
        table(spark, sf_dir, REGISTRY)
        print()


def table(spark, sf_dir: str, queries: dict) -> None:
    print("| query | scans | scans w/ pushed filters | exchanges | broadcast joins | sort-merge joins "
          "| sort aggregates | single-partition exchange | Python UDF | codegen stages |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, q in sorted(queries.items()):
        df = q(spark, sf_dir)
        df.collect()  # runs the plan, so the adaptive plan below is the final one
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[0]  # count the final plan only
        f = facts(plan)
        print(f"| {name} | {f['scans']} | {f['pushed']} | {f['exchanges']} | {f['bhj']} | {f['smj']} | {f['sort_agg']} "
              f"| {'yes' if f['single_partition'] else 'no'} | {'yes' if f['python'] else 'no'} | {f['codegen']} |")


if __name__ == "__main__":
    main()
