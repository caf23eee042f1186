"""Shuffle report: the exchanges and joins of every catalogue query as planned for big tables.

Automatic broadcast is switched off, so joins against the fact tables plan as
they would at scale (shuffle / sort-merge). Explicit broadcasts of proven-small
sides (fixed lookups, one-row aggregates, per-partition offsets) stay. Prints a
Markdown table: python tests/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def summarize(plan: str) -> tuple[list[str], list[str], bool]:
    exchanges, joins = [], []
    for line in plan.splitlines():
        m = re.search(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)"
                      r"(\(([^)]*)\))?", line)
        if m:
            kind = m.group(1)
            keys = re.sub(r"#\d+L?", "", m.group(3) or "")
            keys = re.sub(r", \d+$", "", keys)
            keys = re.sub(r" (ASC|DESC) NULLS (FIRST|LAST)", "", keys)
            exchanges.append(kind if kind == "SinglePartition" else f"{kind.replace('partitioning', '')}({keys})")
        if "BroadcastExchange" in line:
            exchanges.append("broadcast")
        j = re.search(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)"
                      r"\s*(\[[^\]]*\])?", line)
        if j:
            joins.append(j.group(1).replace("Join", "") + (re.sub(r"#\d+L?", "", j.group(2) or "")))
    return exchanges, joins, "ExistingRDD" in plan and "_pid" in plan


def main() -> None:
    from quarry.session import get_spark
    import __spark_entry__ as E
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[4]", shuffle_partitions=8,
                      extra={"spark.sql.autoBroadcastJoinThreshold": "-1",
                             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    print("| query | exchanges (shuffles and explicit broadcasts) | joins | checkpointed range stage |")
    print("| --- | --- | --- | --- |")
    for name, fn in E.queries().items():
        if name.startswith(("kmeans", "ols")):
            continue
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        ex, joins, ckpt = summarize(plan)
        print(f"| {name} | {'; '.join(ex) or '—'} | {'; '.join(joins) or '—'} | {'yes' if ckpt else ''} |")


if __name__ == "__main__":
    main()
