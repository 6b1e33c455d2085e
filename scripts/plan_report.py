"""Summarise the executed physical plan of every batch query into PLANS.md.

    python scripts/plan_report.py [sf_dir]

Per query: shuffle exchanges (and their partitioning), partial aggregates,
top-N group limits, join strategies, pushed filters and the columns read
from each parquet scan.  Streaming queries are skipped (their plans are
per micro-batch).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventlens.plans import catalog  # noqa: E402
from eventlens.session import build_session  # noqa: E402


def features(plan: str) -> dict:
    final = plan.split("+- == Initial Plan ==")[0]
    reused = final.count("ReusedExchange")
    final = re.sub(r"ReusedExchange [^\n]*", "", final)     # its line repeats the exchange it reuses
    ex = re.findall(r"Exchange (hashpartitioning|rangepartitioning)\((.*?), \d+\)", final)
    ex += [("RoundRobinPartitioning", n) for n in re.findall(r"Exchange RoundRobinPartitioning\((\d+)\)", final)]
    ex += [("SinglePartition", "") for _ in re.findall(r"Exchange SinglePartition", final)]
    return {
        "exchanges": [f"{k}({re.sub(r'#\d+L?', '', a)})" for k, a in ex] + ([f"{reused} used again"] if reused else []),
        "partial_agg": len(re.findall(r"partial_", final)) > 0,
        "group_limit": "WindowGroupLimit" in final,
        "joins": sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin)", final))),
        "pushed": sorted(set(re.sub(r"#\d+L?", "", p) for p in re.findall(r"PushedFilters: \[([^\]]+)\]", final))),
        "read": sorted(set(re.sub(r"#\d+L?", "", p) for p in re.findall(r"FileScan parquet \[([^\]]+)\]", final))),
        "python": sorted(set(re.findall(r"(MapInPandas|FlatMapGroupsInPandas|ArrowEvalPython|BatchEvalPython)", final))),
    }


def executed_plan(df) -> str:
    """The adaptive plan after a run into the ``noop`` sink, if the same plan
    object ran; else the plan as decided up front."""
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=8)
    lines = ["# PLANS", "",
             f"Executed (adaptive, final) physical plans of the batch queries at `{os.path.basename(sf_dir)}`,"
             " `local[8]`, 8 shuffle partitions (as `bench.py`); generated by `scripts/plan_report.py`.",
             "Queries that materialise an intermediate (CTAS, CSV/text round trips) show only the plan that"
             " reads it back. Partial aggregates before the shuffle are marked under *Partial agg*.", "",
             "| Query | Shuffle exchanges | Partial agg | Group limit | Joins | Python | Pushed filters | Columns read |",
             "| --- | --- | --- | --- | --- | --- | --- | --- |"]
    for name, fn in catalog.queries().items():
        if name.startswith("stream_"):
            continue
        df = fn(spark, sf_dir)
        f = features(executed_plan(df))
        lines.append("| `{}` | {} | {} | {} | {} | {} | {} | {} |".format(
            name, "<br>".join(f["exchanges"]) or "none", "yes" if f["partial_agg"] else "-",
            "yes" if f["group_limit"] else "-", ", ".join(f["joins"]) or "-", ", ".join(f["python"]) or "-",
            "<br>".join(f["pushed"]) or "-", "<br>".join(f["read"]) or "-"))
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
