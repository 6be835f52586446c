"""Physical-plan summary of every registered query -> PLANS.md.

For each query: parquet scans and their read schemas, shuffles, windows,
joins, aggregates and Python stages of the executed (adaptive, final) plan at
the given scale. ``python plan_report.py [sf_dir]``.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gpsweave.catalog import queries  # noqa: E402
from gpsweave.session import build_session  # noqa: E402

OPS = {
    "scans": r"FileScan parquet|Scan ExistingRDD",
    "shuffles": r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "windows": r"\bWindow \[",
    "joins": r"SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin",
    "aggregates": r"HashAggregate\(keys=\[[^\]]*\], functions=\[[^\]]*\], output|SortAggregate\(key=\[[^\]]*\], functions=\[[^\]]*\], output|ObjectHashAggregate\(keys",
    "python": r"MapInArrow|MapInPandas|ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas",
}


def final_plan(df) -> str:
    """The plan this very DataFrame ran with: executed through its own query
    execution, then the final section of the adaptive plan alone."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "== Final Plan ==" in plan:
        plan = plan.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return plan


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", app="gpsweave-plans", shuffle_partitions=16,
                          extra={"spark.ui.showConsoleProgress": "false"})
    lines = ["# Physical plans of the registered queries", "",
             f"Final adaptive plans at `{sf_dir}` on local[8] (generated by `plan_report.py`). Counts are "
             "operators in the executed plan; scans list their pruned read schemas.", "",
             "| query | " + " | ".join(OPS) + " | read schemas |",
             "|---|" + "---|" * (len(OPS) + 1)]
    for name, q in sorted(queries().items()):
        plan = final_plan(q(spark, sf_dir))
        counts = [len(re.findall(p, plan)) for p in OPS.values()]
        schemas = sorted(set(re.findall(r"ReadSchema: struct<([^>]*)>", plan)))
        schema_txt = "; ".join(s.replace(":bigint", "").replace(":string", "").replace(":double", "")
                               .replace(":timestamp_ntz", "").replace(":int", "") for s in schemas)
        lines.append(f"| {name} | " + " | ".join(map(str, counts)) + f" | {schema_txt} |")
    # formatted plans of a few headline queries (operator tree part)
    for name in ("interval_metrics", "grid_window", "status_counts"):
        df = queries()[name](spark, sf_dir)
        df.collect()
        text = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        lines += ["", f"## `{name}` (explain formatted, operator tree and scans)", "", "```"]
        tree, details = text.split("\n\n\n", 1) if "\n\n\n" in text else (text, "")
        lines += tree.splitlines()[:60]
        lines += [ln for ln in details.splitlines()
                  if ln.startswith(("PushedFilters", "ReadSchema", "(")) and ("Scan" in ln or "Pushed" in ln
                                                                             or "ReadSchema" in ln)][:20]
        lines.append("```")
    with open(os.path.join(os.path.dirname(os.path.abspath(__file__)), "PLANS.md"), "w") as f:
        f.write("\n".join(lines) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
