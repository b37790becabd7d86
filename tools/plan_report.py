"""Write PLANS.md: per batch query, the final (adaptive) physical plan's shape.

usage: python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from strata.plans.catalog import QUERIES  # noqa: E402


def count(plan: str, node: str) -> int:
    # Operators print as "+- Name" or, inside a codegen stage, "+- *(3) Name".
    return len(re.findall(rf"(?m)^[\s:+\-]*(?:\*\(\d+\)\s+)?{node}\b", plan))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "16").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    rows = []
    for name, q in sorted(QUERIES.items()):
        if name.startswith("stream_"):
            continue
        df = q(spark, sf_dir)
        qe = df._jdf.queryExecution()  # noqa: SLF001
        qe.toRdd().count()
        plan = qe.executedPlan().toString()
        # An adaptive plan prints its final and its initial form: keep the final one.
        if "== Final Plan ==" in plan:
            plan = plan.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
        scans = re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", plan)
        scan_txt = "; ".join(f"{len(cols.split(','))} cols" + (f", pushed {pf[:60]}" if pf else "")
                             for cols, pf in scans)
        rows.append((name, count(plan, "Exchange"), count(plan, "BroadcastExchange"),
                     count(plan, "SortMergeJoin"), count(plan, "BroadcastHashJoin"),
                     count(plan, "Window"), count(plan, "(HashAggregate|SortAggregate|ObjectHashAggregate)"),
                     scan_txt))
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("# Physical plans of the batch queries\n\n")
        f.write(f"Final adaptive plans at `{sf_dir}`, `local[8]`, 16 shuffle partitions "
                "(generated by `tools/plan_report.py`). *Shuffles* counts shuffle exchanges, "
                "*Bcast* broadcast exchanges; *Aggs* counts aggregate operators (partial + final). "
                "Driver-side jobs that return bounded results (hot-key lists, broadcast size checks) "
                "run before the plan and are not shown. Timings are in `bench.py`'s output. "
                "A round-robin exchange from `session.spread` shows up only when a scan has fewer "
                "partitions than there are cores (every driver table is one parquet row group); "
                "on large inputs it is absent.\n\n")
        f.write("| Query | Shuffles | Bcast | SMJ | BHJ | Window | Aggs | Scans (columns read, pushed filters) |\n")
        f.write("| --- | --- | --- | --- | --- | --- | --- | --- |\n")
        for r in rows:
            f.write("| " + " | ".join(str(x) for x in r) + " |\n")
    spark.stop()


if __name__ == "__main__":
    main()
