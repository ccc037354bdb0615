"""Physical-plan report of every registered query (writes PLANS.md).

Runs each query at the given scale, then reads its final adaptive plan from
``explain()`` and counts the operators that matter at scale: shuffles, broadcast
and sort-merge joins, single-partition exchanges (all of their input in one task),
partial window-group limits, and Python evaluation nodes.

usage: python tools/plan_report.py [sf_dir] [out.md]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cadenza.plans.queries import QUERIES  # noqa: E402
from cadenza.session import build_session  # noqa: E402

PATTERNS = {
    "shuffles": r"Exchange (hashpartitioning|rangepartitioning|RoundRobin|roundrobin)",
    "single_partition": r"Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "bhj": r"BroadcastHashJoin",
    "smj": r"SortMergeJoin",
    "cross": r"(CartesianProduct|BroadcastNestedLoopJoin)",
    "wgl_partial": r"WindowGroupLimit .*Partial",
    "python": r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)",
    "scans": r"FileScan parquet",
}


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def single_partition_sizes(plan: str) -> list[str]:
    """What feeds each single-partition exchange (first operator below it)."""
    lines = plan.splitlines()
    out = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line and i + 1 < len(lines):
            below = lines[i + 1].strip().lstrip("+-: ").split("(")[0].split(" [")[0]
            out.append(below[:40])
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else "PLANS.md"
    spark = build_session("local[8]", shuffle_partitions=8, conf={
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    rows = []
    for name, fn in QUERIES.items():
        plan = final_plan(fn(spark, sf))
        counts = {k: len(re.findall(p, plan)) for k, p in PATTERNS.items()}
        counts["single_feeds"] = ", ".join(sorted(set(single_partition_sizes(plan))))
        rows.append((name, counts))
        print(name, counts, file=sys.stderr)
    spark.stop()
    cols = list(PATTERNS) + ["single_feeds"]
    with open(out, "w") as f:
        f.write("# Final physical plans of the registered queries\n\n")
        f.write(f"Generated by `python tools/plan_report.py {sf}` from the final adaptive plan of "
                "each query (the last action of the query; earlier actions such as stored "
                "tables or scalar lookups have their own plans). Counts are operator "
                "occurrences. `single_partition` exchanges collect all of their input in one "
                "task; `single_feeds` names what feeds them - each is a bounded table (a "
                "global aggregate's partial results, a per-partition offset table, a top-k "
                "list). `python` counts Python evaluation nodes; `cross` counts cartesian and "
                "nested-loop joins.\n\n")
        f.write("| query | " + " | ".join(cols) + " |\n")
        f.write("| --- | " + " | ".join("---" for _ in cols) + " |\n")
        for name, c in rows:
            f.write(f"| {name} | " + " | ".join(str(c[k]) for k in cols) + " |\n")


if __name__ == "__main__":
    main()
