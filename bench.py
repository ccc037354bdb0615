"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run to completion with the ``noop`` sink (every row computed,
nothing collected) and timed; prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cadenza.plans.queries import QUERIES  # noqa: E402
from cadenza.session import build_session  # noqa: E402

HEADLINE = [
    "clean_interactions",
    "temporal_split",
    "interaction_counts",
    "popularity_topk",
    "ranking_summary",
    "recency_weight",
    "compress_recency",
    "item_index",
    "apply_item_index",
    "sample_exact",
    "bias_predict",
    "overlap_mean",
    "list_map",
    "auc_exact",
    "als_predict",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    parts = os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)
    spark = build_session(f"local[{cpus}]", app_name="cadenza-bench",
                          shuffle_partitions=int(parts),
                          conf={"spark.driver.memory": "16g", "spark.ui.enabled": "false",
                                "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    # warm the JVM and the scan path (not timed)
    QUERIES["split_points"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # report the failure, keep timing the rest
            times[name] = None
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
        print(f"{name}: {times[name]}s", file=sys.stderr)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    result = {
        "metric": "total_query_time",
        "value": round(sum(t for t in times.values() if t is not None), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
    }
    if errors:
        result["errors"] = errors
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
