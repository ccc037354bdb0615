"""Skew check: one user holding a third of all events.

Builds interactions from the test tables with every third order's events moved to
user 0, numbers each user's events (a) with the plain window, (b) with the range layout
of ``rank_within`` and (c) in slices of at most 20,000 rows, oldest and newest first,
checks that all give the same numbers, and reports the largest number of shuffle records any single
task read in each run (from Spark's event log in a scratch folder).

usage: python tools/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cadenza.operators import measure, rank_sliced, rank_within, window_rank  # noqa: E402
from cadenza.session import build_session  # noqa: E402
from cadenza.sources import load_interactions  # noqa: E402


SLICE_ROWS = 20_000


def max_task_records(log_dir: str, job_group: str) -> int:
    best = 0
    jobs_in_group: set[int] = set()
    stage_jobs: dict[int, int] = {}
    for f in glob.glob(os.path.join(log_dir, "*", "*")) + glob.glob(os.path.join(log_dir, "*")):
        if os.path.isdir(f):
            continue
        for line in open(f, errors="ignore"):
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                props = e.get("Properties", {})
                if props.get("spark.jobGroup.id") == job_group:
                    jobs_in_group.add(e["Job ID"])
                    for s in e["Stage IDs"]:
                        stage_jobs[s] = e["Job ID"]
            elif e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in stage_jobs:
                m = e.get("Task Metrics") or {}
                rec = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                best = max(best, rec)
    return best


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="cz-skew-")
    spark = build_session("local[8]", shuffle_partitions=8, conf={
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false",
        # show raw partition sizes (AQE would merge these small partitions by bytes)
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    inter = load_interactions(spark, sf)
    # stand-in input: every third event belongs to user 0
    skewed = inter.withColumn(
        "user_id", F.when(F.hash("recording_msid", "timestamp") % 3 == 0, F.lit(0))
        .otherwise(F.col("user_id")))
    total = skewed.count()
    hot = skewed.where("user_id = 0").count()
    order = [F.col("timestamp").asc_nulls_first(), F.col("recording_msid").asc_nulls_first()]

    sc = spark.sparkContext
    sc.setJobGroup("plain", "plain window")
    plain = window_rank(skewed, ["user_id"], order, "rn", "n")
    plain.write.format("noop").mode("overwrite").save()
    sc.setJobGroup("ranked", "rank_within")
    ranked = rank_within(skewed, ["user_id"], order, "rn", "n")
    ranked.write.format("noop").mode("overwrite").save()
    sc.setJobGroup("sliced", "rank_sliced")
    slices = measure(skewed, ["user_id"], "timestamp", SLICE_ROWS)
    sliced = rank_sliced(skewed, slices, order, "rn", "n")
    sliced.write.format("noop").mode("overwrite").save()
    sc.setJobGroup("verify", "comparison")
    newest = [F.col("timestamp").desc_nulls_last(), F.col("recording_msid").asc_nulls_first()]

    def numbers(df):
        return sorted(map(tuple, df.groupBy("user_id", "timestamp", "recording_msid").agg(
            F.sort_array(F.collect_list("rn")).alias("rns"), F.max("n")).collect()))
    want = numbers(plain)
    same = want == numbers(ranked) and want == numbers(sliced) and numbers(
        window_rank(skewed, ["user_id"], newest, "rn", "n")) == numbers(
        rank_sliced(skewed, slices, newest, "rn", "n", descending=True))
    spark.stop()
    print(json.dumps({
        "rows": total, "hot_user_rows": hot,
        "results_equal": same,
        "max_task_shuffle_records_plain_window": max_task_records(log_dir, "plain"),
        "max_task_shuffle_records_rank_within": max_task_records(log_dir, "ranked"),
        "max_task_shuffle_records_slices": max_task_records(log_dir, "sliced"),
    }))


if __name__ == "__main__":
    main()
