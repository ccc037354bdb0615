"""The stage-by-stage command line reproduces the in-memory chain."""

import os
import tempfile

import pytest

from cadenza.plans import flows
from cadenza.plans import queries as Q
from cadenza.plans.cli import parser, run
from cadenza.sources import load_interactions, load_tracks, load_users, write_csv

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables missing")


def test_cli_popularity_chain(spark):
    d = tempfile.mkdtemp(prefix="cz-cli-")
    load_interactions(spark, SF).write.parquet(f"{d}/interactions")
    load_tracks(spark, SF).write.parquet(f"{d}/tracks")
    load_users(spark, SF).write.parquet(f"{d}/users")

    def cli(*argv):
        run(spark, parser().parse_args(list(argv)))

    cli("clean", "--interactions", f"{d}/interactions", "--tracks", f"{d}/tracks",
        "--users", f"{d}/users", "--out", f"{d}/clean")
    cli("split", "--input", f"{d}/clean", "--train", f"{d}/train", "--validation", f"{d}/val")
    cli("counts", "--input", f"{d}/train", "--out", f"{d}/train_counts")
    cli("popularity", "--counts", f"{d}/train_counts", "--out", f"{d}/top")
    cli("evaluate", "--validation", f"{d}/val", "--top", f"{d}/top", "--out", f"{d}/metrics")
    got = spark.read.parquet(f"{d}/metrics").collect()[0]
    want = Q.QUERIES["ranking_summary"](spark, SF).collect()[0]
    for c in ("mean_map", "mean_pk", "mean_ndcg"):
        assert got[c] == pytest.approx(want[c], abs=1e-9)
    with pytest.raises(Exception):  # default sink mode fails on an existing target
        cli("counts", "--input", f"{d}/train", "--out", f"{d}/train_counts")
    cli("--overwrite", "counts", "--input", f"{d}/train", "--out", f"{d}/train_counts")

    cli("counts", "--input", f"{d}/val", "--out", f"{d}/val_counts")
    cli("compress", "--input", f"{d}/train_counts", "--out", f"{d}/train_rated")
    cli("compress", "--input", f"{d}/val_counts", "--out", f"{d}/val_rated")
    cli("index", "--train", f"{d}/train_rated", "--apply", f"{d}/val_rated",
        "--out-train", f"{d}/train_idx", "--out-apply", f"{d}/val_idx")
    cli("bias", "--train", f"{d}/train_idx", "--test", f"{d}/val_idx", "--out", f"{d}/bias")
    row = spark.read.parquet(f"{d}/bias").collect()[0]
    want = Q.QUERIES["list_map"](spark, SF).collect()[0]
    assert row["users"] == want["users"] and row["list_map"] == pytest.approx(want["list_map"], abs=0.02)

    for name in ("train_idx", "val_idx"):  # the same stage from the CSV interchange
        write_csv(spark.read.parquet(f"{d}/{name}").select("user_id", "recording_mbid_index", "rating"),
                  f"{d}/{name}.csv")
    cli("bias", "--format", "csv", "--train", f"{d}/train_idx.csv", "--test", f"{d}/val_idx.csv",
        "--out", f"{d}/bias_csv")
    again = spark.read.parquet(f"{d}/bias_csv").collect()[0]
    assert again["users"] == row["users"] and again["list_map"] == pytest.approx(row["list_map"], abs=1e-9)


def test_cli_recency_and_als(spark):
    d = tempfile.mkdtemp(prefix="cz-cli-")
    halves = Q.split(spark, SF)
    data = flows.indexed_ratings(halves)
    tr, va = data.train, data.validation
    tr.write.parquet(f"{d}/train_idx")
    va.write.parquet(f"{d}/val_idx")
    halves.train.write.parquet(f"{d}/train")

    def cli(*argv):
        run(spark, parser().parse_args(list(argv)))

    cli("recency", "--input", f"{d}/train", "--out", f"{d}/recency")
    rec = spark.read.parquet(f"{d}/recency")
    assert rec.columns == ["user_id", "recording_mbid", "timestamp", "recency"]
    assert rec.where("recency = 1.0").select("user_id").distinct().count() == \
        rec.select("user_id").distinct().count()  # every user has one newest event
    cli("als", "--train", f"{d}/train_idx", "--test", f"{d}/val_idx", "--n", "5",
        "--out", f"{d}/als")
    assert 0 <= spark.read.parquet(f"{d}/als").collect()[0]["overlap"] <= 1
    cli("als", "--train", f"{d}/train_idx", "--test", f"{d}/val_idx", "--preset", "recency",
        "--threshold", "1.5", "--out", f"{d}/auc")
    auc = spark.read.parquet(f"{d}/auc").collect()[0]
    assert auc["positives"] + auc["negatives"] > 0
