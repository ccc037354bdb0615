"""The ideal gain, score ranges of the AUC, hashed samples and shared list layouts."""

import contextlib
import io
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.operators import (
    exact_auc,
    ideal_gain,
    interaction_counts,
    list_average_precision,
    overlap_at_n,
    popularity_topk,
    ranking_metrics,
    sample_fraction,
)
from cadenza.operators.auc import _cuts_below
from conftest import rows


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_ideal_gain_equals_the_sum(spark):
    largest = 10**7
    terms = np.log(2) / np.log(np.arange(2, largest + 2, dtype=np.float64))
    total = np.cumsum(terms.astype(np.longdouble))
    ns = [1, 2, 10, 127, 128, 129, 130, 1000, 4096, 99_999, 10**6, largest]
    df = spark.createDataFrame([(n,) for n in [*ns, 0, -5, None]], "n long")
    got = dict(rows(df.select("n", ideal_gain(F.col("n")).alias("gain"))))
    assert (got[0], got[-5], got[None]) == (0.0, 0.0, None)
    for n in ns:
        assert got[n] == pytest.approx(float(total[n - 1]), rel=1e-13)
    huge = spark.createDataFrame([(2**62,)], "n long").select(ideal_gain(F.col("n"))).first()[0]
    assert 2**62 / 64 < huge < 2**62 / 50


def test_ndcg_has_no_generated_terms(spark):
    events = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, "c")], "user_id long, recording_mbid string")
    ranked = spark.createDataFrame([("b", 1), ("a", 2)], "recording_mbid string, position long")
    table = ranking_metrics(events, ranked)
    assert not re.search(r"\bRange \(", _plan(table))
    counted = events.groupBy("user_id", "recording_mbid").count()
    assert rows(ranking_metrics(counted, ranked, count_col="count")) == rows(table)
    assert rows(ranking_metrics(counted, ranked, count_col="count", dedupe=True)) == rows(
        ranking_metrics(events, ranked, dedupe=True))


@pytest.mark.parametrize("ranges", [1, 2, 3, 7, 64])
def test_cuts_below(spark, ranges):
    cuts = [float(3 * k) for k in range(ranges)]
    df = spark.createDataFrame([(k / 2,) for k in range(-3, 8 * ranges)], "v double")
    for v, n in df.select("v", _cuts_below(F.col("v"), cuts)).collect():
        assert n == sum(c < v for c in cuts)


@pytest.mark.parametrize("size", [1 << 18, 50, 1])
def test_auc_in_any_number_of_ranges(spark, monkeypatch, size):
    monkeypatch.setattr("cadenza.operators.auc.RANGE_SCORES", size)
    data = [((i * 7919) % 331 / 7.0 - 20, float(i * i % 5 == 1)) for i in range(900)]
    got = exact_auc(spark.createDataFrame(data, "prediction double, label double")).first()
    pos, neg = ([s for s, label in data if label == want] for want in (1.0, 0.0))
    want = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    assert got["auc"] == pytest.approx(want, abs=1e-12)
    assert (got["positives"], got["negatives"]) == (len(pos), len(neg))


def test_bernoulli_sample_does_not_depend_on_partitions(spark):
    import hashlib

    df = spark.range(5000).select(F.col("id").alias("u"), (F.col("id") % 7).alias("i"))
    got = rows(sample_fraction(df, 0.3, 5, exact=False))
    assert got == rows(sample_fraction(df.repartition(13, "i"), 0.3, 5, exact=False))
    want = [(u, u % 7) for u in range(5000)
            if int(hashlib.md5(f"{u}|{u % 7}|5".encode()).hexdigest()[:8], 16) < math.ceil(0.3 * 2**32)]
    assert got == sorted(want, key=repr)
    assert sample_fraction(df, 0.0, 5, exact=False).count() == 0
    assert sample_fraction(df, 1.0, 5, exact=False).count() == 5000


def _lists(spark):
    pairs = [(u, (u * 5 + k * k) % 23 if (u + k) % 9 else None, float((u + 3 * k) % 8), float((k * 5) % 11))
             for u in range(30) for k in range(25)]
    return spark.createDataFrame(pairs + pairs[:40],
                                 "user_id long, recording_mbid_index long, prediction double, rating double")


def test_one_table_or_two_give_the_same_lists(spark):
    both = _lists(spark)
    apart = both.select("user_id", "recording_mbid_index", "prediction"), both.drop("prediction")
    for n in (1, 4, 100):
        assert rows(list_average_precision(both, both, n)) == rows(list_average_precision(*apart, n))
        assert rows(overlap_at_n(both, both, n)) == rows(overlap_at_n(apart[1], apart[0], n))


def test_list_precision_by_hand(spark):
    both = _lists(spark)
    data = both.collect()
    for n in (3, 10):
        got = dict(rows(list_average_precision(both, both, n)))
        for user in range(30):
            own = [r for r in data if r["user_id"] == user]

            def top(col):
                order = sorted(own, key=lambda r: (-r[col], r[1] is not None, r[1] or 0))
                return [r[1] for r in order[:n]]

            truth, hits, total = top("rating"), 0, 0.0
            for rank, item in enumerate(top("prediction"), 1):
                if item is not None and item in truth:
                    hits += 1
                    total += hits / rank
            assert got[user] == pytest.approx(total / len(truth), abs=1e-12)


def test_users_without_truth_or_predictions(spark):
    p = spark.createDataFrame([(1, 5, 1.0), (2, 6, 1.0)], "user_id long, recording_mbid_index long, prediction double")
    t = spark.createDataFrame([(1, 5, 1.0), (3, 6, 1.0)], "user_id long, recording_mbid_index long, rating double")
    assert rows(list_average_precision(p, t)) == [(1, 1.0), (2, 0.0)]
    assert rows(overlap_at_n(t, p)) == [(1, 1, 1, 1.0)]
    assert list_average_precision(p.limit(0), t).count() == 0


def test_list_metrics_shuffle_rows_twice(spark):
    both = _lists(spark)
    plan = _plan(list_average_precision(both, both))
    assert plan.count("Exchange ") == 2


def test_top_list_stores_and_ranges_nothing(spark):
    counts = interaction_counts(_lists(spark).withColumn("recording_mbid", F.col("recording_mbid_index").cast("string")))
    plan = _plan(popularity_topk(counts, beta=3, k=5))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
