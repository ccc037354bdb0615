"""Edge rows named in FIXTURES.md: null timestamps, duplicate dimension keys,
null items, null true items in the overlap."""

import datetime as dt

from pyspark.sql import functions as F

from cadenza.operators import (
    apply_item_index,
    clean_interactions,
    fit_item_index,
    overlap_at_n,
    recency_weight,
    temporal_split,
    train_part,
)
from conftest import rows

T0 = dt.datetime(2021, 5, 1)
EVENTS = "user_id long, interactions_msid string, timestamp timestamp_ntz, recording_mbid string"


def test_null_timestamp_is_first_in_split_and_last_in_recency(spark):
    df = spark.createDataFrame(
        [(1, "a", None, "x"), (1, "b", T0, "y"), (1, "c", T0 + dt.timedelta(1), "z"),
         (1, "d", T0 + dt.timedelta(2), "w"), (1, "e", T0 + dt.timedelta(3), "v")], EVENTS)
    train = rows(train_part(temporal_split(df, 0.8)), "interactions_msid")
    assert train == [("a",), ("b",), ("c",), ("d",)]  # the null time sorts first
    rec = recency_weight(df.select("user_id", "recording_mbid", "timestamp"))
    weights = dict(rows(rec, "recording_mbid", "recency"))
    assert weights["v"] == 1.0 and weights["x"] == min(weights.values())  # null is oldest


def test_duplicate_track_keys_multiply_rows(spark):
    inter = spark.createDataFrame([(1, "m1", T0)],
                                  "user_id long, recording_msid string, timestamp timestamp_ntz")
    tracks = spark.createDataFrame([("m1", "b1", "a", "t"), ("m1", "b2", "a", "t")],
                                   "recording_msid string, recording_mbid string, "
                                   "artist_name string, track_name string")
    users = spark.createDataFrame([(1, "u")], "user_id long, user_name string")
    assert rows(clean_interactions(inter, tracks, users), "recording_mbid") == [("b1",), ("b2",)]


def test_null_item_gets_null_index(spark):
    train = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "user_id long, recording_mbid string")
    idx = fit_item_index(train)
    assert dict(rows(idx)) == {None: 0, "a": 1, "b": 2}  # null first, as in the sort
    held = spark.createDataFrame([(1, None), (1, "b")], "user_id long, recording_mbid string")
    assert rows(apply_item_index(held, idx)) == [(1, 2), (1, None)]


def test_overlap_null_true_item(spark):
    truth = spark.createDataFrame([(1, None, 3.0), (1, 7, 2.0)],
                                  "user_id long, recording_mbid_index long, rating double")
    pred = spark.createDataFrame([(1, 7, 0.9), (1, 8, 0.8)],
                                 "user_id long, recording_mbid_index long, prediction double")
    row = overlap_at_n(truth, pred, n=5).collect()[0]
    # paired by rank: (null, 7) and (7, 8); two true items, shared {7}
    assert (row["common_count"], row["true_count"], row["common_percentage"]) == (1, 2, 0.5)
    null = truth.where(F.col("recording_mbid_index").isNull())
    alone = overlap_at_n(null, pred, n=5).collect()[0]
    assert (alone["common_count"], alone["true_count"], alone["common_percentage"]) == (0, 1, 0.0)
    both = overlap_at_n(null, null.withColumnRenamed("rating", "prediction"), n=5).collect()[0]
    assert both["common_percentage"] == 1.0  # a null item is an item like any other
