"""Numbering by slices against the textbook window, with buckets that are cut."""

import datetime
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cadenza.operators import measure, rank_sliced, recency_weight, temporal_split
from cadenza.operators.slices import _sliced
from conftest import rows

START = datetime.datetime(2024, 1, 1)


def _events(spark, kind="timestamp_ntz", n=4000):
    """User 7 holds a third of the events; a quarter of its times are null, a quarter
    the same, and some of its rows are copies."""
    rng = random.Random(4)

    def time(k):
        day = START + datetime.timedelta(days=k)
        return {"timestamp_ntz": day, "date": day.date(), "bigint": k, "double": k / 3, "string": f"{k:05d}"}[kind]

    data = []
    for i in range(n):
        if i % 3 == 0:
            when = None if i % 4 == 0 else time(50) if i % 4 == 1 else time(rng.randrange(200))
            data.append((7, when, f"x{i % 5}" if i % 4 < 2 else f"x{i}"))
        else:
            data.append((None if i % 50 == 1 else rng.randrange(60) + 10, time(rng.randrange(200)), f"x{i % 40}"))
    return spark.createDataFrame(data, f"user long, ts {kind}, item string")


def _numbers(df):
    return rows(df.groupBy("user", "ts", "item").agg(
        F.sort_array(F.collect_list("rn")).alias("rns"), F.max("n").alias("n")))


def _textbook(df, order):
    w = Window.partitionBy("user")
    return df.withColumn("rn", F.row_number().over(w.orderBy(*order)).cast("long")).withColumn(
        "n", F.count(F.lit(1)).over(w))


def _asc():
    return [F.col("ts").asc_nulls_first(), F.col("item").asc()]


def _desc():
    return [F.col("ts").desc_nulls_last(), F.col("item").asc()]


@pytest.mark.parametrize("kind", ["timestamp_ntz", "date", "bigint", "double"])
@pytest.mark.parametrize("slice_rows", [20, 300, 1 << 20])
def test_both_directions_match_row_number(spark, kind, slice_rows):
    df = _events(spark, kind)
    slices = measure(df, ["user"], "ts", slice_rows)
    assert (slices.table is None) == (slice_rows > 1000)
    for order, descending in ((_asc(), False), (_desc(), True)):
        got = rank_sliced(df, slices, order, "rn", "n", descending)
        assert _numbers(got) == _numbers(_textbook(df, order))


def test_slices_serve_a_part(spark):
    df = _events(spark)
    slices = measure(df, ["user"], "ts", 20)
    part = df.where("item != 'x3' and (user is null or user != 20)")
    assert _numbers(rank_sliced(part, slices, _desc(), "rn", "n", True)) == _numbers(_textbook(part, _desc()))


def test_hot_user_is_spread_and_runs_are_slices(spark):
    df = _events(spark)
    slices = measure(df, ["user"], "ts", 1)
    hot = _sliced(df, slices).where("user = 7").groupBy("_cz_slice", "_cz_run").count().collect()
    plain = [r["count"] for r in hot if not r["_cz_run"]]
    runs = {r["count"] for r in hot if r["_cz_run"]}
    assert max(plain) < 200 and len(plain) > 3   # of 1,334 rows
    assert len(runs) == 2 and min(runs) > 300    # null times and the one frequent time


def test_uncut_plan_is_one_shuffle_without_ranges(spark):
    import contextlib
    import io

    df = _events(spark)
    slices = measure(df, ["user"], "ts")
    train = rank_sliced(df, slices, _asc(), "rn", "n").where("rn <= cast(n * 0.8d as bigint)")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        rank_sliced(train.select("user", "ts", "item"), slices, _desc(), "rn", descending=True).explain()
    # the split and the newest-first numbering of its rows share one exchange
    assert buf.getvalue().count("Exchange ") == 1 and "rangepartitioning" not in buf.getvalue()


def test_split_and_recency_use_slices(spark):
    df = _events(spark).withColumnsRenamed({"user": "user_id", "ts": "timestamp", "item": "recording_mbid"})
    base = df.where("user_id is not null")
    whole = temporal_split(df)
    from cadenza.operators import event_slices
    slices = measure(base, ["user_id"], "timestamp", 20)
    assert event_slices(df).by == "timestamp" and slices.table is not None
    cut = temporal_split(df, slices=slices)
    counted = ["user_id", "timestamp", "recording_mbid", "is_train"]
    assert rows(whole.groupBy(*counted).count()) == rows(cut.groupBy(*counted).count())
    part = cut.where("is_train").drop("is_train")
    assert rows(recency_weight(part, slices=slices, position="i").groupBy("user_id", "i").count()) == rows(
        recency_weight(part, position="i").groupBy("user_id", "i").count())
    with pytest.raises(ValueError):
        recency_weight(part, per_item=True, slices=slices)


def test_times_without_quantiles_and_empty_tables(spark):
    df = _events(spark, "string", 300).withColumnsRenamed({"user": "user_id", "ts": "timestamp"})
    got = temporal_split(df)
    assert got.count() == df.where("user_id is not null").count()
    assert recency_weight(df, item_col="item", position="i").where("i = 1").count() == df.select(
        "user_id").distinct().count()
    none = _events(spark).limit(0)
    slices = measure(none, ["user"], "ts", 1)
    assert rank_sliced(none, slices, _asc(), "rn", "n").count() == 0


def test_only_null_times(spark):
    df = spark.createDataFrame([(1, None, f"i{k % 9}") for k in range(200)] + [(2, 5, "a")],
                               "user long, ts long, item string")
    slices = measure(df, ["user"], "ts", 10)
    assert slices.table is not None
    assert _numbers(rank_sliced(df, slices, _asc(), "rn", "n")) == _numbers(_textbook(df, _asc()))
