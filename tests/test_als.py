"""ALS: repeatability, cold pairs, ids of any size, fit on planted factors."""

import inspect

import pytest
from pyspark.sql import functions as F

from cadenza.operators import RatingModel, als_fit, als_predict, mean_ratings
from cadenza.operators.als import NUM_BLOCKS
from conftest import rows


def _planted(spark):
    # rank-1 ratings u * v with u, v in [1, 2]
    data = [(u, i, (1 + u / 20) * (1 + i / 30)) for u in range(20) for i in range(30)
            if (u * 7 + i) % 3 != 0]
    return spark.createDataFrame(data, "user_id long, recording_mbid_index long, rating double")


def test_als_fit_predict_repeatable(spark):
    df = _planted(spark)
    m1 = als_fit(df, rank=3, reg=0.01, max_iter=8)
    m2 = als_fit(df.repartition(3), rank=3, reg=0.01, max_iter=8)
    held = spark.createDataFrame([(u, i) for u in range(20) for i in range(30) if (u * 7 + i) % 3 == 0]
                                 + [(999, 1)], "user_id long, recording_mbid_index long")
    p1 = als_predict(m1, held)
    assert dict(p1.dtypes)["prediction"] == "double"
    assert p1.where(F.col("user_id") == 999).count() == 0  # cold start dropped
    a = {(r[0], r[1]): r[2] for r in p1.collect()}
    b = {(r[0], r[1]): r[2] for r in als_predict(m2, held).collect()}
    assert a.keys() == b.keys()
    assert max(abs(a[k] - b[k]) for k in a) < 1e-6
    fitted = als_predict(m1, df).collect()
    rmse = (sum((r["prediction"] - r["rating"]) ** 2 for r in fitted) / len(fitted)) ** 0.5
    assert rmse < 0.1  # the planted factors are recovered on the training pairs


def test_als_nonnegative_factors(spark):
    model = als_fit(_planted(spark), rank=2, reg=0.1, max_iter=4)
    assert model.item_factors().where(F.exists("features", lambda x: x < 0)).count() == 0


def test_als_ids_of_any_size(spark):
    base = _planted(spark)
    big = base.select((F.col("user_id") - F.lit(10**12)).alias("user_id"),
                      (F.col("recording_mbid_index") + F.lit(2**40)).alias("recording_mbid_index"), "rating")
    pairs = [(u, i) for u in range(0, 20, 3) for i in range(0, 30, 7)]
    odd = [(10**12, 1), (-5, 1), (1, 2**33), (None, 1), (1, None)]
    schema = "user_id long, recording_mbid_index long"
    got = []
    for df, du, di in ((base, 0, 0), (big, -10**12, 2**40)):
        model = als_fit(df, rank=3, reg=0.01, max_iter=6)
        assert type(model) is RatingModel
        held = spark.createDataFrame([(u + du, i + di) for u, i in pairs] + odd, schema)
        got.append({(r[0] - du, r[1] - di): r[2] for r in als_predict(model, held).collect()})
    assert got[0].keys() == got[1].keys() == set(pairs)  # unknown ids are cold pairs
    # dense ids keep the order, so the same blocks and seed give the same fit
    assert max(abs(got[0][k] - got[1][k]) for k in pairs) < 1e-4


def test_als_does_not_follow_the_cluster_size(spark):
    df = _planted(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    try:
        for parts in ("2", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            model = als_fit(df.repartition(int(parts)), rank=3, max_iter=5, **{"reg": 0.05})
            got.append({(r[0], r[1]): r[3] for r in als_predict(model, df).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert max(abs(got[0][k] - got[1][k]) for k in got[0]) < 1e-6
    # the block count is part of the model
    assert inspect.signature(als_fit).parameters["num_blocks"].default == NUM_BLOCKS


def test_item_blocks_are_layout_only(spark, monkeypatch):
    from cadenza.operators import als

    assert als.item_blocks(10) == als.MIN_ITEM_BLOCKS < NUM_BLOCKS
    assert als.item_blocks(5 * als.ITEM_BLOCK_RATINGS + 1) == 6
    assert als.item_blocks(10**12) == NUM_BLOCKS and als.item_blocks(10**12, 2) == als.item_blocks(1, 2) == 2
    df = _planted(spark)
    got = []
    for least in (als.MIN_ITEM_BLOCKS, NUM_BLOCKS, 1):
        monkeypatch.setattr(als, "MIN_ITEM_BLOCKS", least)
        model = als_fit(df, rank=3, reg=0.05, max_iter=5)
        got.append({(r[0], r[1]): r[3] for r in als_predict(model, df).collect()})
    for other in got[1:]:  # the same model whatever the number
        assert max(abs(got[0][k] - other[k]) for k in got[0]) < 1e-5


def test_blocks_of_the_fit_fit_a_task_and_stay_off_the_heap(spark, monkeypatch):
    from cadenza.operators import als

    # 168 million ratings (360 times sf0.1): 40 bytes a rating while a block is built
    for ratings in (10, 30_000_000, 168_000_000, NUM_BLOCKS * als.ITEM_BLOCK_RATINGS):
        assert ratings / als.item_blocks(ratings) * 40 <= 1.6e9
    levels, got = [], []

    class Trainer(als.ALS):
        def fit(self, mapped):
            if levels:  # the second fit holds its blocks in memory
                self.setIntermediateStorageLevel("MEMORY_AND_DISK")
            levels.append(self.getIntermediateStorageLevel())
            return super().fit(mapped)

    monkeypatch.setattr(als, "ALS", Trainer)
    df = _planted(spark)
    for _ in range(2):
        model = als_fit(df, rank=3, reg=0.05, max_iter=4)
        got.append({(r[0], r[1]): r[3] for r in als_predict(model, df).collect()})
    assert levels == ["DISK_ONLY", "MEMORY_AND_DISK"]
    assert len(got[0]) == df.count() and got[0].keys() == got[1].keys()
    assert max(abs(got[0][k] - got[1][k]) for k in got[0]) < 1e-6  # the same model


def test_ids_that_are_dense_already_take_no_join(spark, monkeypatch):
    from cadenza.operators import als

    plans, got = [], []

    class Trainer(als.ALS):
        def fit(self, mapped):
            plans.append(mapped._jdf.queryExecution().analyzed().toString())
            return super().fit(mapped)

    monkeypatch.setattr(als, "ALS", Trainer)
    df = _planted(spark)
    for shift in (0, 7):  # items that are their own ids, and items that are not
        made = df.withColumn("recording_mbid_index", F.col("recording_mbid_index") + shift)
        model = als_fit(made.withColumn("user_id", F.col("user_id").cast("string")), rank=3, reg=0.05, max_iter=4)
        scores = als_predict(model, made.withColumn("user_id", F.col("user_id").cast("string"))).collect()
        got.append({(r["user_id"], r["recording_mbid_index"] - shift): r["prediction"] for r in scores})
    assert [plan.count("Join ") for plan in plans] == [1, 2]  # texts are never their own ids
    assert len(got[0]) == df.count() and got[0].keys() == got[1].keys()
    assert max(abs(got[0][k] - got[1][k]) for k in got[0]) < 1e-6  # the same model


def test_nothing_stays_cached_after_the_fit(spark):
    df = _planted(spark)
    als_fit(df, rank=2, max_iter=2)
    kept = df.select("user_id", "recording_mbid_index", "rating").dropna()
    assert not kept.storageLevel.useDisk


def test_mean_ratings(spark):
    df = spark.createDataFrame([(1, 5, 1.0), (1, 5, 0.5), (2, 5, 3.0)],
                               "user_id long, recording_mbid_index long, rating double")
    assert rows(mean_ratings(df)) == [(1, 5, 0.75), (2, 5, 3.0)]


def _changed(model):
    """The model with one positive component of one user's factors enlarged by a tenth."""
    import copy

    factors = model.user_factors().collect()
    row = next(r for r in sorted(factors) if max(r["features"]) > 0.1)
    features = list(row["features"])
    at = features.index(max(features))
    features[at] *= 1.1
    spark = model.users.sparkSession
    made = spark.createDataFrame([(r[model.user_col], features if r == row else list(r["features"]))
                                  for r in factors], f"{model.user_col} long, features array<float>")
    other = copy.copy(model)
    other.user_factors = lambda: made
    return other, row[model.user_col]


@pytest.mark.parametrize("nonnegative", [True, False])
def test_factors_are_optimal_and_a_changed_one_is_not(spark, nonnegative):
    from cadenza.operators import als_optimality

    df = spark.createDataFrame(
        [(u, i, float((u * 7 + i * 3) % 11) / 3 + (u == i)) for u in range(40) for i in range(30)
         if (u + i) % 4] + [(3, 5, 1.0)] * 20 + [(None, 1, 2.0), (1, None, 2.0)],
        "user_id long, recording_mbid_index long, rating double")
    model = als_fit(df, rank=6, reg=0.1, max_iter=6, nonnegative=nonnegative)
    found = {r["user_id"]: r for r in als_optimality(model, df).collect()}
    assert len(found) == 40 and all(r["optimal"] for r in found.values())
    assert found[3]["n_ratings"] == df.where("user_id = 3").count()
    other, user = _changed(model)
    wrong = {r["user_id"] for r in als_optimality(other, df).collect() if not r["optimal"]}
    assert wrong == {user}


def test_optimality_notices_another_regularisation_and_lost_ratings(spark):
    import dataclasses

    from cadenza.operators import als_optimality

    df = spark.createDataFrame(
        [(u, i, float((u * 5 + i) % 7)) for u in range(20) for i in range(20)],
        "user_id long, recording_mbid_index long, rating double")
    model = als_fit(df, rank=4, reg=0.2, max_iter=4)
    assert als_optimality(model, df).where("optimal").count() == 20
    assert als_optimality(dataclasses.replace(model, reg=0.3), df).where("optimal").count() < 5
    assert als_optimality(model, df.where("recording_mbid_index != 3")).where("optimal").count() < 10
    with pytest.raises(ValueError):
        als_optimality(dataclasses.replace(model, implicit=True), df)


def test_gradient_equals_dense_algebra(spark):
    import numpy as np

    from cadenza.operators import als_optimality

    df = spark.createDataFrame(
        [(u, i, float((u * 5 + i * i) % 9)) for u in range(12) for i in range(15) if (u * i) % 5 != 1],
        "user_id long, recording_mbid_index long, rating double")
    model = als_fit(df, rank=3, reg=0.3, max_iter=1)
    x = {r["user_id"]: np.array(r["features"], dtype=np.float64) for r in model.user_factors().collect()}
    y = {r["recording_mbid_index"]: np.array(r["features"], dtype=np.float64) for r in model.item_factors().collect()}
    for row in als_optimality(model, df).collect():
        own = [(r["recording_mbid_index"], r["rating"]) for r in df.where(f"user_id = {row['user_id']}").collect()]
        me = x[row["user_id"]]
        g = sum((me @ y[i] - r) * y[i] for i, r in own) + 0.3 * len(own) * me
        m = sum((abs(me @ y[i]) + abs(r)) * abs(y[i]) for i, r in own) + 0.3 * len(own) * abs(me)
        off = np.where(me > 0, abs(g), np.maximum(-g, 0))
        assert row["violation"] == pytest.approx(max(off / m), abs=1e-12)


def _shuffled_columns(df, name):
    """Columns of each shuffle of rows that hold column ``name``."""
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    sections = [s for s in text.split("\n\n") if ") Exchange" in s.split("\n")[0]]
    found = [s.split("Input", 1)[1].split("\n")[0] for s in sections]
    return [f for f in found if f"{name}#" in f]


def test_predict_sends_pairs_by_item_then_by_user(spark):
    model = als_fit(_planted(spark), rank=3, reg=0.01, max_iter=4)
    pairs = spark.createDataFrame([(u, i, u * 100 + i) for u in range(21) for i in range(31)] + [(None, 1, 0)],
                                  "user_id long, recording_mbid_index long, mark int")
    own = pairs.join(model.users, "user_id").join(model.items, "recording_mbid_index")
    want = {r["mark"]: r["prediction"] for r in model.model.transform(own).collect()}
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        got = als_predict(model, pairs)
        sent = _shuffled_columns(got, "mark")
        assert {r["mark"]: r["prediction"] for r in got.collect()} == want  # equal to the last bit
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(want) == 600
    assert len(sent) == 2 and not any("_cz_x#" in s or "features#" in s for s in sent)
    assert sum("_cz_y#" in s for s in sent) == 1  # the factors of a run of one item, side by side
