"""Incremental clustering against a plain recomputation in Python integers."""

import hashlib
import math
import random

import pytest

from cadenza.llm import centroid_clusters as cc
from cadenza.llm.queries import ORACLE_SQL, op12_centroid_clusters
from helpers import HAVE_TABLES, SF, duck


def brute(rows, k, rounds, dims, scale, seed=1):
    """{row number: (cluster, distance)} and the centroids; rows are (id, vector)."""
    kept = {}
    for n, (_, v) in enumerate(rows):
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept[n] = [math.floor(scale * x) for x in v]
    order = sorted((n for n in kept if rows[n][0] is not None),
                   key=lambda n: hashlib.sha256(f"{seed}:{rows[n][0]}".encode()).hexdigest())
    order += [n for n in kept if rows[n][0] is None]
    centroids = [kept[n] for n in order[:k]]

    def assign():
        out = {}
        for n, v in kept.items():
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out[n] = (d.index(min(d)), min(d))
        return out

    for _ in range(rounds):
        now = assign()
        for c in range(len(centroids)):
            own = [kept[n] for n, (b, _) in now.items() if b == c]
            if own:
                centroids[c] = [sum(col) // len(own) for col in zip(*own)]
    return assign() if centroids else {}, centroids


def _rows(n=300, dims=5):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-1.5, -0.1, 0.0, 0.3, 2.2]) + rng.random() / 8 for _ in range(dims)])
            for i in range(n)]
    rows += [(n, None), (n + 1, []), (n + 2, [1.0] * (dims + 1)), (n + 3, [1.0, None, 0.0, 0.0, 0.0]),
             (n + 4, [float("nan")] * dims), (n + 5, [float("inf")] * dims)]
    return rows + [(n + 6 + i, rows[0][1]) for i in range(40)]  # copies


@pytest.mark.parametrize("k,rounds", [(4, 3), (16, 3), (7, 0), (3, 6), (1000, 2)])
def test_equals_plain_recomputation(spark, k, rounds):
    rows = _rows()
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows],
                               "vec_id long, embedding array<double>, distance string, cluster int")
    got = cc.cluster(df, k=k, rounds=rounds, dims=5)
    want, centroids = brute(rows, k, rounds, 5, 64)
    assert got.centroids == centroids
    assert {r["vec_id"]: (r["cluster"], r["distance"]) for r in got.assigned.collect()} == {
        rows[n][0]: w for n, w in want.items()}
    for c, total in enumerate(got.inertia):
        assert total == sum(d for b, d in want.values() if b == c)
    table = cc.summary_columns(got)
    for r in table.collect():
        assert r["inertia"] == sum(got.inertia) and r["cluster_inertia"] == got.inertia[r["cluster"]]
        assert r["centroid_sha256"] == hashlib.sha256(
            ",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest()


def test_unmoved_components_are_skipped():
    changes = cc._changes([[1, 2, 3], [4, 5, 6]], [[1, 2, 3], [4, 7, 6]])
    assert [(k, at.tolist(), change.tolist()) for k, at, change in changes] == [(1, [1], [2])]


def test_empty_null_ids_repeated_rows_and_large_values(spark):
    schema = "vec_id long, embedding array<float>"
    none = cc.summary_columns(cc.cluster(spark.createDataFrame([], schema)))
    assert none.count() == 0 and none.columns == [
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    rows = [(None, [1.0, 2.0]), (5, [1.0, 2.0]), (5, [1.0, 2.0]), (6, [-3.0, 0.0])]
    got = cc.cluster(spark.createDataFrame(rows, schema), k=2, dims=2)
    want, _ = brute(rows, 2, 3, 2, 64)
    assert sorted(r["distance"] for r in got.assigned.collect()) == sorted(d for _, d in want.values())
    large = spark.createDataFrame([(1, [2.0**30, 0.0])], schema)
    with pytest.raises(Exception, match="too large"):
        cc.cluster(large, k=2, dims=2)


@pytest.mark.skipif(not HAVE_TABLES, reason="test tables missing")
def test_query_equals_sql(spark):
    table = op12_centroid_clusters(spark, SF)
    result = duck().execute(ORACLE_SQL["op12_centroid_clusters"])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(table.columns)
    assert sorted(tuple(r) for r in table.select(names).collect()) == sorted(result.fetchall())


@pytest.mark.skipif(not HAVE_TABLES, reason="test tables missing")
def test_nothing_stays_cached(spark):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    op12_centroid_clusters(spark, SF)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before
