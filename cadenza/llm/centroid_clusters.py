"""Clustering by centroids of exact integers with an incremental distance matrix.

Every vector keeps its dot products with all centroids, as exact 64-bit integers
beside the vector. The squared distance is |v|^2 - 2 v.c + |c|^2, and |v|^2 does
not change which centroid is nearest, so a round needs the dot products and the
norms of the centroids alone. When centroids move, only their changed components
matter: v.c grows by the sum of v[j] * change[j] over the components whose change
is not zero, and a centroid that did not move costs nothing.

The table of vectors and dot products is a Spark cache (memory, then disk) that
each round replaces; it is made by narrow steps from the input, so what a lost
executor held is computed again from its input files. Per round one small table
goes to the driver: sums and counts, clusters x (dimensions + 1) numbers, added up
per task before the shuffle.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm.common import slices, stored

LARGEST = 1 << 27  # of a component: 64 squared differences then fit a long
_ID, _VECTOR, _DOTS, _CLUSTER, _DISTANCE = "__id", "__vector", "__dots", "__cluster", "__distance"


@dataclass
class Clusters:
    assigned: DataFrame          # id_col, cluster (int), distance (long, squared); stored
    centroids: list[list[int]]   # components by number
    inertia: list[int]           # sum of distances by number


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, dims: int, scale: float) -> DataFrame:
    """Ids and ``floor(scale * x)`` of the vectors with ``dims`` finite components.

    Null vectors, other lengths and vectors with a null, NaN or infinite component
    are left out. A component beyond ``LARGEST`` is an OverflowError.
    """
    source = df.select(F.col(id_col).alias(_ID), F.col(vector_col).cast("array<double>").alias(_VECTOR))
    schema = T.StructType([source.schema[_ID], T.StructField(_VECTOR, T.BinaryType())])

    def run(batches):
        for batch in slices(batches):
            fits = pc.fill_null(pc.equal(pc.list_value_length(batch.column(1)), dims), False)
            batch = batch.filter(fits)
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            finite = np.isfinite(values).all(axis=1)  # a null component reads as NaN
            whole = np.floor(scale * values[finite])
            if whole.size and np.abs(whole).max() > LARGEST:
                raise OverflowError("a component is too large for exact squared distances")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(finite)), _binary(whole.astype(np.int32))],
                names=schema.names)

    return source.mapInArrow(run, schema)


def _binary(rows: np.ndarray) -> pa.Array:
    """One binary value per row of a matrix."""
    width = rows.shape[1] * rows.dtype.itemsize
    bounds = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [
        None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(rows))])


def _matrix(column: pa.Array, kind, width: int) -> np.ndarray:
    """The rows that ``_binary`` made."""
    _, bounds, data = column.buffers()
    if not len(column):
        return np.empty((0, width), dtype=kind)
    first = np.frombuffer(bounds, dtype=np.int32)[column.offset]
    return np.frombuffer(data, dtype=kind, offset=int(first), count=len(column) * width).reshape(-1, width)


def _nearest(dots: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return (norms - 2 * dots).argmin(axis=1).astype(np.int32)  # ties: the smaller number


def _norms(centroids) -> np.ndarray:
    return np.array([sum(x * x for x in c) for c in centroids], dtype=np.int64)


def _begin(vectors: DataFrame, centroids, dims: int) -> DataFrame:
    """Dot products with every centroid and the nearest one."""
    schema = T.StructType([*vectors.schema.fields, T.StructField(_DOTS, T.BinaryType()),
                           T.StructField(_CLUSTER, T.IntegerType())])
    matrix, norms = np.array(centroids, dtype=np.int64).T, _norms(centroids)

    def run(batches):
        for batch in slices(batches):
            dots = _matrix(batch.column(1), np.int32, dims).astype(np.int64) @ matrix
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), _binary(dots), pa.array(_nearest(dots, norms))],
                names=schema.names)

    return vectors.mapInArrow(run, schema)


def _changes(old, new):
    """(number, changed components, their changes) of the centroids that moved."""
    out = []
    for k, (a, b) in enumerate(zip(old, new)):
        change = np.array(b, dtype=np.int64) - np.array(a, dtype=np.int64)
        at = np.flatnonzero(change)
        if len(at):
            out.append((k, at, change[at]))
    return out


def _update(state: DataFrame, old, new, dims: int, last: bool) -> DataFrame:
    """The state after the centroids moved; ``last``: ids, clusters and distances."""
    changes, norms, k = _changes(old, new), _norms(new), len(new)
    schema = state.schema if not last else T.StructType([
        state.schema[_ID], T.StructField(_CLUSTER, T.IntegerType()), T.StructField(_DISTANCE, T.LongType())])

    def run(batches):
        for batch in slices(batches):
            vectors = _matrix(batch.column(1), np.int32, dims).astype(np.int64)
            dots = _matrix(batch.column(2), np.int64, k).copy()
            for number, at, change in changes:
                dots[:, number] += vectors[:, at] @ change
            cluster = _nearest(dots, norms)
            if last:
                distance = ((vectors * vectors).sum(axis=1) + norms[cluster]
                            - 2 * dots[np.arange(len(dots)), cluster])
                columns = [batch.column(0), pa.array(cluster), pa.array(distance)]
            else:
                columns = [batch.column(0), batch.column(1), _binary(dots), pa.array(cluster)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return state.mapInArrow(run, schema)


def _means(state: DataFrame, centroids, dims: int) -> list[list[int]]:
    """Componentwise floor of sum / count per cluster; an empty one stays."""
    k = len(centroids)

    def add(batches):
        sums, counts = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in slices(batches):
            vectors = _matrix(batch.column(0), np.int32, dims)
            cluster = batch.column(1).to_numpy()
            for number in np.unique(cluster):
                own = vectors[cluster == number]
                sums[number] += own.sum(axis=0, dtype=np.int64)
                counts[number] += len(own)
        table = np.concatenate([sums, counts[:, None]], axis=1)
        yield pa.RecordBatch.from_pydict({
            "number": np.repeat(np.arange(k, dtype=np.int32), dims + 1),
            "part": np.tile(np.arange(dims + 1, dtype=np.int32), k), "n": table.ravel()})

    total = (state.select(_VECTOR, _CLUSTER).mapInArrow(add, "number int, part int, n long")
             .groupBy("number", "part").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")))
    found = {(r["number"], r["part"]): int(r["n"]) for r in total.collect()}
    return [[found[c, j] // found[c, dims] for j in range(dims)] if found.get((c, dims)) else list(old)
            for c, old in enumerate(centroids)]


def cluster(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 16,
            rounds: int = 3, dims: int = 64, scale: float = 64, seed: int = 1) -> Clusters:
    """Cluster the vectors of ``df``; runs when called.

    The first centroids are the ``k`` vectors with the smallest SHA-256 of
    ``<seed>:<id>`` (null ids come last, repeated ids by their vectors); fewer
    vectors give fewer centroids. Every row is a vector of its own, also one that
    repeats. Equal distances go to the smaller number. Other columns are not read.
    Without any vector there are no clusters and no rows.
    """
    vectors = integer_vectors(df, id_col, vector_col, dims, scale)
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(_ID).cast("string")), 256)
    first = vectors.orderBy(key.asc_nulls_last(), _VECTOR).limit(k).select(_VECTOR).collect()
    centroids = [np.frombuffer(row[0], dtype=np.int32).tolist() for row in first]
    kind = vectors.schema[_ID].dataType
    if not centroids:
        empty = df.sparkSession.createDataFrame([], T.StructType([
            T.StructField(id_col, kind), T.StructField("cluster", T.IntegerType()),
            T.StructField("distance", T.LongType())]))
        return Clusters(empty, [], [])
    state = _begin(vectors, centroids, dims).persist(StorageLevel.MEMORY_AND_DISK)
    held = [state]
    for turn in range(rounds):
        moved = _means(state, centroids, dims)  # computes and caches the state
        for old in held[:-1]:
            old.unpersist()
        held = held[-1:]
        state = _update(state, centroids, moved, dims, last=turn == rounds - 1)
        centroids = moved
        if turn < rounds - 1:
            held.append(state.persist(StorageLevel.MEMORY_AND_DISK))
    if not rounds:
        state = _update(state, centroids, centroids, dims, last=True)
    assigned = stored(state.select(F.col(_ID).alias(id_col), F.col(_CLUSTER).alias("cluster"),
                                   F.col(_DISTANCE).alias("distance")))
    for old in held:
        old.unpersist()
    total = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("n"))
    found = {r["cluster"]: int(r["n"]) for r in total.collect()}
    return Clusters(assigned, centroids, [found.get(c, 0) for c in range(len(centroids))])


def summary_columns(clusters: Clusters) -> DataFrame:
    """``assigned`` with the inertia of the cluster and of all, and the SHA-256 of
    the cluster's centroid (decimal components joined by commas)."""
    def pick(values, kind):
        if not values:
            return F.lit(None).cast(kind)
        return F.array(*(F.lit(v).cast(kind) for v in values))[F.col("cluster")]

    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in clusters.centroids]
    return clusters.assigned.select(
        "*", pick(clusters.inertia, "bigint").alias("cluster_inertia"),
        F.lit(sum(clusters.inertia)).cast("bigint").alias("inertia"),
        pick(digests, "string").alias("centroid_sha256"))


def oracle_sql(k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1) -> str:
    """The same over ``embeddings`` in DuckDB (components and sums below 2^53)."""
    steps = [f"""
kept AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE len(embedding) = {dims}
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY h) - 1 AS k, v AS c
    FROM (SELECT v, sha256('{seed}:' || CAST(vec_id AS VARCHAR)) AS h FROM kept ORDER BY h LIMIT {k}))"""]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
    SELECT vec_id, any_value(v) AS v, min(struct_pack(d := d, k := k)) AS best
    FROM (SELECT vec_id, v, k, list_inner_product(v, v) - 2 * list_inner_product(v, c)
                 + list_inner_product(c, c) AS d FROM kept, c{r})
    GROUP BY vec_id)""")
        if r < rounds:
            steps.append(f"""
c{r + 1} AS MATERIALIZED (
    SELECT c{r}.k, coalesce(m.c, c{r}.c) AS c FROM c{r} LEFT JOIN (
        SELECT k, list(x ORDER BY j) AS c FROM (
            SELECT best.k AS k, j, floor(sum(v[j]) / count(*)) AS x
            FROM a{r}, generate_series(1, {dims}) s(j) GROUP BY ALL) GROUP BY k) m ON m.k = c{r}.k)""")
    return f"""WITH {",".join(steps)}
SELECT vec_id, CAST(best.k AS INTEGER) AS "cluster", CAST(best.d AS BIGINT) AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
       sha256(list_aggregate(list_transform(c, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)),
                             'string_agg', ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON best.k = c{rounds}.k"""
