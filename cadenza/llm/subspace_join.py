"""Near-duplicate embeddings by a subspace pigeonhole join, verified exactly.

Unit vectors are rotated by one fixed random orthogonal matrix and split into
``BLOCKS`` subspaces. If the squared distance of two vectors is at most the
budget of the cosine threshold, 2 - 2 * cosine, then in some subspace it is at
most that subspace's share by dimension. Each subspace is cut into the Voronoi
cells of sites fitted on a bounded sample; a vector is a member of its own cell
and probes every later cell that a ball of the subspace's radius around it
reaches, so no pair within the budget of a subspace is missed.

Cells are compared block by block in numpy. A pair is taken in the first
subspace whose budget it meets, so the union of the candidates holds it once;
its cosine is then computed in double precision from the original components.
What a block returns is a count of links per vector and a spanning forest of the
links, never the pairs.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import add_columns, map_groups, mix64, stored
from cadenza.llm.components import components

THRESHOLD = 0.95
BLOCKS = 4
SAMPLE = 20_000  # vectors the sites are fitted on
CELL = 1600  # vectors of a cell aimed at
MAX_CELLS = 4096
MEMBERS, PROBES = 1024, 4096  # of one comparison block
SLACK = 1e-9
UNION = 16  # vector lengths whose results are stored together


def _unit(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)  # no overflow in the squares
    return wide / np.sqrt((wide * wide).sum(axis=1, keepdims=True))


class Subspaces:
    """Rotation, blocks, radii and Voronoi sites for vectors of one length."""

    def __init__(self, sample: np.ndarray, cells: int, threshold: float):
        size = sample.shape[1]
        random = np.random.Generator(np.random.PCG64(5))
        rotation = np.linalg.qr(random.standard_normal((size, size)))[0]
        parts = np.array_split(np.arange(size), min(BLOCKS, size))
        self.rotations = [np.ascontiguousarray(rotation[:, p]) for p in parts]
        self.budgets = [(2 - 2 * threshold) * len(p) / size * (1 + SLACK) + 1e-12 for p in parts]
        unit = _unit(sample)
        self.sites = [self._fit(unit @ r, cells, random) for r in self.rotations]
        self.threshold = threshold

    @staticmethod
    def _fit(points: np.ndarray, cells: int, random) -> np.ndarray:
        sites = np.unique(points[random.permutation(len(points))[:cells]], axis=0)
        for _ in range(4):
            near = Subspaces._squares(points, sites).argmin(axis=1)
            count = np.bincount(near, minlength=len(sites))
            total = np.zeros_like(sites)
            np.add.at(total, near, points)
            sites = np.unique(np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None],
                                       sites), axis=0)
        return sites

    @staticmethod
    def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * a @ b.T

    def cells(self, unit: np.ndarray):
        """Per subspace the cell of each vector and the (vector, cell) pairs probed."""
        for block, rotation in enumerate(self.rotations):
            sites, own = self.sites[block], unit @ rotation
            square = self._squares(own, sites)
            home = square.argmin(axis=1)
            apart = np.sqrt(np.maximum(self._squares(sites, sites), 0))[home]
            beyond = square - square[np.arange(len(own)), home][:, None]
            reach = np.sqrt(self.budgets[block]) * (1 + SLACK) + 1e-9
            touched = (beyond <= 2 * apart * reach + 1e-9) & (np.arange(len(sites)) > home[:, None])
            yield block, home, np.nonzero(touched)


MEMBER, PROBE, HOME_PROBE = 0, 1, 2


def _chunks(counts) -> dict[tuple[int, int], tuple[int, int]]:
    """(member chunks, probe chunks) of each (subspace, cell).

    The members of a cell cut into chunks also probe it.
    """
    out = {}
    for block, cell, members, probes in counts:
        wide = max(1, -(-members // MEMBERS))
        out[block, cell] = (wide, max(1, -(-(probes + (members if wide > 1 else 0)) // PROBES)))
    return out


def _vectors(column, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _routes(spaces: Subspaces, chunks, unit: np.ndarray, ids: np.ndarray):
    """Comparison blocks of each vector as (vector, 4 * key + role).

    The key holds subspace, cell, member chunk and probe chunk.
    """
    place = (mix64(ids.view(np.uint64)) >> np.uint64(1)).astype(np.int64)
    at, keys = [], []

    def add(rows, block, cell, role):
        size = np.array([chunks[block, c] for c in range(len(spaces.sites[block]))])[cell]
        fixed, spread = (size[:, 1], size[:, 0]) if role else (size[:, 0], size[:, 1])
        again = np.repeat(np.arange(len(rows)), spread)
        other = np.arange(len(again)) - np.repeat(np.cumsum(spread) - spread, spread)
        mine = (place[rows] % fixed)[again]
        column, row = (other, mine) if role else (mine, other)
        at.append(rows[again])
        keys.append((((np.int64(block) << 53) + (cell[again].astype(np.int64) << 40)
                      + (column << 20) + row) << 2) + role)

    for block, home, (rows, cells) in spaces.cells(unit):
        add(np.arange(len(unit)), block, home, MEMBER)
        add(rows, block, cells, PROBE)
        cut = np.array([chunks[block, c][0] > 1 for c in range(len(spaces.sites[block]))])
        split = np.flatnonzero(cut[home])
        add(split, block, home[split], HOME_PROBE)
    return np.concatenate(at), np.concatenate(keys)


def _compare(spaces: Subspaces, block: int, probes: np.ndarray, members: np.ndarray):
    """Linked (probe, member) positions whose first subspace in budget is ``block``."""
    left, right = probes @ spaces.rotations[block], members @ spaces.rotations[block]
    found = []
    for start in range(0, len(left), 1024):
        square = Subspaces._squares(left[start:start + 1024], right)
        p, m = np.nonzero(square <= spaces.budgets[block] + 1e-9)
        for a in range(0, len(p), 100_000):
            q, o = p[a:a + 100_000] + start, m[a:a + 100_000]
            good = (probes[q] * members[o]).sum(axis=1) >= spaces.threshold
            q, o = q[good], o[good]
            gap = probes[q] - members[o]
            first = np.full(len(q), -1)
            for k, rotation in enumerate(spaces.rotations[:block + 1]):
                inside = ((gap @ rotation) ** 2).sum(axis=1) <= spaces.budgets[k]
                first[(first < 0) & inside] = k
            found.append((q[first == block], o[first == block]))
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate([none, *(f[k] for f in found)]) for k in (0, 1))


def _roots(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Smallest position reachable from each of ``size`` over the edges (a, b)."""
    label = np.arange(size)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _linked(reps: DataFrame, size: int, threshold: float) -> DataFrame:
    """Partial results (id, links, root) of the vectors of one length."""
    spark = reps.sparkSession
    own = reps.where(F.size("vector") == size)
    n = own.count()
    sample = np.array([r[0] for r in own.orderBy(F.xxhash64("id")).limit(SAMPLE)
                       .select("vector").collect()])
    cells = min(MAX_CELLS, 1 << max(3, round(np.log2(max(n, 1) / CELL))))
    spaces = spark.sparkContext.broadcast(Subspaces(sample, cells, threshold))

    def count(batches):
        members = [np.zeros(len(s), np.int64) for s in spaces.value.sites]
        probes = [np.zeros(len(s), np.int64) for s in spaces.value.sites]
        for batch in batches:
            if batch.num_rows:
                unit = _unit(_vectors(batch.column("vector"), size))
                for block, home, (_, reached) in spaces.value.cells(unit):
                    members[block] += np.bincount(home, minlength=len(members[block]))
                    probes[block] += np.bincount(reached, minlength=len(probes[block]))
        for block, (m, p) in enumerate(zip(members, probes)):
            yield pa.RecordBatch.from_pydict({
                "block": np.full(len(m), block, np.int32),
                "cell": np.arange(len(m), dtype=np.int32), "members": m, "probes": p})

    counts = (own.select("vector").mapInArrow(count, "block int, cell int, members long, probes long")
              .groupBy("block", "cell").agg(F.sum("members"), F.sum("probes")).collect())
    chunks = spark.sparkContext.broadcast(_chunks(counts))  # at most BLOCKS x MAX_CELLS

    def prepare():
        def compute(ids, vectors):
            unit = _unit(np.array(vectors))
            at, keys = _routes(spaces.value, chunks.value, unit, np.array(ids, dtype=np.int64))
            order = np.argsort(at, kind="stable")
            cuts = np.searchsorted(at[order], np.arange(1, len(ids)))
            return (np.split(keys[order], cuts),)
        return compute

    routed = (add_columns(own, ["id", "vector"], "routes array<bigint>", prepare)
              .select("id", "size", "vector", F.explode("routes").alias("route"))
              .select(F.shiftright("route", 2).alias("key"),
                      F.col("route").bitwiseAND(3).cast("int").alias("role"),
                      "id", "size", "vector"))

    def handle(table):
        key = table.column("key")[0].as_py()
        block, cell, row = key >> 53, key >> 40 & 0x1FFF, key & 0xFFFFF
        role, ids, sizes = (table.column(c).to_numpy() for c in ("role", "id", "size"))
        unit = _unit(_vectors(table.column("vector").combine_chunks(), size))
        members = np.flatnonzero(role == MEMBER)
        asking = [(np.flatnonzero(role == PROBE), False), (np.flatnonzero(role == HOME_PROBE), True)]
        if chunks.value[block, cell][0] == 1 and row == 0:
            asking.append((members, True))
        ends = []
        for probes, home in asking:
            p, m = _compare(spaces.value, block, unit[probes], unit[members])
            p, m = probes[p], members[m]
            once = ids[p] < ids[m] if home else np.ones(len(p), bool)  # home pairs meet twice
            ends.append((p[once], m[once]))
        a, b = (np.concatenate([e[k] for e in ends]) for k in (0, 1))
        names, position = np.unique(ids, return_inverse=True)
        links = np.zeros(len(names), np.int64)
        np.add.at(links, position[a], sizes[b])
        np.add.at(links, position[b], sizes[a])
        root = _roots(position[a], position[b], len(names))
        shown = np.flatnonzero(links)
        return names[shown], links[shown], names[root[shown]]

    return map_groups(routed, ["key"], "id long, links long, root long", handle)


def _partial(classes: DataFrame, threshold: float) -> DataFrame | None:
    """Links inside each length, None without vectors; the results of ``UNION`` lengths are stored at a time."""
    lengths = sorted(r[0] for r in classes.select(F.size("vector")).distinct().collect())
    parts = [stored(reduce(DataFrame.union, [
        _linked(classes, size, threshold) for size in lengths[k:k + UNION]]))
        for k in range(0, len(lengths), UNION)]
    return reduce(DataFrame.union, parts) if parts else None


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = THRESHOLD) -> DataFrame:
    """One row per row: ``id_col``, ``n_links``, ``component_id`` and ``kept``.

    Vectors are linked when their cosine in double precision is at least
    ``threshold``; only vectors of equal length are compared. A vector that is
    null, empty or zero or holds a null or non-finite component links with
    nothing, nor does one without an id. Equal vectors are one class, so that
    copies are counted but not compared; repeated rows count as vectors of their
    own. Other columns are not read. ``component_id`` is the smallest id
    reachable by links, ``kept`` whether it is the row's own.
    """
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) != F.lit(float("inf"))))
    usable = F.col("id").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    rows = stored(df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
                  .withColumn("able", F.coalesce(usable, F.lit(False))))
    able = rows.where("able").select("id", "vector")
    classes = stored(able.groupBy("vector").agg(F.min("id").alias("id"),
                                                F.count(F.lit(1)).alias("size")))
    alone = rows.where("not able").select("id", F.lit(0).cast("long").alias("links"),
                                          F.col("id").alias("component"))
    partial = _partial(classes, threshold)
    if partial is not None:
        linked = components(partial.where("id <> root").select(
            F.col("id").alias("a"), F.col("root").alias("b")))
        found = (classes.join(partial.groupBy("id").agg(F.sum("links").alias("links")), "id", "left")
                 .join(linked, "id", "left")
                 .select("vector", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links"),
                         F.coalesce("component", "id").alias("component")))
        alone = able.join(found, "vector").select("id", "links", "component").union(alone)
    return (alone.select(F.col("id").alias(id_col), F.col("links").alias("n_links"),
                         F.col("component").alias("component_id"))
            .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id"))))
