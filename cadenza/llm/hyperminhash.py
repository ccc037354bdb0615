"""Near-duplicate documents by HyperMinHash registers, banding and exact checks.

Every shingle hash falls into one of ``BUCKETS`` buckets by its leading bits; the
register of a bucket describes its smallest remaining hash by the number of
leading zeros and the next ``MANTISSA`` bits. Empty buckets copy the first full
one of a fixed random order of their own, so registers of two sets agree with
the probability of their Jaccard similarity, small sets included.

Texts with equal shingle sets are one class with its smallest id as
representative. Representatives that share a band of registers are candidates.
They are never expanded into all pairs: first every member of a band group is
checked against one leader of the group, the links found are closed to
components, and only members of different components of a group are compared
further, in blocks that return one link per pair of components joined. The
similarity estimated from the registers, corrected for chance collisions,
rejects hopeless candidates with a margin of ``MARGIN`` standard errors; all
others are confirmed on the full shingle sets.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import (add_columns, broadcast_up_to, map_groups, mix64, stored,
                                stored_counted)
from cadenza.llm.components import BROADCAST_ROWS, counted_components
from cadenza.llm.word_shingles import shingle_sets

BUCKETS = 256
BUCKET_BITS = 8
MANTISSA = 10
BAND = 5
BANDS = 44  # 0.75 alike: all bands differ with probability (1 - 0.75 ** 5) ** 44 < 1e-5
MARGIN = 4.5
NUMERATOR, DENOMINATOR = 75, 100
BLOCK = 256  # members of a band group in one comparison block
LEADERS = 6  # orders of the ids that leaders are taken from, so that they differ
BROADCAST_IDS = 1_000_000

_random = np.random.Generator(np.random.PCG64(11))
_ORDER = np.argsort(_random.random((BUCKETS, BUCKETS)), axis=1)  # where an empty bucket looks
_BAND_PLACE = _random.integers(1, 1 << 63, (BANDS, BAND), dtype=np.uint64) | np.uint64(1)


def registers(hashes: np.ndarray) -> np.ndarray:
    """Registers of a non-empty ascending set of 64-bit hashes."""
    bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    rest = hashes[first] << np.uint64(BUCKET_BITS)
    # bits below the leading one; exact in two halves as doubles hold 53 bits
    high = (rest >> np.uint64(32)).astype(np.float64)
    low = (rest & np.uint64(0xFFFFFFFF)).astype(np.float64)
    zeros = np.where(high > 0, 32 - np.frexp(high)[1], 64 - np.frexp(low)[1])
    zeros = np.minimum(zeros, 64 - BUCKET_BITS - MANTISSA).astype(np.uint64)
    mantissa = (rest << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    out = np.zeros(BUCKETS, dtype=np.uint16)
    full = np.zeros(BUCKETS, dtype=bool)
    out[bucket[first]] = (zeros << np.uint64(MANTISSA)) | mantissa
    full[bucket[first]] = True
    empty = np.flatnonzero(~full)
    if len(empty):
        order = _ORDER[empty]
        out[empty] = out[order[np.arange(len(empty)), full[order].argmax(axis=1)]]
    return out


def band_keys(table: np.ndarray) -> np.ndarray:
    """Hash of each band of each row of a register table."""
    own = table[:, :BANDS * BAND].reshape(len(table), BANDS, BAND).astype(np.uint64)
    mixed = (mix64(own + np.uint64(1)) * _BAND_PLACE).sum(axis=2, dtype=np.uint64)
    return mix64(mixed + np.arange(BANDS, dtype=np.uint64)).astype(np.int64)


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Probability that a register of two disjoint sets of n and m agrees by chance.

    The smallest of a bucket's hashes is about exponential; within one number of
    leading zeros the mantissa spreads evenly over its 2 ** MANTISSA values.
    """
    edge = 2.0 ** -np.arange(0, 48)

    def share(count):
        rate = np.asarray(count, dtype=np.float64)[..., None] / BUCKETS
        reach = np.exp(-np.maximum(rate, 1.0) * edge)
        return reach[..., 1:] - reach[..., :-1]

    return (share(n) * share(m)).sum(axis=-1) / 2 ** MANTISSA


def estimate(same: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the share of equal registers, without chance ones."""
    by_chance = chance(n, m)
    return (same - by_chance) / (1.0 - by_chance)


def _hopeful(same, n, m):
    """Whether the estimate and the set sizes leave room for a link."""
    small, large = np.minimum(n, m), np.maximum(n, m)
    sure = NUMERATOR / DENOMINATOR
    margin = MARGIN * np.sqrt(sure * (1 - sure) / np.minimum(BUCKETS, np.maximum(small, 1)))
    return (DENOMINATOR * small >= NUMERATOR * large) & (estimate(same, n, m) >= sure - margin)


def signatures(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, set size ``n``, two set hashes ``c1`` and ``c2``, and ``regs``."""
    def prepare():
        def compute(texts):
            sets = shingle_sets(texts)
            with np.errstate(over="ignore"):
                one = [int(mix64(s).sum(dtype=np.uint64).astype(np.int64)) for s in sets]
                two = [int(np.bitwise_xor.reduce(mix64(s + np.uint64(29))).astype(np.int64))
                       if len(s) else 0 for s in sets]
            return ([len(s) for s in sets], one, two,
                    [registers(s).tobytes() if len(s) else None for s in sets])
        return compute

    return add_columns(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")),
                       ["text"], "n long, c1 long, c2 long, regs binary", prepare, drop=["text"])


def _band_rows(signed: DataFrame) -> DataFrame:
    """One row (key, id) per band of every signature."""
    def prepare():
        def compute(regs):
            table = np.frombuffer(b"".join(regs), dtype=np.uint16).reshape(-1, BUCKETS)
            return (band_keys(table).tolist(),)
        return compute

    return add_columns(signed.select("id", "regs"), ["regs"], "keys array<bigint>", prepare,
                       drop=["regs"]).select(F.explode("keys").alias("key"), "id")


def _estimated(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """Pairs (a, b) that the registers do not rule out."""
    left = signed.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("regs").alias("ra"))
    right = signed.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("regs").alias("rb"))

    def prepare():
        def compute(na, ra, nb, rb):
            left, right = (np.frombuffer(b"".join(r), dtype=np.uint16).reshape(-1, BUCKETS)
                           for r in (ra, rb))
            return (_hopeful((left == right).mean(axis=1), np.array(na), np.array(nb)),)
        return compute

    sized = pairs.join(left, "a").join(right, "b").where(
        f"{DENOMINATOR} * least(na, nb) >= {NUMERATOR} * greatest(na, nb)")
    return add_columns(sized, ["na", "ra", "nb", "rb"], "hopeful boolean", prepare,
                       drop=["na", "ra", "nb", "rb"]).where("hopeful").select("a", "b")


def _alike(one: np.ndarray, two: np.ndarray) -> bool:
    """Whether two full sets share enough of their union."""
    shared = len(np.intersect1d(one, two, assume_unique=True))
    return DENOMINATOR * shared >= NUMERATOR * (len(one) + len(two) - shared)


def _confirmed(pairs: DataFrame, rows: int, df: DataFrame, id_col: str,
               text_col: str) -> DataFrame:
    """Pairs whose full shingle sets are alike enough; ``pairs`` is stored with ``rows`` rows."""
    texts = _texts(df, pairs.select(F.explode(F.array("a", "b")).alias("id")), 2 * rows,
                   id_col, text_col)

    def prepare():
        def compute(left, right):
            place: dict[str, int] = {}
            at = [(place.setdefault(x, len(place)), place.setdefault(y, len(place)))
                  for x, y in zip(left, right)]
            sets = shingle_sets(list(place))
            return ([_alike(sets[x], sets[y]) for x, y in at],)
        return compute

    both = (pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b"))
    return add_columns(both, ["ta", "tb"], "linked boolean", prepare,
                       drop=["ta", "tb"]).where("linked").select("a", "b")


def _order(key, number):
    """A number of the id in one of ``LEADERS`` orders, chosen by key; its own inverse."""
    return F.col(number).bitwiseXOR(F.xxhash64(F.pmod(key, F.lit(LEADERS))))


def _leaders(bands: DataFrame) -> DataFrame:
    """(key, leader) of the band groups with two members or more."""
    return (bands.groupBy("key").agg(F.min(_order(F.col("key"), "id")).alias("low"),
                                     F.max(_order(F.col("key"), "id")).alias("high"))
            .where("low <> high").select("key", _order(F.col("key"), "low").alias("leader")))


def _leader_pairs(shared: DataFrame) -> DataFrame:
    return (shared.where("id <> leader")
            .select(F.least("leader", "id").alias("a"), F.greatest("leader", "id").alias("b"))
            .distinct())


def _texts(df: DataFrame, ids: DataFrame, rows: int, id_col: str, text_col: str) -> DataFrame:
    """Texts of the ``ids`` (at most ``rows``, broadcast up to a bound)."""
    ids = F.broadcast(ids) if rows <= BROADCAST_IDS else ids.distinct()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        ids, "id", "left_semi")


def _cross_links(shared: DataFrame, linked: DataFrame, df: DataFrame, id_col: str,
                 text_col: str) -> DataFrame:
    """Components (a, b) joined by a link between members of one band group.

    In each group the members outside its largest component are compared with
    all members, block by block; a block holds at most 2 * ``BLOCK`` members and
    returns at most one link of a member to each component. ``linked`` names the
    components of linked ids; any other id is one of its own.
    """
    own = shared.join(linked, "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("comp"))
    sizes = own.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    mixed, of = stored_counted(sizes.groupBy("key").agg(
        F.sum("n").alias("g"), F.max(F.struct("n", "comp")).alias("top"))
        .where("g > top.n and g > 2")
        .select("key", F.col("top.comp").alias("main"),
                F.ceil(F.col("g") / BLOCK).cast("int").alias("wide"),
                F.ceil((F.col("g") - F.col("top.n")) / BLOCK).cast("int").alias("high")))
    if not of["rows"]:
        return shared.sparkSession.createDataFrame([], "a bigint, b bigint")
    members, of = stored_counted(own.join(broadcast_up_to(mixed, of["rows"], BROADCAST_ROWS), "key"))

    def prepare():
        def compute(texts):
            sets = shingle_sets(texts)
            return [s.tobytes() for s in sets], [registers(s).tobytes() for s in sets]
        return compute

    sets = add_columns(_texts(df, members.select("id"), of["rows"], id_col, text_col), ["text"],
                       "hashes binary, regs binary", prepare, drop=["text"])
    place = F.abs(F.xxhash64("id"))
    base = members.select(
        "key", "id", "comp", (place % F.col("wide")).cast("int").alias("col"),
        F.explode(F.sequence(F.lit(0), F.col("high") - 1)).alias("row"), F.lit(False).alias("probe"))
    probe = members.where("comp <> main").select(
        "key", "id", "comp", F.explode(F.sequence(F.lit(0), F.col("wide") - 1)).alias("col"),
        (place % F.col("high")).cast("int").alias("row"), F.lit(True).alias("probe"))

    def handle(table):
        probe = np.array(table.column("probe").to_pylist())
        comp = table.column("comp").to_numpy()
        own = [np.frombuffer(h, dtype=np.uint64) for h in table.column("hashes").to_pylist()]
        n = np.array([len(h) for h in own])
        regs = np.frombuffer(b"".join(table.column("regs").to_pylist()),
                             dtype=np.uint16).reshape(-1, BUCKETS)
        base = np.flatnonzero(~probe)
        left, right = [], []
        for k in np.flatnonzero(probe):
            other = base[comp[base] != comp[k]]
            same = (regs[other] == regs[k]).mean(axis=1)
            other = other[_hopeful(same, np.full(len(other), n[k]), n[other])]
            joined = set()
            for o in other:
                if comp[o] not in joined and _alike(own[k], own[o]):
                    joined.add(comp[o])
                    left.append(comp[k])
                    right.append(comp[o])
        return left, right

    return map_groups(base.union(probe).join(sets, "id"), ["key", "col", "row"],
                      "a bigint, b bigint", handle)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: ``id_col``, ``n_shingles``, ``component_id``, ``kept``.

    Two texts are linked when their 5-word shingle sets share at least 75 % of
    their union (see ``shingle_sets`` for words). ``component_id`` is the
    smallest id reachable by links, ``kept`` whether it is the row's own. Equal
    sets are linked whatever their ids; a null text, an empty text or one
    without words has no shingles and is linked with nothing. Ids are expected
    to be unique integers: repeated rows come back repeated with equal results,
    and a row without an id is its own group (null, kept). Other columns are not
    read. Candidates are missed with a probability below 1e-5 at the threshold.
    """
    signed = stored(signatures(df, id_col, text_col))
    able = signed.where("n > 0 and id is not null")
    classes = stored(able.groupBy("n", "c1", "c2").agg(F.min(F.struct("id", "regs")).alias("first"))
                     .select("n", "c1", "c2", F.col("first.id").alias("rep"), "first.regs"))
    reps = classes.select(F.col("rep").alias("id"), "n", "regs")
    bands = _band_rows(reps)
    groups, of = stored_counted(_leaders(bands))
    shared = stored(bands.join(broadcast_up_to(groups, of["rows"], BROADCAST_ROWS), "key"))
    pairs, of = stored_counted(_estimated(_leader_pairs(shared), reps))
    linked, rows = counted_components(_confirmed(pairs, of["rows"], df, id_col, text_col))
    linked = broadcast_up_to(linked, rows, BROADCAST_ROWS)
    joined, rows = counted_components(_cross_links(shared, linked, df, id_col, text_col))
    joined = broadcast_up_to(joined.select(F.col("id").alias("own"), F.col("component").alias("top")),
                             rows, BROADCAST_ROWS)
    named = (classes.join(linked.withColumnRenamed("id", "rep"), "rep", "left")
             .select("n", "c1", "c2", F.coalesce("component", "rep").alias("own"))
             .join(joined, "own", "left")
             .select("n", "c1", "c2", F.coalesce("top", "own").alias("component")))
    return (signed.join(named, ["n", "c1", "c2"], "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
                    .alias("component_id"))
            .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id"))))
