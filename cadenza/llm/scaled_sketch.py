"""Threshold-scaled sketches: every shingle hash below a fixed fraction is kept.

A text's shingles are its runs of ``SHINGLE`` code points (a shorter text is one
shingle). Each is hashed to ``HASH_BITS`` bits and kept if it is below
``1 / SCALE`` of the range, so a sketch grows with its text, the sketch of a
union is the union of the sketches, and shared hashes over those of the smaller
sketch estimate containment between texts of very unequal length. A text whose
shingles all miss the fraction keeps its smallest hash.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm.common import code_points, mix64, slices, text_slices

SHINGLE = 16
SCALE = 16
HASH_BITS = 40
SLICE_CHARS = 500_000
_BASE = 0x9E3779B97F4A7C15
_NONE = np.zeros(0, dtype=np.uint64)


def _sketch_slice(texts) -> list[np.ndarray]:
    points, bounds = code_points([t + "\x00" * max(0, SHINGLE - len(t)) if t else "" for t in texts])
    key, width, base = points.astype(np.uint64) + np.uint64(1), 1, _BASE
    while width < SHINGLE:  # a run of twice the width from two neighbouring runs
        if len(key) <= width:
            return [_NONE] * len(texts)
        key = key[:-width] * np.uint64(base) + key[width:]
        base, width = base * base % (1 << 64), width * 2
    value = mix64(key) >> np.uint64(64 - HASH_BITS)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))[:len(value)]
    whole = owner == np.repeat(np.arange(len(texts)), np.diff(bounds))[SHINGLE - 1:]
    below = np.flatnonzero(whole & (value < np.uint64((1 << HASH_BITS) // SCALE)))
    out = [_NONE] * len(texts)
    cuts = np.searchsorted(owner[below], np.arange(len(texts) + 1))
    for k in range(len(texts)):
        if cuts[k + 1] > cuts[k]:
            out[k] = np.unique(value[below[cuts[k]:cuts[k + 1]]])
        elif texts[k]:
            out[k] = value[bounds[k]:bounds[k + 1] - SHINGLE + 1].min(keepdims=True)
    return out


def sketches(texts) -> list[np.ndarray]:
    """Sorted distinct kept hashes of each text; an empty text has none."""
    return [s for a, b in text_slices(texts, SLICE_CHARS) for s in _sketch_slice(texts[a:b])]


def to_string(sketch: np.ndarray) -> str:
    """Ten hex digits per hash, ascending: equal sketches are equal strings."""
    return sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - HASH_BITS // 8:].tobytes().hex()


def from_string(text: str) -> np.ndarray:
    own = np.frombuffer(bytes.fromhex(text), dtype=np.uint8).reshape(-1, HASH_BITS // 8)
    wide = np.zeros((len(own), 8), dtype=np.uint8)
    wide[:, 8 - HASH_BITS // 8:] = own
    return wide.view(">u8").ravel().astype(np.uint64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated containment of the smaller shingle set in the other (0 to 1).

    Two empty sketches are alike (1), an empty and another one are not (0).
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / min(len(a), len(b))


def _at_most(values: list, kind: str, x: Column) -> Column:
    """How many of the ascending ``values`` are at most ``x``, by binary search."""
    if not values:
        return F.lit(0)
    table = F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")
    steps = [1 << k for k in reversed(range(len(values).bit_length()))]
    return F.reduce(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(
        F.get(table, at + step - 1) <= x, at + step).otherwise(at))


def _quantiles(rows: DataFrame, value: Column, count: int, *more: Column):
    """``count`` inner quantiles of ``value`` (None without rows), then ``more``."""
    inner = [(k + 1) / (count + 1) for k in range(count)]
    return rows.agg(F.percentile_approx(value, inner, max(10_000, 8 * count)), *more).first()


def _laid(rows: DataFrame, groups: int) -> DataFrame:
    """``rows`` with ``group``, never falling by (id, text), and ``run``.

    Ids are cut at quantiles. An id on several of them, and the null id, is a
    ``run``: its rows are cut at quantiles of the first bytes of their texts.
    """
    kind = rows.schema["id"].dataType.simpleString()
    cuts, total, nulls = _quantiles(rows, F.col("id"), groups - 1, F.count(F.lit(1)),
                                    F.count_if(F.col("id").isNull()))
    often = Counter(cuts or ())
    cuts = sorted(often)
    null_cuts = groups * nulls // total if total else 0
    heavy = [0] + [int(often[c] > 1) for c in cuts]  # whether interval k begins with a run
    runs = np.cumsum(heavy) + 1  # up to interval k, the null id counted as the first
    size = min(6, (52 - int(runs[-1]).bit_length()) // 8)  # bytes; doubles hold run and bytes
    table = lambda values: F.split(F.lit(",".join(map(str, values))), ",").cast("array<long>")
    begin = F.conv(F.rpad(F.substring(F.hex(F.substring("text", 1, size)), 1, 2 * size), 2 * size, "0"),
                   16, 10).cast("long")
    rows = rows.withColumn("at", F.when(F.col("id").isNull(), 0).otherwise(_at_most(cuts, kind, F.col("id"))))
    starts = F.lit(False)
    if cuts:
        own = F.get(F.split(F.lit(",".join(map(str, cuts))), ",").cast(f"array<{kind}>"), F.col("at") - 1)
        starts = F.coalesce((F.get(table(heavy), F.col("at")) == 1) & (F.col("id") == own), F.lit(False))
    number = F.get(table(runs), F.col("at"))
    span = F.lit(1 << 8 * size)
    rows = (rows.withColumn("run", F.col("id").isNull() | starts)
            .withColumn("place", F.when(F.col("id").isNull(), begin)
                        .when(F.col("run"), (number - 1) * span + begin).otherwise(number * span - 1)))
    wanted = null_cuts + sum(n for n in often.values() if n > 1)
    inner = _quantiles(rows.where("run"), F.col("place"), wanted)[0] if wanted else None
    inner = sorted(set(inner or ()))
    return rows.select("id", "text", "run", (
        F.col("at") + _at_most(inner, "long", F.col("place"))).cast("int").alias("group"))


def with_next(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows laid out so that each is followed by the next one of ``id_col`` order.

    Returns ``group``, ``ahead``, ``id`` and ``text``, sorted by these within
    every task: rows with ``ahead`` = 0 are the input; each group ends in a copy
    (``ahead`` = 1) of the row that follows it, after the last group of the
    first row. Groups are ranges of ids with about equal numbers of rows, also
    where ids are far apart; many rows of one id or without an id are cut by the
    first bytes of their texts, only texts that begin alike stay together. One
    shuffle of the texts in all; what reaches the driver is a bounded number of
    cuts, an id and a hash per group. Null ids come first, equal ids are ordered
    by text. Ids are numbers or dates.
    """
    spark = df.sparkSession
    groups = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _laid(df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")),
                 groups)
    # texts are read for runs only: elsewhere the first id of a group names its first row
    first = sorted(rows.groupBy("group").agg(F.min(F.struct(
        "id", F.when(F.col("run"), F.col("text")).alias("text"))).alias("first"))
        .select("group", "first.id", F.sha2("first.text", 256).alias("sha")).collect())
    kind = rows.schema["id"].dataType
    ahead = spark.createDataFrame(
        [(r["group"], r["id"], r["sha"], first[k - 1]["group"]) for k, r in enumerate(first)],
        T.StructType([T.StructField("first_group", T.IntegerType()), T.StructField("first_id", kind),
                      T.StructField("sha", T.StringType()), T.StructField("before", T.IntegerType())]))
    leads = F.col("before").isNotNull() & (F.col("sha").isNull() | (F.sha2("text", 256) == F.col("sha")))
    place = F.array(F.struct(F.col("group"), F.lit(0).alias("ahead")),
                    F.struct(F.when(leads, F.col("before")).alias("group"), F.lit(1).alias("ahead")))
    return (rows.join(F.broadcast(ahead), (F.col("group") == F.col("first_group"))
                      & F.col("id").eqNullSafe(F.col("first_id")), "left")
            .select("id", "text", F.inline(F.filter(place, lambda p: p["group"].isNotNull())))
            .repartition("group").sortWithinPartitions("group", "ahead", "id", "text")
            .select("group", "ahead", "id", "text"))


def fingerprint_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Sketch each text, its edited form and the text after it.

    The edit replaces the last quarter (floor) of the code points by the first
    as many of the next text in ``id_col`` order (all of it if shorter; after the
    last comes the first). Returns the id, ``n_chars``, ``edited_sha256``, both
    fingerprints and the likeness of the text's fingerprint to the edited one
    (``near_edited``) and to the next text's (``near_next``). A null text counts
    as empty; repeated rows are kept, each followed by its copy; an empty table
    gives no rows; other columns are not read.
    """
    laid = with_next(df, id_col, text_col)
    kind = laid.schema["id"]
    schema = T.StructType([T.StructField(id_col, kind.dataType)] + T._parse_datatype_string(
        "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double").fields)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        layout = to_arrow_schema(schema)
        held = None  # the last row so far: its successor is in the next batch
        for batch in slices(batches):
            ids, texts = batch.column("id"), batch.column("text").to_pylist()
            flags = batch.column("ahead").to_pylist()
            if held is not None:
                ids = pa.concat_arrays([held[0], ids])
                texts, flags = [held[1], *texts], [held[2], *flags]
            held = (ids[-1:], texts[-1], flags[-1])
            own = sketches(texts)
            at = [k for k in range(len(texts) - 1) if not flags[k]]
            cut = [len(texts[k]) // 4 for k in at]
            edited = [texts[k][:len(texts[k]) - c] + texts[k + 1][:c] for k, c in zip(at, cut)]
            changed = sketches(edited)
            columns = [
                ids.take(pa.array(at, pa.int64())),
                [len(texts[k]) for k in at],
                [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited],
                [to_string(own[k]) for k in at],
                [to_string(s) for s in changed],
                [likeness(own[k], s) for k, s in zip(at, changed)],
                [likeness(own[k], own[k + 1]) for k in at],
            ]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type)
                 for c, f in zip(columns, layout)], schema=layout)

    return laid.mapInArrow(run, schema)
