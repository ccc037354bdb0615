"""Skew-safe positions: a global dense index and a per-group row number.

The textbook forms - ``dense_rank() OVER (ORDER BY k)`` or ``row_number() OVER
(PARTITION BY user ORDER BY ts)`` - put one whole group in one task: the global
window runs on a single partition, and a user holding a third of all rows makes
one task sort a third of the data.

Here every position is computed the same way whatever the group sizes:

1. ``repartitionByRange(group, order)``: bounds come from a sample of the keys, so
   a hot group is cut across many partitions. Each partition is sorted, and
   ``monotonically_increasing_id`` then yields (partition id << 33) + local
   position.
2. A per-(partition, group) summary - one row per group per partition it touches,
   so at most #groups + #partitions rows - gives each slice its offset. It is
   joined back on (partition, group): AQE broadcasts it when the measured size is
   small, otherwise it is a sort-merge join on a key that is never hot (a hot
   group is already split by partition). The table of the global index has one
   row per partition, so it is bounded by the partition count and broadcast.

Both passes must see one and the same layout, but range bounds are sampled from
the input, which arrives in a different order on each evaluation. The tagged
layout is therefore computed once, when the function is called, and written to
the session's checkpoint folder; a lost executor re-reads it.

Rows that tie on every ordering column land in an arbitrary order among
themselves; callers order by all columns that matter so such rows are identical.
A per-row tiebreaker spreads such copies over partitions too, so a run of
identical rows - even a third of the input - is split like any hot group.

Ordering columns must have orderable types; an unorderable one (a map) is
rejected when the function is called. Other columns may have any type.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.session import ensure_checkpoint_dir

PID = "_cz_pid"
LOCAL = "_cz_local"
_MONO = "_cz_mono"
_SALT = "_cz_salt"
_HASH = "_cz_hash"
_LOCAL_MASK = (1 << 33) - 1


def pin(df: DataFrame) -> DataFrame:
    """Evaluate ``df`` once into the shared checkpoint folder (a lineage cut that
    survives lost executors).

    Spark owns the files: with ``spark.cleaner.referenceTracking.cleanCheckpoints``
    (set by ``build_session``) they are deleted once no DataFrame that reads them
    is left.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


def range_layout(df: DataFrame, order: Sequence[Column],
                 num_partitions: int | None = None) -> DataFrame:
    """Range-partition ``df`` on ``order``, sort each partition, and tag every row
    with its partition id (``PID``) and 0-based position inside it (``LOCAL``).

    The layout is stored once (see module notes); AQE may merge adjacent small
    range partitions before (each task still holds one contiguous key range).
    """
    # A unique tiebreaker: rows equal on every ordering key (copies) would
    # otherwise all fall into one range partition, however many there are. The
    # input partitions are sorted first (no shuffle) by a hash of the row, so that
    # a recomputed map task assigns copies the same tiebreakers - rows that arrive
    # from a shuffle come in a different order on every attempt.
    content = [F.col(f.name) for f in df.schema if _hashable(f.dataType)]
    hashed = df.withColumn(_HASH, F.xxhash64(*content) if content else F.lit(0))
    salted = hashed.sortWithinPartitions(_HASH).withColumn(_SALT, F.monotonically_increasing_id())
    keys = [*order, F.col(_HASH).asc(), F.col(_SALT).asc()]
    count = [num_partitions] if num_partitions else []
    ranged = salted.repartitionByRange(*count, *keys).sortWithinPartitions(*keys)
    tagged = ranged.withColumn(_MONO, F.monotonically_increasing_id())
    return pin(tagged.select(
        *[F.col(c) for c in df.columns],
        F.shiftright(F.col(_MONO), 33).cast("int").alias(PID),
        F.col(_MONO).bitwiseAND(F.lit(_LOCAL_MASK)).alias(LOCAL),
    ))


def global_index(df: DataFrame, order: Sequence[Column], out_col: str,
                 total_col: str | None = None,
                 num_partitions: int | None = None) -> DataFrame:
    """Add ``out_col`` = 0-based position of each row in ``order`` (and optionally
    ``total_col`` = the row count), without a single-partition window over rows."""
    laid = range_layout(df, order, num_partitions)
    per_part = laid.groupBy(PID).agg(F.count(F.lit(1)).alias("_cz_n"))
    before = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    # one row per range partition: bounded by the partition count
    offsets = per_part.select(
        F.col(PID).alias("_cz_opid"),
        F.coalesce(F.sum("_cz_n").over(before), F.lit(0)).alias("_cz_off"),
        F.sum("_cz_n").over(Window.partitionBy()).alias("_cz_tot"))
    joined = laid.join(F.broadcast(offsets), laid[PID] == offsets["_cz_opid"], "inner")
    cols = [F.col(c) for c in df.columns]
    cols.append((F.col("_cz_off") + F.col(LOCAL)).alias(out_col))
    if total_col:
        cols.append(F.col("_cz_tot").alias(total_col))
    return joined.select(*cols)


def rank_within(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                rank_col: str, count_col: str | None = None,
                num_partitions: int | None = None) -> DataFrame:
    """Add ``rank_col`` = row_number() over (partition by group order by order),
    1-based, and optionally ``count_col`` = rows in the row's group.

    One path for groups of any size: range layout plus per-(partition, group)
    offsets joined back on a key that is never hot. Null group keys form their
    own group (null-safe equality), as in a window.
    """
    group = list(group)
    keys = [F.col(g).asc_nulls_first() for g in group] + list(order)
    laid = range_layout(df, keys, num_partitions)

    stats = laid.groupBy(PID, *group).agg(
        F.min(LOCAL).alias("_cz_first"), F.count(F.lit(1)).alias("_cz_cnt"))
    by_group = Window.partitionBy(*group).orderBy(PID)
    earlier = F.coalesce(
        F.sum("_cz_cnt").over(by_group.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    s_cols = [F.col(PID).alias("_cz_spid")]
    s_cols += [F.col(g).alias(f"_cz_g{i}") for i, g in enumerate(group)]
    s_cols.append((earlier - F.col("_cz_first") + F.lit(1)).alias("_cz_base"))
    if count_col:
        s_cols.append(F.sum("_cz_cnt").over(Window.partitionBy(*group)).alias("_cz_n"))
    stats = stats.select(*s_cols)

    cond = laid[PID] == stats["_cz_spid"]
    for i, g in enumerate(group):
        cond = cond & laid[g].eqNullSafe(stats[f"_cz_g{i}"])
    joined = laid.join(stats, cond, "inner")
    cols = [F.col(c) for c in df.columns]
    cols.append((F.col(LOCAL) + F.col("_cz_base")).alias(rank_col))
    if count_col:
        cols.append(F.col("_cz_n").alias(count_col))
    return joined.select(*cols)


def window_rank(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                rank_col: str, count_col: str | None = None) -> DataFrame:
    """The plain window form (use where every group is known to be bounded)."""
    w = Window.partitionBy(*group).orderBy(*order)
    out = df.withColumn(rank_col, F.row_number().over(w).cast("bigint"))
    if count_col:
        out = out.withColumn(count_col, F.count(F.lit(1)).over(Window.partitionBy(*group)))
    return out
