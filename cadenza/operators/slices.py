"""Row numbers per group on slices that a quantile summary cuts beforehand.

``row_number() OVER (PARTITION BY user ORDER BY time)`` sorts a whole user in one
task. Here a group is numbered in slices of its order:

1. ``measure`` makes one narrow pass over the group columns: groups are hashed into
   buckets and the rows of each are counted. A bucket with more rows than a slice
   should hold is cut into as many slices as it needs, at the quantiles of the leading
   order column: mergeable summaries (``percentile_approx``, combined map-side) of
   these buckets' rows. Every other bucket is one slice. Counts and summaries have a
   fixed size, so they do not grow with the table.
2. The slice number is a column: how many cuts of the bucket lie below the row's
   value. One plain hash shuffle on (group, slice) then feeds a window, for groups of
   any size. No row is stored, and whole rows are evaluated once.
3. Where buckets were cut, the rows of a group's earlier slices are counted by a
   second narrow aggregate over the cut buckets and joined back on (group, slice), the
   keys the window is partitioned by already.

A value that several quantiles in a row share (a run of equal times, for instance
null times, or copies of a row) is a slice by itself and is numbered by the range
layout of ``positions``, which cuts runs of any content.

Cuts only balance the work: any cuts give the same numbers, so the slices measured on
a table serve every part of it and both directions of its order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.operators.positions import pin, rank_within

SLICE_ROWS = 1 << 20    # smaller buckets are not cut
MAX_BUCKETS = 16_384    # counts and summaries: at most this many, whatever the cluster
BUCKETS_A_PARTITION = 8 # so a slice is at most about a quarter of a mean shuffle partition
QUANTILES = 64          # of a bucket: a slice of it is at most about 1/64 of its rows
_BUCKET, _CUTS, _RUNS = "_cz_bucket", "_cz_cuts", "_cz_runs"
_SLICE, _RUN = "_cz_slice", "_cz_run"


@dataclass
class Slices:
    """Cut buckets of groups: ``table`` has one row per cut bucket (None: no bucket
    was cut), with its cuts in order and those of them that are runs."""
    group: list[str]
    by: str
    buckets: int
    table: DataFrame | None


def cuttable(kind: T.DataType) -> bool:
    """Whether a column of this type can be summarised by quantiles."""
    return isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))


def _bucket(group: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*group), F.lit(buckets)).cast("int")


def measure(df: DataFrame, group: Sequence[str], by: str, slice_rows: int = SLICE_ROWS) -> Slices:
    """Slices of ``df`` for groups ordered by ``by``; reads only these columns.

    Runs one job, the counts; a second one, the quantiles, only over buckets to cut.
    The slices of a table serve any part of it, so they can be measured on the raw
    rows before joins and filters.
    """
    group = list(group)
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(1, min(MAX_BUCKETS, BUCKETS_A_PARTITION * partitions))
    shares = [k / QUANTILES for k in range(1, QUANTILES)]
    bucket = _bucket(group, buckets)
    # at most MAX_BUCKETS rows
    counts = df.groupBy(bucket.alias(_BUCKET)).agg(F.count(F.lit(1)).alias("n")).collect()
    limit = max(slice_rows, 2 * sum(r["n"] for r in counts) // buckets)
    large = [r[_BUCKET] for r in counts if r["n"] > limit]
    if not large:
        return Slices(group, by, buckets, None)
    summary = df.withColumn(_BUCKET, bucket).where(F.col(_BUCKET).isin(large)).groupBy(_BUCKET).agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx(by, shares, 4 * QUANTILES).alias("quantiles"))
    # every (QUANTILES / parts)-th quantile; the quantiles are those of the non-null rows
    summary = summary.withColumn("parts", F.least(F.ceil(F.col("n") / F.lit(limit)), F.lit(QUANTILES)).cast("int"))
    parts = F.col("parts")
    chosen = F.transform(F.sequence(F.lit(1), parts - 1),
                         lambda k: F.get("quantiles", F.floor(k * QUANTILES / parts).cast("int") - 1))
    cuts = summary.select(_BUCKET, "parts", F.coalesce("quantiles", F.array()).alias("quantiles"),
                          F.when(parts > 1, F.filter(chosen, F.isnotnull)).alias("chosen"))
    # a value that fills the quantiles between two cuts is a run
    step = F.floor(F.lit(QUANTILES) / parts).cast("int")
    runs = F.array_distinct(F.filter("chosen", lambda c: F.size(F.filter(
        "quantiles", lambda q: q == c)) >= F.greatest(step, F.lit(2))))
    return Slices(group, by, buckets, pin(cuts.select(
        _BUCKET, F.array_sort(F.array_distinct("chosen")).alias(_CUTS), runs.alias(_RUNS))))


def _sliced(df: DataFrame, slices: Slices) -> DataFrame:
    """``df`` with its slice number, and whether that slice is a run of one value.

    Slices of a bucket with cuts c1 < c2 < ...: null values (-1), below or at c1
    (0), and so on, doubled, with the odd numbers for the runs. Other buckets: 0.
    """
    by = F.col(slices.by)
    cuts = slices.table.withColumnRenamed(_BUCKET, "_cz_own")
    # at most MAX_BUCKETS rows of at most QUANTILES values
    joined = df.withColumn(_BUCKET, _bucket(slices.group, slices.buckets)).join(
        F.broadcast(cuts), F.col(_BUCKET) == F.col("_cz_own"), "left")
    below = F.size(F.filter(_CUTS, lambda c: c < by))
    run = F.coalesce(F.array_contains(_RUNS, by), F.lit(False))
    number = (F.when(F.col(_CUTS).isNull(), 0).when(by.isNull(), -1)
              .otherwise(2 * below + F.when(run, 1).otherwise(0)))
    is_run = F.col(_CUTS).isNotNull() & (run | by.isNull())
    return joined.withColumns({_SLICE: number, _RUN: is_run})


def rank_sliced(df: DataFrame, slices: Slices, order: Sequence[Column], rank_col: str,
                count_col: str | None = None, descending: bool = False) -> DataFrame:
    """Add ``rank_col`` = row_number() over (partition by group order by order), 1-based,
    and optionally ``count_col`` = rows in the row's group; null keys form a group.

    ``order`` starts with ``slices.by``: ascending with nulls first, or with
    ``descending`` descending with nulls last.
    """
    group, names = slices.group, df.columns
    extra = [count_col] if count_col else []
    if slices.table is None:
        w = Window.partitionBy(*group)
        out = df.withColumn(rank_col, F.row_number().over(w.orderBy(*order)).cast("bigint"))
        return out.withColumn(count_col, F.count(F.lit(1)).over(w)) if count_col else out
    marked = _sliced(df, slices).select(*names, _SLICE, _RUN)
    keys = [*group, _SLICE]
    whole = marked.where(~F.col(_RUN)).drop(_RUN)
    own = Window.partitionBy(*keys)
    whole = whole.withColumn("_cz_own", F.row_number().over(own.orderBy(*order)).cast("bigint"))
    whole = whole.withColumn("_cz_size", F.count(F.lit(1)).over(own))
    runs = rank_within(marked.where(F.col(_RUN)).drop(_RUN), keys, list(order), "_cz_own", "_cz_size")
    ranked = whole.unionByName(runs)
    # the groups of cut buckets only
    sizes = (_sliced(df.select(*dict.fromkeys([*group, slices.by])), slices).where(F.col(_CUTS).isNotNull())
             .groupBy(*keys).agg(F.count(F.lit(1)).alias("_cz_n")))
    by_slice = Window.partitionBy(*group).orderBy(F.col(_SLICE).desc() if descending else F.col(_SLICE))
    earlier = F.coalesce(F.sum("_cz_n").over(
        by_slice.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(
        *[F.col(k).alias(f"_cz_k{i}") for i, k in enumerate(keys)], earlier.alias("_cz_before"),
        F.sum("_cz_n").over(Window.partitionBy(*group)).alias("_cz_total"))
    same = None
    for i, k in enumerate(keys):
        equal = ranked[k].eqNullSafe(sizes[f"_cz_k{i}"])
        same = equal if same is None else same & equal
    joined = ranked.join(sizes, same, "left")
    place = F.col("_cz_own") + F.coalesce("_cz_before", F.lit(0))
    count = F.coalesce("_cz_total", "_cz_size")
    return joined.select(*names, place.alias(rank_col), *[count.alias(c) for c in extra])
