"""C5 log-compressed ratings, C6 recency weights, C20 threshold labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions import compressed, decay, threshold
from cadenza.operators.positions import rank_within
from cadenza.operators.slices import Slices, cuttable, measure, rank_sliced


def compress_rating(df: DataFrame, col: str = "count", out: str = "rating") -> DataFrame:
    """``out`` = log1p(1 + col): compresses play counts (or recency weights)."""
    return df.withColumn(out, compressed(col))


def recency_weight(df: DataFrame, user_col: str = "user_id", time_col: str = "timestamp",
                   item_col: str = "recording_mbid", per_item: bool = False,
                   tie_cols: Sequence[str] | None = None, out: str = "recency",
                   position: str | None = None, slices: Slices | None = None) -> DataFrame:
    """``out`` = exp(1 - i) where i numbers a user's events newest first (1.0 for
    the newest, e^-1 for the next, ...). One value per event; ``position`` names
    an optional column for i itself (the weight is 0 in doubles from i = 747 on).

    ``per_item=True`` numbers events per (user, item) instead. Ties on the time
    are broken by ``tie_cols`` (default: the other columns in frame order).
    The numbering is skew-safe: by ``slices`` - those of ``event_slices`` serve any part
    of the events they were measured on, newest first as well as oldest first - or by
    slices measured when this is called. After a split by the same slices a user's
    rows lie together already and are only sorted anew.
    """
    group = [user_col, item_col] if per_item else [user_col]
    if tie_cols is None:
        tie_cols = [c for c in df.columns if c not in (*group, time_col)]
    order = [F.col(time_col).desc_nulls_last()] + [F.col(c).asc_nulls_first() for c in tie_cols]
    if slices is None and cuttable(df.schema[time_col].dataType):
        slices = measure(df, group, time_col)
    elif slices is not None and (slices.group, slices.by) != (group, time_col):
        raise ValueError("slices were measured for another group or time column")
    ranked = (rank_sliced(df, slices, order, "_cz_index", descending=True) if slices
              else rank_within(df, group, order, "_cz_index"))
    extra = [F.col("_cz_index").alias(position)] if position else []
    return ranked.select(*[F.col(c) for c in df.columns], *extra, decay("_cz_index").alias(out))


def threshold_label(df: DataFrame, col: str = "rating", t: float = 4.0,
                    out: str = "label") -> DataFrame:
    """``out`` = 1.0 when ``col >= t`` else 0.0."""
    return df.withColumn(out, threshold(col, t))
