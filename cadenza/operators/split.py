"""Per-user temporal split - the first int(n * ratio) events of a user train."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators.positions import rank_within
from cadenza.operators.slices import Slices, cuttable, measure, rank_sliced

_RN = "_cz_rn"
_N = "_cz_n"


def _cutoff(n: F.Column, ratio: float) -> F.Column:
    # int(n * ratio): the double product truncated toward zero (n=5 -> 4, n=1 -> 0)
    return (n * F.lit(float(ratio))).cast("long")


def temporal_split(df: DataFrame, ratio: float = 0.8, user_col: str = "user_id",
                   time_col: str = "timestamp", tie_cols: Sequence[str] | None = None,
                   flag_col: str = "is_train", slices: Slices | None = None) -> DataFrame:
    """Flag each event as train (``flag_col`` true) or validation.

    Events of a user are numbered by ``time_col`` ascending (nulls first), ties
    broken by ``tie_cols`` (default: all other columns in frame order), and the
    first ``int(n * ratio)`` of the user's ``n`` events are train. Rows with a null
    user drop out, as they do in an equi-join with per-user split points.

    The numbering is skew-safe: a user with a third of all events is spread over many
    tasks by the slices of ``event_slices`` (measured when this is called, unless
    given). A time column without quantiles (a string, say) is numbered by the stored
    range layout of ``rank_within`` instead. ``tie_cols`` must have orderable types.
    """
    if not 0.0 <= ratio <= 1.0:
        raise ValueError("ratio must be in [0, 1]")
    if tie_cols is None:
        tie_cols = [c for c in df.columns if c not in (user_col, time_col)]
    order = [F.col(time_col).asc_nulls_first()] + [F.col(c).asc_nulls_first() for c in tie_cols]
    base = df.where(F.col(user_col).isNotNull())
    if slices is None:
        slices = event_slices(df, user_col, time_col)
    ranked = (rank_sliced(base, slices, order, _RN, _N) if slices
              else rank_within(base, [user_col], order, _RN, _N))
    return ranked.select(
        *[F.col(c) for c in df.columns],
        (F.col(_RN) <= _cutoff(F.col(_N), ratio)).alias(flag_col),
    )


def event_slices(df: DataFrame, user_col: str = "user_id", time_col: str = "timestamp") -> Slices | None:
    """Slices of the users' events in time; None where the time has no quantiles.

    They serve ``temporal_split`` of ``df`` or of what is left of it after joins, and
    ``recency_weight`` of any part.
    """
    if not cuttable(df.schema[time_col].dataType):
        return None
    return measure(df.where(F.col(user_col).isNotNull()), [user_col], time_col)


def train_part(split: DataFrame, flag_col: str = "is_train") -> DataFrame:
    return split.where(F.col(flag_col)).drop(flag_col)


def validation_part(split: DataFrame, flag_col: str = "is_train") -> DataFrame:
    return split.where(~F.col(flag_col)).drop(flag_col)


def split_points(df: DataFrame, ratio: float = 0.8, user_col: str = "user_id") -> DataFrame:
    """Per user: event count ``n`` and ``split_point`` = int(n * ratio)."""
    counts = (df.where(F.col(user_col).isNotNull())
              .groupBy(user_col).agg(F.count(F.lit(1)).alias("n")))
    return counts.withColumn("split_point", _cutoff(F.col("n"), ratio))
