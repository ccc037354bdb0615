"""The n best-scored items of every user."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SPREAD = 64  # slices of a user that are cut to n rows each before the final cut


def top_n_per_user(df: DataFrame, score_col: str, n: int = 100, user_col: str = "user_id",
                   item_col: str = "recording_mbid_index", rank_col: str = "rank",
                   tie_cols: Sequence[str] | None = None) -> DataFrame:
    """Rows ranked 1..n per user by ``score_col`` descending (ties by item).

    Cut in two stages: the n best rows of each of ``_SPREAD`` slices of a user,
    then the n best of those. A hot user is ranked by many tasks, and the last one
    gets at most ``_SPREAD`` * n of its rows, however many tasks hold them. Where
    Spark plans a WindowGroupLimit (``row_number() <= n`` up to its own limit on
    n), each stage is also cut inside the map tasks before its shuffle.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    ties = list(tie_cols) if tie_cols is not None else [item_col]
    order = [F.col(score_col).desc_nulls_last()] + [F.col(c).asc_nulls_first() for c in ties]
    w = Window.partitionBy(user_col).orderBy(*order)
    best = best_of_slices(df, [user_col], order, item_col, n)
    ranked = best.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)
    return ranked.withColumn(rank_col, F.col(rank_col).cast("bigint"))


def best_of_slices(df: DataFrame, group: Sequence[str], order: Sequence[Column], item_col: str,
                   n: int) -> DataFrame:
    """The first ``n`` rows in ``order`` of each of ``_SPREAD`` slices of a group."""
    slices = Window.partitionBy(*group, "_cz_slice").orderBy(*order)
    return (df.withColumn("_cz_slice", F.pmod(F.xxhash64(item_col), F.lit(_SPREAD)))
            .withColumn("_cz_rank", F.row_number().over(slices))
            .where(F.col("_cz_rank") <= n).drop("_cz_rank", "_cz_slice"))


def two_lists(predictions: DataFrame, truth: DataFrame, n: int, user_col: str, item_col: str,
              pred_score: str, truth_score: str) -> DataFrame:
    """The n best predictions and the n best true items of every user in one table:
    ``user_col``, ``item_col``, ``is_true``, ``rank`` (1..n per user and list).

    Both lists are tagged rows of one union, so they share one shuffle by slices of a
    user and one by user; a caller's windows and aggregates by user need no other.
    Where ``truth`` is the same table as ``predictions``, it is read once.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    score = "_cz_score"
    if truth is predictions:
        kind = (predictions.select(F.col(pred_score)).union(truth.select(F.col(truth_score)))).schema[0].dataType
        lists = F.array(*(F.struct(F.lit(is_true).alias("is_true"), F.col(c).cast(kind).alias(score))
                          for is_true, c in ((False, pred_score), (True, truth_score))))
        both = predictions.select(user_col, item_col, F.inline(lists))
    else:
        both = predictions.select(user_col, item_col, F.lit(False).alias("is_true"),
                                  F.col(pred_score).alias(score)).union(
            truth.select(user_col, item_col, F.lit(True), truth_score))
    order = [F.col(score).desc_nulls_last(), F.col(item_col).asc_nulls_first()]
    best = best_of_slices(both, [user_col, "is_true"], order, item_col, n)
    w = Window.partitionBy(user_col, "is_true").orderBy(*order)
    ranked = best.repartition(user_col).withColumn("rank", F.row_number().over(w).cast("bigint"))
    return ranked.where(F.col("rank") <= n).drop(score)
