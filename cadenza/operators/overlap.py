"""Overlap of the top-n true items and top-n predicted items of each user.

Both lists are ranked per user on one layout; rows are paired by rank, which leaves
the first rows of both up to the shorter length, and the score is |distinct shared items| / |paired true items|. Users
with no pair drop out of the mean.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators.topn import two_lists


def overlap_at_n(truth: DataFrame, predictions: DataFrame, n: int = 100,
                 user_col: str = "user_id", item_col: str = "recording_mbid_index",
                 truth_score: str = "rating", pred_score: str = "prediction",
                 percent: bool = False) -> DataFrame:
    """Per user: ``common_count``, ``true_count`` and ``common_percentage``
    (a fraction, or x100 with ``percent=True``). Lists hold at most n items per
    user, so the collected arrays are bounded by n."""
    lists = two_lists(predictions, truth, n, user_col, item_col, pred_score, truth_score)
    # items are wrapped, so a null item stays in its list and counts
    entry = F.struct("rank", F.array(item_col).alias("item"))
    both = lists.groupBy(user_col).agg(
        F.array_sort(F.collect_list(F.when(F.col("is_true"), entry))).alias("_cz_t"),
        F.array_sort(F.collect_list(F.when(~F.col("is_true"), entry))).alias("_cz_p"))
    paired = F.least(F.size("_cz_t"), F.size("_cz_p"))
    per_user = both.where(paired > 0).select(
        user_col,
        F.size(F.array_intersect(F.slice("_cz_t", F.lit(1), paired)["item"],
                                 F.slice("_cz_p", F.lit(1), paired)["item"]))
         .cast("bigint").alias("common_count"),
        paired.cast("bigint").alias("true_count"),
    )
    scale = F.lit(100.0 if percent else 1.0)
    return per_user.withColumn(
        "common_percentage",
        F.col("common_count") / F.col("true_count") * scale)


def overlap_mean(per_user: DataFrame) -> DataFrame:
    """One row: the mean ``common_percentage`` over users (``overlap``)."""
    return per_user.agg(F.avg("common_percentage").alias("overlap"))
