"""Mean average precision of per-user predicted lists against per-user truth lists.

Both lists are the top n rows per user (predictions by score, truth by rating).
For each user with predictions: AP = sum over hits of (hits so far / rank) divided
by the length of the user's truth list, 0 without hits; MAP is the mean over the
users that have predictions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.operators.topn import two_lists


def list_average_precision(predictions: DataFrame, truth: DataFrame, n: int = 100,
                           user_col: str = "user_id", item_col: str = "recording_mbid_index",
                           pred_score: str = "prediction", truth_score: str = "rating") -> DataFrame:
    """Per user with predictions: ``ap``.

    Both lists are one tagged table laid out by user (``two_lists``); whether a
    predicted item is among the user's true ones, its number among the hits and the
    length of the truth are windows on that layout. A null item is never a hit.
    """
    lists = two_lists(predictions, truth, n, user_col, item_col, pred_score, truth_score)
    of_user = Window.partitionBy(user_col)
    marked = lists.select(
        user_col, "is_true", "rank",
        (F.max("is_true").over(Window.partitionBy(user_col, item_col))
         & F.col(item_col).isNotNull()).alias("_cz_is_hit"),
        F.sum(F.col("is_true").cast("bigint")).over(of_user).alias("_cz_tlen"))
    hits = marked.where(~F.col("is_true")).withColumn("_cz_hit", F.sum(
        F.col("_cz_is_hit").cast("bigint")).over(of_user.orderBy("rank")))
    gain = F.when(F.col("_cz_is_hit"), F.col("_cz_hit") / F.col("rank")).otherwise(F.lit(0.0))
    return hits.groupBy(user_col).agg(
        F.when(F.max("_cz_tlen") > 0, F.sum(gain) / F.max("_cz_tlen")).otherwise(F.lit(0.0)).alias("ap"))


def list_map(predictions: DataFrame, truth: DataFrame, n: int = 100, **kwargs) -> DataFrame:
    """One row: ``users`` with predictions and their mean AP ``list_map``."""
    per_user = list_average_precision(predictions, truth, n, **kwargs)
    return per_user.agg(F.count(F.lit(1)).alias("users"), F.avg("ap").alias("list_map"))
