"""C4: damped popularity - the top-k items by total plays / (listeners + beta)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def item_popularity(counts: DataFrame, beta: float = 100000, item_col: str = "recording_mbid",
                    user_col: str = "user_id", count_col: str = "count") -> DataFrame:
    """Per item: ``recording_count`` = sum of counts, ``user_count`` = non-null
    users (distinct, since counts has one row per pair) and ``average_count`` =
    recording_count / (user_count + beta)."""
    per_item = counts.groupBy(item_col).agg(
        F.sum(count_col).cast("bigint").alias("recording_count"),
        F.count(user_col).alias("user_count"),
    )
    return per_item.withColumn(
        "average_count",
        F.col("recording_count").cast("double") / (F.col("user_count") + F.lit(beta)),
    )


def popularity_topk(counts: DataFrame, beta: float = 100000, k: int = 100,
                    item_col: str = "recording_mbid", user_col: str = "user_id",
                    count_col: str = "count") -> DataFrame:
    """The ``k`` items with the highest ``average_count`` (ties by item id), with
    an explicit 1-based ``position`` so the order survives storage.

    Every task keeps its k best items (a bounded heap), and only these meet, so no
    table of all items is sorted or stored. The position is numbered over the k rows
    of the list; k is the length of a ranked list, whatever the number of items.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    ranked_by = [F.col("average_count").desc_nulls_last(), F.col(item_col).asc_nulls_first()]
    scored = item_popularity(counts, beta, item_col, user_col, count_col)
    best = scored.orderBy(*ranked_by).limit(k)
    place = F.row_number().over(Window.orderBy(*ranked_by))  # over k rows
    return best.withColumn("position", place.cast("bigint"))
