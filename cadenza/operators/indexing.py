"""Dense 0-based item index in sort order, fitted on one table, applied to others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators.positions import global_index, pin


def fit_item_index(df: DataFrame, item_col: str = "recording_mbid",
                   index_col: str = "recording_mbid_index") -> DataFrame:
    """Distinct items of ``df`` numbered 0..n-1 in ascending order (null first),
    i.e. ``dense_rank() over (order by item) - 1`` without a single-task window:
    the distinct items are range-partitioned and offset per partition."""
    items = df.select(item_col).distinct()
    return global_index(items, [F.col(item_col).asc_nulls_first()], index_col)


def apply_item_index(df: DataFrame, index: DataFrame, item_col: str = "recording_mbid",
                     index_col: str = "recording_mbid_index", how: str = "left",
                     keep_key: bool = False) -> DataFrame:
    """Join ``index`` on the item and (by default) drop the string key.

    With ``how="left"`` items missing from the index keep their rows with a null
    index; drop those before training a model on it.
    """
    joined = df.join(index.select(item_col, index_col), on=item_col, how=how)
    return joined if keep_key else joined.drop(item_col)


def extend_item_index(index: DataFrame, held_out: DataFrame, item_col: str = "recording_mbid",
                      index_col: str = "recording_mbid_index") -> DataFrame:
    """``index`` plus the items of ``held_out`` it lacks, numbered on in sort order.

    Held-out rows of items unseen in training then keep an identity of their own:
    they stay in the truth of an evaluation, and models score them as unknown.
    """
    known = index.select(item_col, index_col)
    unseen = pin(held_out.select(item_col).distinct().join(
        known.withColumnRenamed(item_col, "_cz_known"),
        F.col(item_col).eqNullSafe(F.col("_cz_known")), "left_anti"))
    if unseen.isEmpty():
        return known
    start = known.agg(F.coalesce(F.max(index_col) + 1, F.lit(0))).first()[0]
    added = global_index(unseen, [F.col(item_col).asc_nulls_first()], index_col)
    return known.union(added.select(item_col, (F.col(index_col) + F.lit(start)).alias(index_col)))
