"""Interaction counts per (user, item)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def interaction_counts(df: DataFrame, user_col: str | Sequence[str] = "user_id",
                       item_col: str = "recording_mbid", count_col: str = "count") -> DataFrame:
    """One row per (user, item) with the number of events; several columns may stand
    for the user.

    A hash aggregate with map-side partial counts: a hot user or item is folded
    per task before the shuffle, so no task receives its raw events.
    """
    users = [user_col] if isinstance(user_col, str) else list(user_col)
    return df.groupBy(*users, item_col).agg(F.count(F.lit(1)).alias(count_col))
