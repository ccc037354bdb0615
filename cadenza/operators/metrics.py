"""C14-C17: ranking metrics of one shared ranked list against each user's events.

Definitions kept from the evaluation being rebuilt:

* ``actual`` is every held-out event of the user, duplicates included; ``n`` is
  its length. Membership ("is the ranked item among the user's items") ignores
  duplicates.
* AP = sum over hits of (hits so far / position) / n, over the whole list.
* P@k = hits in the first k positions / k (also for lists shorter than k).
* NDCG@k = DCG of the hits in the first k positions / IDCG, where IDCG sums
  1/log2(i+1) for i = 1..n - over all n events, not min(n, k).
* A user without hits scores 0 and still counts in the means.

Everything is joins and aggregates: the ranked list (bounded - it is a top-k
list) is joined to the events, hits are numbered within a user (at most
list-length rows per user), and IDCG is an expression of n (``ideal_gain``). Only the
metrics asked for are computed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions import discount

METRICS = ("ap", "pk", "ndcg")

EXACT_TERMS = 128    # of the ideal sum; beyond, an integral with correction terms
SERIES_TERMS = 160   # of the exponential integral; enough for any 64-bit n
# sum of the first n terms 1 / log2(i + 1), n = 0..EXACT_TERMS
_PREFIX = [math.fsum(1 / math.log2(i + 1) for i in range(1, n + 1)) for n in range(EXACT_TERMS + 1)]
# 1 / (k k!) for k = SERIES_TERMS..1
_SERIES = [1 / (k * math.factorial(k)) for k in range(SERIES_TERMS, 0, -1)]


def _antiderivative(x: Column | float) -> Column:
    """Of f = 1 / ln x with the Euler-Maclaurin terms of one end: li(x) + f/2 + f'/12 - f'''/720.

    li(x) = gamma + ln ln x + sum (ln x)^k / (k k!), without gamma here.
    """
    x = F.lit(float(x)) if isinstance(x, (int, float)) else x
    y = F.log(x)
    series = F.aggregate(F.array(*map(F.lit, _SERIES)), F.lit(0.0), lambda acc, c: (acc + c) * y)
    third = -(2 / (y * y) + 6 / (y * y * y) + 6 / (y * y * y * y)) / (x * x * x)
    return F.log(y) + series + F.lit(0.5) / y - 1 / (x * y * y) / 12 - third / 720


def ideal_gain(n: Column) -> Column:
    """sum_{i=1..n} 1/log2(i + 1) as an expression of ``n``; null for null, 0 below 1.

    A table up to ``EXACT_TERMS``, beyond it the integral of 1/ln x with
    Euler-Maclaurin terms, which is the sum to the precision of doubles: the cost
    does not follow n.
    """
    n = n.cast("bigint")
    table = F.array(*map(F.lit, _PREFIX))
    tail = F.lit(math.log(2)) * (_antiderivative((n + 1).cast("double")) - _antiderivative(EXACT_TERMS + 1))
    return (F.when(n <= 0, 0.0).when(n <= EXACT_TERMS, F.get(table, n.cast("int")))
            .when(n.isNotNull(), F.lit(_PREFIX[-1]) + tail))


def ideal_dcg(n_values: DataFrame, n_col: str = "n_actual", out: str = "idcg") -> DataFrame:
    """For each distinct ``n`` >= 1 in ``n_values``: sum_{i=1..n} 1/log2(i + 1)."""
    needed = n_values.select(F.col(n_col).cast("bigint").alias(n_col)).where(F.col(n_col) >= 1)
    return needed.distinct().select(n_col, ideal_gain(F.col(n_col)).alias(out))


def ranking_metrics(actual: DataFrame, ranked: DataFrame, k: int = 10,
                    user_col: str = "user_id", item_col: str = "recording_mbid",
                    position_col: str = "position", dedupe: bool = False,
                    truncate_ideal: bool = False,
                    metrics: Sequence[str] = METRICS, count_col: str | None = None) -> DataFrame:
    """Per user of ``actual`` the chosen ``metrics``: ``ap``, ``pk`` (precision@k)
    and ``ndcg`` (NDCG@k).

    ``actual``: one row per held-out event (user, item), or one row per pair with its
    number of events in ``count_col``. ``ranked``: the shared
    list, one row per item with its 1-based ``position`` (e.g. ``popularity_topk``).
    The defaults keep the definitions above; ``dedupe=True`` counts each of a
    user's items once in n, ``truncate_ideal=True`` sums IDCG over min(n, k)
    (the usual textbook forms).
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    events = actual.select(user_col, item_col, *[count_col] if count_col and not dedupe else [])
    if dedupe:
        events = events.distinct()
    size = F.sum(count_col) if count_col and not dedupe else F.count(F.lit(1))
    n_actual = events.groupBy(user_col).agg(size.cast("bigint").alias("n_actual"))

    listed = ranked.select(item_col, F.col(position_col).cast("bigint").alias("_cz_pos"))
    hits = (events.join(listed, item_col, "inner")
            .select(user_col, "_cz_pos").distinct())
    by_pos = Window.partitionBy(user_col).orderBy("_cz_pos")
    hits = hits.withColumn("_cz_hit", F.row_number().over(by_pos))
    in_k = F.col("_cz_pos") <= F.lit(k)
    per_user = hits.groupBy(user_col).agg(
        F.sum(F.col("_cz_hit") / F.col("_cz_pos")).alias("_cz_ap"),
        F.sum(F.when(in_k, F.lit(1)).otherwise(F.lit(0))).alias("_cz_hk"),
        F.sum(F.when(in_k, discount("_cz_pos")).otherwise(F.lit(0.0))).alias("_cz_dcg"),
    )
    out = n_actual.join(per_user, user_col, "left")
    columns = {
        "ap": F.coalesce(F.col("_cz_ap"), F.lit(0.0)) / F.col("n_actual"),
        "pk": F.coalesce(F.col("_cz_hk"), F.lit(0)).cast("double") / F.lit(float(k)),
    }
    if "ndcg" in metrics:
        n_ideal = F.least(F.col("n_actual"), F.lit(k)) if truncate_ideal else F.col("n_actual")
        out = out.withColumn("_cz_idcg", ideal_gain(n_ideal))
        columns["ndcg"] = F.when(F.col("_cz_idcg") > 0, F.coalesce(
            F.col("_cz_dcg"), F.lit(0.0)) / F.col("_cz_idcg")).otherwise(F.lit(0.0))
    return out.select(user_col, *[columns[m].alias(m) for m in metrics])


def ranking_summary(per_user: DataFrame) -> DataFrame:
    """C17: one row with the means over all users: mean_map, mean_pk, mean_ndcg."""
    return per_user.agg(
        F.avg("ap").alias("mean_map"),
        F.avg("pk").alias("mean_pk"),
        F.avg("ndcg").alias("mean_ndcg"),
    )
