"""Area under the ROC curve of scores against 0/1 labels.

``exact_auc`` is the rank-sum (Mann-Whitney) form with ties counted half:

    AUC = sum over distinct scores s of pos(s) * (neg(< s) + neg(s) / 2) / (P * N)

Scores are first aggregated to one row per distinct score (map-side partial
counts). ``neg(< s)`` is a two-level prefix sum: a running sum inside each of several
score ranges plus one offset per range. Ranges are cut at approximate quantiles of the
distinct scores and their number follows the number of scores, so a range holds about
``RANGE_SCORES`` of them however many there are. Every term is a multiple
of 1/2, so the sum is exact in double precision up to 2^52 pairs.

``evaluator_auc`` is MLlib's ``BinaryClassificationEvaluator`` (binned, so
approximate on many distinct scores), kept for parity with that evaluator.
"""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.operators.positions import pin

RANGE_SCORES = 1 << 18  # distinct scores that one task sums up, give or take the summary's error


def _cuts_below(value: Column, cuts: list[float]) -> Column:
    """How many of the sorted ``cuts`` lie below ``value``, by halving."""
    if not cuts:
        return F.lit(0)
    table = F.array(*map(F.lit, cuts))
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))))
    # at + step cuts lie below if the last of them does
    return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(
        F.get(table, at + step - 1) < value, step).otherwise(0))


def _before_in_ranges(placed: DataFrame) -> DataFrame:
    """``placed`` (scores with their range ``_cz_b``) with ``before_neg``: the negatives
    below a score, inside its range and in the ranges before."""
    earlier = Window.orderBy("_cz_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_cz_b").agg(F.sum("neg").alias("_cz_n")).select(
        "_cz_b", F.coalesce(F.sum("_cz_n").over(earlier), F.lit(0)).alias("_cz_off"))
    inside = (Window.partitionBy("_cz_b").orderBy("_cz_s")
              .rowsBetween(Window.unboundedPreceding, -1))
    running = placed.withColumn("_cz_in", F.coalesce(F.sum("neg").over(inside), F.lit(0)))
    # one row per range: one in RANGE_SCORES of the distinct scores
    return running.join(F.broadcast(offsets), "_cz_b").withColumn(
        "before_neg", F.col("_cz_off") + F.col("_cz_in"))


def exact_auc(df: DataFrame, score_col: str = "prediction", label_col: str = "label") -> DataFrame:
    """One row: ``auc`` (null when only one class is present), ``positives``,
    ``negatives``. Label 1.0 is positive, any other value negative."""
    scored = df.where(F.col(score_col).isNotNull() & F.col(label_col).isNotNull())
    is_pos = F.col(label_col) == F.lit(1.0)
    per_score = pin(scored.groupBy(F.col(score_col).cast("double").alias("_cz_s")).agg(
        F.sum(F.when(is_pos, 1).otherwise(0)).cast("bigint").alias("pos"),
        F.sum(F.when(is_pos, 0).otherwise(1)).cast("bigint").alias("neg"),
    ))
    scores = per_score.count()
    ranges = -(-scores // RANGE_SCORES)
    cuts = []
    if ranges > 1:
        shares = [k / ranges for k in range(1, ranges)]
        cuts = sorted(set(per_score.agg(F.percentile_approx("_cz_s", shares, 20 * ranges)).first()[0]))
    before = Window.orderBy("_cz_s").rowsBetween(Window.unboundedPreceding, -1)
    if cuts:
        ordered = _before_in_ranges(per_score.withColumn("_cz_b", _cuts_below(F.col("_cz_s"), cuts)))
    else:  # one range: at most RANGE_SCORES rows
        ordered = per_score.withColumn("before_neg", F.coalesce(F.sum("neg").over(before), F.lit(0)))
    totals = ordered.agg(
        F.sum(F.col("pos") * (F.col("before_neg") + F.col("neg") * F.lit(0.5))).alias("_cz_u"),
        F.sum("pos").cast("bigint").alias("positives"),
        F.sum("neg").cast("bigint").alias("negatives"),
    )
    pairs = F.col("positives").cast("double") * F.col("negatives").cast("double")
    return totals.select(
        F.when((F.col("positives") > 0) & (F.col("negatives") > 0), F.col("_cz_u") / pairs)
         .alias("auc"),
        F.coalesce(F.col("positives"), F.lit(0)).cast("bigint").alias("positives"),
        F.coalesce(F.col("negatives"), F.lit(0)).cast("bigint").alias("negatives"),
    )


def evaluator_auc(df: DataFrame, score_col: str = "prediction", label_col: str = "label") -> float:
    """MLlib's binned areaUnderROC (returns a driver-side float)."""
    ev = BinaryClassificationEvaluator(rawPredictionCol=score_col, labelCol=label_col,
                                       metricName="areaUnderROC")
    return ev.evaluate(df)
