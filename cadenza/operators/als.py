"""Matrix factorisation with MLlib's alternating least squares.

MLlib ALS is already a distributed, block-partitioned trainer (factor blocks
shuffled each round); this module pins the parameters used by the evaluations,
the seed and the number of factor blocks, and checkpoints factor lineage into
the session's checkpoint folder so long fits survive lost executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from cadenza.operators.positions import global_index, pin
from cadenza.session import ensure_checkpoint_dir

# Fixed parameter sets of the two evaluations.
COUNTS_PRESET = {"rank": 20, "reg": 0.5, "alpha": 5.0, "max_iter": 10}
RECENCY_PRESET = {"rank": 10, "reg": 0.05, "alpha": 40.0, "max_iter": 10}

# Factor blocks. The layout of the user blocks decides MLlib's factor initialisation, so
# their number is part of the model like the seed and never follows the cluster size.
# Raise it for tables whose blocks would not fit a task (it changes the model).
NUM_BLOCKS = 16

# Item blocks are layout only: the fit begins by solving for the items, so their initial
# factors are never read. Every round sends each user's factors to all item blocks it has
# ratings in, which is most of what a fit shuffles, so there are no more of them than
# their size asks for. The number follows the ratings, not the cluster. The task that
# builds a block holds some 40 bytes a rating of it at once, which nothing can spill:
# up to 1.6 GB for the largest block.
MIN_ITEM_BLOCKS = 3
ITEM_BLOCK_RATINGS = 40_000_000


def item_blocks(ratings: int, num_blocks: int = NUM_BLOCKS) -> int:
    """Item blocks for so many ratings: at least ``MIN_ITEM_BLOCKS``, at most ``num_blocks``."""
    return min(num_blocks, max(MIN_ITEM_BLOCKS, -(-ratings // ITEM_BLOCK_RATINGS)))

_USER = "_cz_user_index"
_ITEM = "_cz_item_index"


@dataclass
class RatingModel:
    """Factors on dense ids, with the maps from the caller's ids."""
    model: ALSModel
    users: DataFrame  # user_col, _cz_user_index (int)
    items: DataFrame  # item_col, _cz_item_index (int)
    user_col: str
    item_col: str
    reg: float = 0.0
    nonnegative: bool = True
    implicit: bool = False

    def user_factors(self) -> DataFrame:
        """``user_col``, ``features``."""
        return self.users.join(self.model.userFactors.withColumnRenamed("id", _USER), _USER).drop(_USER)

    def item_factors(self) -> DataFrame:
        """``item_col``, ``features``."""
        return self.items.join(self.model.itemFactors.withColumnRenamed("id", _ITEM), _ITEM).drop(_ITEM)


def _dense(data: DataFrame, col: str, out: str) -> DataFrame:
    """Distinct values of ``col`` with dense 32-bit ids in sort order."""
    ids = global_index(data.select(col).distinct(), [F.col(col).asc()], out)
    return pin(ids.withColumn(out, F.col(out).cast("int")))


def _with_ids(data: DataFrame, ids: DataFrame, col: str, out: str) -> DataFrame:
    """``data`` with the ids of ``col``. Values that are their own ids, like those of an
    item index (C7), take no join: that is one shuffle of the ratings less."""
    if (isinstance(data.schema[col].dataType, IntegralType)
            and ids.where(F.col(col) != F.col(out)).isEmpty()):
        return data.withColumn(out, F.col(col).cast("int"))
    return data.join(ids, col)


def mean_ratings(events: DataFrame, user_col: str = "user_id",
                 item_col: str = "recording_mbid_index", rating_col: str = "rating") -> DataFrame:
    """One rating per (user, item): the mean of its rows.

    A user's many events of one item then reach the trainer as one row, so the
    size of a user's block follows the number of its items, not of its events.
    """
    return events.groupBy(user_col, item_col).agg(F.avg(rating_col).alias(rating_col))


def als_fit(ratings: DataFrame, user_col: str = "user_id",
            item_col: str = "recording_mbid_index", rating_col: str = "rating",
            rank: int = 20, reg: float = 0.5, alpha: float = 5.0, max_iter: int = 10,
            nonnegative: bool = True, implicit: bool = False, seed: int = 42,
            checkpoint_interval: int = 5, num_blocks: int = NUM_BLOCKS) -> RatingModel:
    """Fit ALS. Explicit feedback by default, where ``alpha`` has no effect;
    ``implicit=True`` switches to the confidence-weighted implicit form.

    MLlib needs ids in the 32-bit range, so users and items are always mapped to
    dense ids with the skew-safe ``global_index`` (not joined where they are the ids
    already); ``als_predict`` maps them back.
    Rows with a null user, item or rating are left out. The ratings and the trainer's
    blocks of them are kept on the executors' disks for the time of the fit, which reads
    them several times: their heap is for the blocks being built or solved.
    """
    ensure_checkpoint_dir(ratings.sparkSession)
    data = ratings.select(user_col, item_col, rating_col).dropna().persist(StorageLevel.DISK_ONLY)
    users, items = _dense(data, user_col, _USER), _dense(data, item_col, _ITEM)
    mapped = _with_ids(_with_ids(data, users, user_col, _USER), items, item_col, _ITEM).select(
        _USER, _ITEM, F.col(rating_col).cast("float")).persist(StorageLevel.DISK_ONLY)
    als = ALS(
        numUserBlocks=num_blocks, numItemBlocks=item_blocks(mapped.count(), num_blocks),
        rank=rank, maxIter=max_iter, regParam=reg, alpha=alpha,
        userCol=_USER, itemCol=_ITEM, ratingCol=rating_col,
        nonnegative=nonnegative, implicitPrefs=implicit, seed=seed,
        coldStartStrategy="drop", checkpointInterval=checkpoint_interval,
        intermediateStorageLevel="DISK_ONLY",
    )
    try:
        model = als.fit(mapped)
    finally:
        mapped.unpersist()
        data.unpersist()
    return RatingModel(model, users, items, user_col, item_col, reg, nonnegative, implicit)


GRADIENT_TOLERANCE = 1e-3


def als_optimality(model: RatingModel, ratings: DataFrame, rating_col: str = "rating",
                   tolerance: float = GRADIENT_TOLERANCE) -> DataFrame:
    """Per user of the training ``ratings``: ``n_ratings``, ``violation``, ``optimal``.

    The trainer's last half step solves, with the item factors y fixed, for every user
    the least squares sum (x.y - r)^2 + reg * n * |x|^2 over x >= 0. Its solution is
    characterised by the gradient g = sum (x.y - r) y + reg * n * x: zero in every
    component where x is positive and not negative where x is zero (zero everywhere
    without the sign constraint). ``violation`` is the largest excess over that, as a
    share of the sum of the absolute terms of its component; ``optimal`` says that it
    is at most ``tolerance`` (factors are stored as 32-bit floats and the trainer's
    inner solver stops at a small step).

    One grouped sum with map-side partial sums, so a hot user is added up by many
    tasks: rank + 1 doubles per user are shuffled, never outer products. Rows with a
    null user, item or rating are left out, as in the fit. Explicit feedback only.
    """
    if model.implicit:
        raise ValueError("the check covers explicit feedback")
    rank = model.model.rank
    data = ratings.select(model.user_col, model.item_col,
                          F.col(rating_col).cast("float").cast("double").alias("_cz_r")).dropna()
    rows = (data.join(model.item_factors().withColumnRenamed("features", "_cz_y"), model.item_col)
            .join(model.user_factors().withColumnRenamed("features", "_cz_x"), model.user_col))

    def part(col, j):
        return F.col(col)[j].cast("double")

    product = sum((part("_cz_x", j) * part("_cz_y", j) for j in range(rank)), F.lit(0.0))
    rows = rows.withColumn("_cz_p", product)
    error = F.col("_cz_p") - F.col("_cz_r")
    size = F.abs("_cz_p") + F.abs("_cz_r")
    sums = rows.groupBy(model.user_col).agg(
        F.count(F.lit(1)).alias("n_ratings"), F.any_value("_cz_x").alias("_cz_x"),
        F.array(*(F.sum(error * part("_cz_y", j)) for j in range(rank))).alias("_cz_g"),
        F.array(*(F.sum(size * F.abs(part("_cz_y", j))) for j in range(rank))).alias("_cz_m"))
    weight = F.lit(float(model.reg)) * F.col("n_ratings")

    def excess(j):
        x = part("_cz_x", j)
        g = F.col("_cz_g")[j] + weight * x
        whole = F.col("_cz_m")[j] + weight * F.abs(x)
        off = F.when((x > 0) | F.lit(not model.nonnegative), F.abs(g)).otherwise(F.greatest(-g, F.lit(0.0)))
        # a negative factor breaks the constraint itself
        broken = F.lit(model.nonnegative) & (x < 0)
        return F.when(broken, F.lit(1.0)).when(whole > 0, off / whole).otherwise(F.lit(0.0))

    violation = F.greatest(*map(excess, range(rank))) if rank > 1 else excess(0)
    return sums.select(model.user_col, "n_ratings", violation.alias("violation"),
                       (violation <= tolerance).alias("optimal"))


def als_predict(model: RatingModel, pairs: DataFrame, out: str = "prediction") -> DataFrame:
    """Score (user, item) pairs; pairs with an unknown user or item - any id, in
    range or not, or null - are dropped; the score is returned as double.

    The score is the one of ``ALSModel.transform``, a sum of 32-bit floats in order of
    the components. The items' factors are joined first: rows of one item then leave
    that join side by side, and a shuffle by user compresses their equal factors, where
    the model's own order sends a user's factors with every pair.
    """
    rows = (pairs.join(model.item_factors().withColumnRenamed("features", "_cz_y"), model.item_col)
            .join(model.user_factors().withColumnRenamed("features", "_cz_x"), model.user_col))
    score = sum((F.col("_cz_x")[j] * F.col("_cz_y")[j] for j in range(model.model.rank)),
                F.lit(0.0).cast("float"))
    scored = rows.select(*[F.col(c) for c in pairs.columns if c != out], score.cast("double").alias("_cz_s"))
    return scored.where(~F.isnan("_cz_s")).withColumnRenamed("_cz_s", out)
