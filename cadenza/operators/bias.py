"""Zero-factor rating model - global mean plus damped item and user biases.

    mu      = mean rating
    b_i     = sum(r - mu) / (n_i + damping)            over the item's ratings
    b_u     = sum(r - mu - b_i) / (n_u + damping)      over the user's ratings
    r_hat   = mu + b_i + b_u                            (unknown item/user: bias 0)

Fitting is two grouped aggregates and one join of the ratings to the item
biases; scoring is two joins. Only mu travels through the driver (one scalar).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators.positions import pin


@dataclass
class BiasModel:
    mean: float
    item_bias: DataFrame  # item_col, item_bias
    user_bias: DataFrame  # user_col, user_bias
    user_col: str
    item_col: str


def bias_fit(ratings: DataFrame, user_col: str = "user_id",
             item_col: str = "recording_mbid_index", rating_col: str = "rating",
             damping: float = 5.0) -> BiasModel:
    """Fit the model. Runs when called: one job for the global mean, one for each
    bias table (stored, as scoring and evaluation read them several times)."""
    rated = ratings.where(F.col(rating_col).isNotNull()).select(user_col, item_col, rating_col)
    mu = rated.agg(F.avg(rating_col)).first()[0]
    if mu is None:
        raise ValueError("no ratings to fit")
    mu_c = F.lit(float(mu))
    d = F.lit(float(damping))
    item_bias = pin(rated.groupBy(item_col).agg(
        (F.sum(F.col(rating_col) - mu_c) / (F.count(F.lit(1)) + d)).alias("item_bias")))
    with_item = rated.join(item_bias, item_col, "left")
    user_bias = pin(with_item.groupBy(user_col).agg(
        (F.sum(F.col(rating_col) - mu_c - F.coalesce(F.col("item_bias"), F.lit(0.0)))
         / (F.count(F.lit(1)) + d)).alias("user_bias")))
    return BiasModel(float(mu), item_bias, user_bias, user_col, item_col)


def bias_predict(model: BiasModel, pairs: DataFrame, out: str = "prediction") -> DataFrame:
    """``pairs`` with ``out`` = mu + b_i + b_u (missing biases count as 0)."""
    scored = (pairs.join(model.item_bias, model.item_col, "left")
              .join(model.user_bias, model.user_col, "left"))
    pred = (F.lit(model.mean) + F.coalesce(F.col("item_bias"), F.lit(0.0))
            + F.coalesce(F.col("user_bias"), F.lit(0.0)))
    return scored.select(*[F.col(c) for c in pairs.columns], pred.alias(out))
