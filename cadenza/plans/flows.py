"""The four evaluations end to end, as compositions of the operators.

Each returns small result DataFrames. The split events are not stored: they are a
plan of one shuffle, and the flows fold them to counts (or weigh them) in one
evaluation for both halves. What is read more than once after that (counts, weights,
the sample, the bias tables) is stored in the session's checkpoint folder, so a lost
executor costs a re-read, not a recomputation of the whole chain; Spark deletes it
when nothing reads it any longer (see ``pin``).

The truth of every evaluation is the whole held-out half: items unseen in
training keep an index of their own and stay in each user's list. Only the
pairs a factor model can not score drop out of its predictions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators import (
    COUNTS_PRESET,
    RECENCY_PRESET,
    BiasModel,
    RatingModel,
    Slices,
    als_fit,
    als_predict,
    apply_item_index,
    bias_fit,
    bias_predict,
    clean_interactions,
    compress_rating,
    event_slices,
    exact_auc,
    extend_item_index,
    fit_item_index,
    interaction_counts,
    list_average_precision,
    list_map,
    mean_ratings,
    overlap_at_n,
    overlap_mean,
    pin,
    popularity_topk,
    ranking_metrics,
    ranking_summary,
    recency_weight,
    sample_fraction,
    temporal_split,
    threshold_label,
    train_part,
    validation_part,
)

PAIR = ["user_id", "recording_mbid_index"]
EVENT = ["user_id", "recording_mbid", "timestamp"]


@dataclass
class Split:
    """Both halves of the events as one table with ``is_train``, and the slices its
    users were numbered by (None: they have none)."""
    flagged: DataFrame
    slices: Slices | None = None

    @property
    def train(self) -> DataFrame:
        return train_part(self.flagged)

    @property
    def validation(self) -> DataFrame:
        return validation_part(self.flagged)


def split_interactions(interactions: DataFrame, tracks: DataFrame, users: DataFrame,
                       ratio: float = 0.8) -> Split:
    """Clean (C1) and split (C2), in slices measured on the events as they come."""
    slices = event_slices(interactions)
    events = clean_interactions(interactions, tracks, users)
    return Split(temporal_split(events, ratio, slices=slices), slices)


def rated_counts(events: DataFrame) -> DataFrame:
    """Counts (C3) with compressed ratings."""
    return compress_rating(interaction_counts(events))


@dataclass
class Indexed:
    train: DataFrame       # user_id, count, rating, recording_mbid_index
    validation: DataFrame  # same columns; items unseen in train are numbered after those of train
    index: DataFrame       # recording_mbid, recording_mbid_index of the train items


def half_counts(split: Split) -> Split:
    """Rated counts (C3, C5) of both halves from one evaluation of the split, stored."""
    counts = interaction_counts(split.flagged, user_col=["is_train", "user_id"])
    return Split(pin(compress_rating(counts)))


def indexed_ratings(split: Split) -> Indexed:
    """Rated counts of both halves with the item index fitted on train."""
    return index_stored(half_counts(split))


def index_halves(train: DataFrame, validation: DataFrame) -> Indexed:
    """Replace items by the index of ``train``, extended by unseen held-out items.

    Both halves are stored first: the index is fitted on them and joined to them.
    """
    return index_stored(Split(pin(train.withColumn("is_train", F.lit(True)).unionByName(
        validation.withColumn("is_train", F.lit(False))))))


def index_stored(halves: Split) -> Indexed:
    """``index_halves`` of a stored table of both."""
    index = fit_item_index(halves.train)
    every = extend_item_index(index, halves.validation)
    return Indexed(apply_item_index(halves.train, index), apply_item_index(halves.validation, every), index)


def popularity_metrics(split: Split, beta: float = 100000, list_size: int = 100, k: int = 10,
                       metrics=("ap", "pk", "ndcg")) -> DataFrame:
    """Per user: the top-``list_size`` damped popularity list (C4) scored against
    every held-out event (C14-C16)."""
    counts = half_counts(split)
    top = popularity_topk(counts.train, beta=beta, k=list_size)
    return ranking_metrics(counts.validation, top, k=k, metrics=metrics, count_col="count")


def popularity_evaluation(split: Split, beta: float = 100000, list_size: int = 100,
                          k: int = 10) -> DataFrame:
    """C17: one row mean_map, mean_pk, mean_ndcg."""
    return ranking_summary(popularity_metrics(split, beta, list_size, k))


def als_scores(indexed: Indexed, **params) -> tuple[RatingModel, DataFrame]:
    """ALS on compressed counts (C10) and its scores of the held-out pairs (C11)."""
    model = als_fit(indexed.train, **{**COUNTS_PRESET, **params})
    return model, als_predict(model, indexed.validation)


def als_evaluation(indexed: Indexed, n: int = 100, **params) -> DataFrame:
    """ALS scores against the whole truth by top-n overlap."""
    _, scores = als_scores(indexed, **params)
    return overlap_mean(overlap_at_n(indexed.validation, scores, n=n))


def recency_ratings(split: Split) -> Indexed:
    """Recency weights (C6) of both halves as ratings, one row per event, indexed."""
    return index_halves(*(recency_weight(half.select(*EVENT), slices=split.slices)
                          .withColumn("rating", F.col("recency")) for half in (split.train, split.validation)))


def recency_model(indexed: Indexed, per_event: bool = False, **params) -> tuple[RatingModel, DataFrame]:
    """ALS on recency ratings and the ratings it was fitted on: one mean per (user,
    item), or with ``per_event`` a row per event."""
    train = indexed.train if per_event else mean_ratings(indexed.train)
    return als_fit(train, **{**RECENCY_PRESET, **params}), train


def recency_scores(indexed: Indexed, threshold: float = 4.0, per_event: bool = False,
                   **params) -> DataFrame:
    """ALS on recency ratings, scored held-out events with labels rating >=
    ``threshold`` (C20). The model is fitted on one mean rating per (user, item);
    ``per_event=True`` feeds it a row per event instead."""
    model, _ = recency_model(indexed, per_event, **params)
    return threshold_label(als_predict(model, indexed.validation), "rating", threshold)


def recency_evaluation(split: Split, threshold: float = 4.0, per_event: bool = False,
                       **params) -> DataFrame:
    """Exact AUC (C21) of the recency model."""
    scores = recency_scores(recency_ratings(split), threshold, per_event, **params)
    return exact_auc(scores, "prediction", "label")


def sampled_bias_model(indexed: Indexed, fraction: float = 0.1, seed: int = 42,
                       damping: float = 5.0) -> BiasModel:
    """Bias model (C12) fitted on an exact reproducible sample (C9) of the train ratings."""
    sample = sample_fraction(indexed.train.select(*PAIR, "rating"), fraction, seed, keys=PAIR)
    return bias_fit(pin(sample), damping=damping)


def bias_scores(model: BiasModel, indexed: Indexed, digits: int | None = None) -> DataFrame:
    """Scores of every held-out pair, unseen items included (bias 0); with
    ``digits`` rounded, so that ranking does not depend on summation order."""
    scores = bias_predict(model, indexed.validation)
    return scores if digits is None else scores.withColumn("prediction", F.round("prediction", digits))


def bias_list_precision(indexed: Indexed, fraction: float = 0.1, seed: int = 42, damping: float = 5.0,
                        n: int = 100, digits: int | None = None) -> DataFrame:
    """Per user: average precision of the sampled bias model's list."""
    scores = bias_scores(sampled_bias_model(indexed, fraction, seed, damping), indexed, digits)
    return list_average_precision(scores, scores, n=n)  # the scored rows hold the truth


def bias_evaluation(indexed: Indexed, fraction: float = 0.1, seed: int = 42,
                    damping: float = 5.0, n: int = 100, digits: int | None = None) -> DataFrame:
    """List MAP (C19) of the bias model fitted on a sample."""
    scores = bias_scores(sampled_bias_model(indexed, fraction, seed, damping), indexed, digits)
    return list_map(scores, scores, n=n)
