"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame built
from the whole test tables through the operators. Doubles that come from
transcendental functions or floating sums are reported rounded to 9 decimals
(``_r``), and floating scores are rounded the same way before they are ranked,
so the results do not depend on summation order.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza import schemas
from cadenza.operators import (
    als_optimality,
    als_predict,
    apply_item_index,
    bias_fit,
    clean_interactions,
    compress_rating,
    exact_auc,
    fit_item_index,
    interaction_counts,
    item_popularity,
    overlap_at_n,
    overlap_mean,
    popularity_topk,
    recency_weight,
    sample_fraction,
    split_points,
    threshold_label,
    top_n_per_user,
)
from cadenza.plans import flows
from cadenza.plans.flows import Indexed, Split
from cadenza.session import ensure_checkpoint_dir
from cadenza.sources import (
    load_events,
    load_interactions,
    load_tracks,
    load_users,
    read_csv,
    read_parquet,
    write_csv,
    write_parquet,
)

DIGITS = 9
LIST_SIZE = 100   # popularity list length
K = 10            # cutoff of P@k and NDCG@k
SMALL_N = 5       # per-user list length where n = 100 would keep every held-out pair
BETA = 100000
RATIO = 0.8
RATING_CUT = math.log(4)       # compressed rating of two plays
RECENCY_CUT = math.exp(-2)     # recency weight of a user's third newest event
LEFT_OUT = 7                   # the unseen_* queries train without items whose number it divides


def _r(col: str) -> F.Column:
    return F.round(F.col(col), DIGITS).alias(col)


# ---- inputs through the flows --------------------------------------------

def clean(spark: SparkSession, sf: str) -> DataFrame:
    return clean_interactions(load_interactions(spark, sf), load_tracks(spark, sf), load_users(spark, sf))


def split(spark: SparkSession, sf: str) -> Split:
    return flows.split_interactions(load_interactions(spark, sf), load_tracks(spark, sf),
                                    load_users(spark, sf), RATIO)


def indexed(spark: SparkSession, sf: str) -> Indexed:
    return flows.indexed_ratings(split(spark, sf))


def unseen_split(spark: SparkSession, sf: str) -> Split:
    """The split with some items missing from the train half, so that the held-out
    half has items no model has seen."""
    halves = split(spark, sf)
    number = F.substring("recording_mbid", 2, 20).cast("bigint")
    known = F.coalesce(number % LEFT_OUT != 0, F.lit(False))
    return Split(halves.flagged.where(~F.col("is_train") | known), halves.slices)


def unseen_indexed(spark: SparkSession, sf: str) -> Indexed:
    return flows.indexed_ratings(unseen_split(spark, sf))


def full_bias_scores(data: Indexed) -> DataFrame:
    """Bias model on all train ratings, rounded scores of the held-out pairs."""
    return flows.bias_scores(bias_fit(data.train), data, DIGITS)


# ---- queries -------------------------------------------------------------

def q_clean_interactions(spark, sf):
    return clean(spark, sf)


def q_null_fallback(spark, sf):
    fell_back = clean(spark, sf).where(F.col("recording_mbid") == F.col("interactions_msid"))
    return fell_back.groupBy("recording_mbid").agg(F.count(F.lit(1)).alias("events"))


def q_temporal_split(spark, sf):
    return split(spark, sf).flagged


def q_train_rows(spark, sf):
    return split(spark, sf).train


def q_validation_rows(spark, sf):
    return split(spark, sf).validation


def q_split_points(spark, sf):
    return split_points(clean(spark, sf), RATIO)


def q_interaction_counts(spark, sf):
    return interaction_counts(split(spark, sf).train)


def q_validation_counts(spark, sf):
    return interaction_counts(split(spark, sf).validation)


def q_item_popularity(spark, sf):
    return item_popularity(interaction_counts(split(spark, sf).train), beta=BETA)


def _top_list(spark, sf, beta):
    return popularity_topk(interaction_counts(split(spark, sf).train), beta=beta, k=LIST_SIZE)


def q_popularity_topk_beta0(spark, sf):
    return _top_list(spark, sf, 0)


def q_popularity_topk_beta100(spark, sf):
    return _top_list(spark, sf, 100)


def q_popularity_topk(spark, sf):
    return _top_list(spark, sf, BETA)


def q_compress_counts(spark, sf):
    return flows.rated_counts(split(spark, sf).train).select(
        "user_id", "recording_mbid", "count", _r("rating"))


def _recency(events, per_item=False, slices=None):
    return recency_weight(events, per_item=per_item, position="position", slices=slices).select(
        "user_id", "recording_mbid", "timestamp", "position", _r("recency"))


def q_recency_weight(spark, sf):
    halves = split(spark, sf)
    return _recency(halves.train.select(*flows.EVENT), slices=halves.slices)


def q_recency_validation(spark, sf):
    halves = split(spark, sf)
    return _recency(halves.validation.select(*flows.EVENT), slices=halves.slices)


def q_recency_per_item(spark, sf):
    return _recency(split(spark, sf).train.select(*flows.EVENT), per_item=True)


def q_recency_events(spark, sf):
    return _recency(load_events(spark, sf))


def q_compress_recency(spark, sf):
    halves = split(spark, sf)
    rec = recency_weight(halves.train.select(*flows.EVENT), slices=halves.slices)
    return compress_rating(rec, "recency").select(
        "user_id", "recording_mbid", "timestamp", _r("recency"), _r("rating"))


def q_recency_ratings(spark, sf):
    """The ratings of the recency flow: weights of the held-out events, indexed."""
    return flows.recency_ratings(split(spark, sf)).validation.select(
        "user_id", "recording_mbid_index", "timestamp", _r("rating"))


def q_item_index(spark, sf):
    return fit_item_index(flows.rated_counts(split(spark, sf).train))


def q_apply_item_index(spark, sf):
    halves = flows.half_counts(split(spark, sf))
    return apply_item_index(halves.validation, fit_item_index(halves.train)).select(
        "user_id", "count", _r("rating"), "recording_mbid_index")


def q_unseen_item_index(spark, sf):
    """Held-out ratings with unseen items numbered after those of the train half."""
    return unseen_indexed(spark, sf).validation.select(
        "user_id", "count", _r("rating"), "recording_mbid_index")


def q_sample_exact(spark, sf):
    return sample_fraction(indexed(spark, sf).train.select(*flows.PAIR, "count"), 0.1, 42, keys=flows.PAIR)


def q_sample_bernoulli(spark, sf):
    """Nine tenths of the train ratings, chosen by a hash of the pair."""
    return sample_fraction(indexed(spark, sf).train.select(*flows.PAIR, "count"), 0.9, 42,
                           keys=flows.PAIR, exact=False)


def q_overwritten_ratings(spark, sf):
    """Indexed ratings of the held-out half, written over those of the train half and read back."""
    data = indexed(spark, sf)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ratings-{uuid.uuid4().hex}.parquet"
    for half in (data.train, data.validation):
        write_parquet(half.select(*flows.PAIR, "rating"), path, mode="overwrite")
    return read_parquet(spark, path).select(*flows.PAIR, _r("rating"))


def q_csv_ratings(spark, sf):
    """Indexed train ratings through the CSV interchange (header, explicit schema):
    written into the checkpoint folder, read back."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ratings-{uuid.uuid4().hex}.csv"
    write_csv(indexed(spark, sf).train.select(*flows.PAIR, "rating"), path)
    back = read_csv(spark, path, schemas.RATINGS_CSV)
    return back.select(*flows.PAIR, _r("rating"))


def q_top_n_by_rating(spark, sf):
    return top_n_per_user(indexed(spark, sf).validation, "rating", SMALL_N).select(
        *flows.PAIR, "count", _r("rating"), "rank")


def q_average_precision(spark, sf):
    return flows.popularity_metrics(split(spark, sf), BETA, LIST_SIZE, K, ["ap"]).select("user_id", _r("ap"))


def q_precision_at_k(spark, sf):
    return flows.popularity_metrics(split(spark, sf), BETA, LIST_SIZE, K, ["pk"]).select("user_id", _r("pk"))


def q_ndcg_at_k(spark, sf):
    return flows.popularity_metrics(split(spark, sf), BETA, LIST_SIZE, K, ["ndcg"]).select(
        "user_id", _r("ndcg"))


def q_ranking_summary(spark, sf):
    return flows.popularity_evaluation(split(spark, sf), BETA, LIST_SIZE, K).select(
        _r("mean_map"), _r("mean_pk"), _r("mean_ndcg"))


def _bias_rows(data):
    return full_bias_scores(data).select(*flows.PAIR, "count", _r("rating"), "prediction")


def q_bias_predict(spark, sf):
    return _bias_rows(indexed(spark, sf))


def q_unseen_bias_predict(spark, sf):
    return _bias_rows(unseen_indexed(spark, sf))


def q_top_n_by_prediction(spark, sf):
    return top_n_per_user(full_bias_scores(indexed(spark, sf)), "prediction", SMALL_N).select(
        *flows.PAIR, "prediction", "rank")


def _overlap(data, n, percent=False):
    return overlap_at_n(data.validation, full_bias_scores(data), n=n, percent=percent)


def q_overlap_at_5(spark, sf):
    return _overlap(indexed(spark, sf), SMALL_N).select(
        "user_id", "common_count", "true_count", _r("common_percentage"))


def q_unseen_overlap_at_5(spark, sf):
    return _overlap(unseen_indexed(spark, sf), SMALL_N).select(
        "user_id", "common_count", "true_count", _r("common_percentage"))


def q_overlap_percent_at_5(spark, sf):
    return _overlap(indexed(spark, sf), SMALL_N, percent=True).select("user_id", _r("common_percentage"))


def q_overlap_mean(spark, sf):
    return overlap_mean(_overlap(indexed(spark, sf), SMALL_N)).select(_r("overlap"))


def _overlap_mean_seen(data):
    """Lists of up to 100 against the whole truth, with predictions for the items
    of the train half only (as a factor model drops the others)."""
    seen = full_bias_scores(data).join(data.index.select("recording_mbid_index"), "recording_mbid_index")
    return overlap_mean(overlap_at_n(data.validation, seen, n=LIST_SIZE)).select(_r("overlap"))


def q_overlap_mean_100(spark, sf):
    return _overlap_mean_seen(indexed(spark, sf))


def q_unseen_overlap_mean_100(spark, sf):
    return _overlap_mean_seen(unseen_indexed(spark, sf))


def q_unseen_overlap_null_items(spark, sf):
    """Overlap where held-out items unseen in training have no number at all."""
    halves = flows.half_counts(unseen_split(spark, sf))
    truth = apply_item_index(halves.validation, fit_item_index(halves.train))
    scores = truth.withColumn("prediction", F.col("count") % 3 + F.col("recording_mbid_index") % 10)
    return overlap_at_n(truth, scores, n=SMALL_N).select(
        "user_id", "common_count", "true_count", _r("common_percentage"))


def q_list_map(spark, sf):
    return flows.bias_evaluation(indexed(spark, sf), n=LIST_SIZE, digits=DIGITS).select(
        "users", _r("list_map"))


def q_list_ap(spark, sf):
    return flows.bias_list_precision(indexed(spark, sf), n=LIST_SIZE, digits=DIGITS).select(
        "user_id", _r("ap"))


def q_unseen_list_map(spark, sf):
    return flows.bias_evaluation(unseen_indexed(spark, sf), n=SMALL_N, digits=DIGITS).select(
        "users", _r("list_map"))


def q_unseen_list_ap(spark, sf):
    return flows.bias_list_precision(unseen_indexed(spark, sf), n=SMALL_N, digits=DIGITS).select(
        "user_id", _r("ap"))


def q_item_bias(spark, sf):
    return bias_fit(indexed(spark, sf).train).item_bias.select("recording_mbid_index", _r("item_bias"))


def q_user_bias(spark, sf):
    return bias_fit(indexed(spark, sf).train).user_bias.select("user_id", _r("user_bias"))


def q_threshold_label(spark, sf):
    return threshold_label(indexed(spark, sf).validation, "rating", RATING_CUT - 1e-9).select(
        *flows.PAIR, _r("rating"), "label")


def q_auc_exact(spark, sf):
    labelled = threshold_label(full_bias_scores(indexed(spark, sf)), "count", 2.0)
    return exact_auc(labelled, "prediction", "label").select(_r("auc"), "positives", "negatives")


# ---- factor models: SQL checks that the scores are the model's, and that the model
# solves its least squares (a changed factor turns ``optimal`` false)

def _als_rows(data):
    """Scored held-out pairs, and whether each score is the dot product of the
    stored non-negative factors of its user and item."""
    model, scores = flows.als_scores(data)
    factors = (scores.join(model.item_factors().withColumnRenamed("features", "vf"), "recording_mbid_index")
               .join(model.user_factors().withColumnRenamed("features", "uf"), "user_id"))
    product = F.aggregate(F.zip_with("uf", "vf", lambda a, b: a.cast("double") * b.cast("double")),
                          F.lit(0.0), lambda acc, x: acc + x)
    return factors.select(
        *flows.PAIR, "count", _r("rating"),
        (F.col("prediction") >= 0).alias("nonnegative"),
        (F.abs(F.col("prediction") - product) < 1e-5).alias("is_product"))


def q_als_predict(spark, sf):
    return _als_rows(indexed(spark, sf))


def q_unseen_als_predict(spark, sf):
    return _als_rows(unseen_indexed(spark, sf))


def _als_within(data):
    """Per user the length of the paired lists, whether the overlap lies within it (cold
    pairs drop out of the predictions, not of the truth), and whether the user's
    factors solve their least squares."""
    model, scores = flows.als_scores(data)
    lists = overlap_at_n(data.validation, scores, n=SMALL_N)
    return lists.join(als_optimality(model, data.train), "user_id").select(
        "user_id", "true_count", F.col("common_count").between(0, F.col("true_count")).alias("within"),
        "optimal")


def q_als_overlap(spark, sf):
    return _als_within(indexed(spark, sf))


def q_unseen_als_overlap(spark, sf):
    return _als_within(unseen_indexed(spark, sf))


def q_als_optimal(spark, sf):
    """Per train user of the count model: ratings, and whether the factors are optimal."""
    data = indexed(spark, sf)
    model, _ = flows.als_scores(data)
    return als_optimality(model, data.train).select("user_id", "n_ratings", "optimal")


def _recency_optimal(spark, sf, per_event):
    model, train = flows.recency_model(flows.recency_ratings(split(spark, sf)), per_event)
    return als_optimality(model, train).select("user_id", "n_ratings", "optimal")


def q_recency_als_optimal(spark, sf):
    """The same for the recency model fitted on one mean per (user, item)."""
    return _recency_optimal(spark, sf, False)


def q_event_als_optimal(spark, sf):
    """The same for the recency model fitted on one rating per event."""
    return _recency_optimal(spark, sf, True)


def _als_auc(halves):
    return flows.recency_evaluation(halves, threshold=RECENCY_CUT - 1e-9)


def _als_auc_defined(halves):
    """Label counts of the scored held-out events, whether the AUC is defined, and
    whether the factors of every user solve their least squares."""
    data = flows.recency_ratings(halves)
    model, train = flows.recency_model(data)
    labelled = threshold_label(als_predict(model, data.validation), "rating", RECENCY_CUT - 1e-9)
    optimal = als_optimality(model, train).agg(F.bool_and("optimal")).first()[0]
    return exact_auc(labelled).select(
        "positives", "negatives", F.col("auc").between(0.0, 1.0).alias("auc_defined"),
        F.lit(optimal).alias("optimal"))


def q_als_recency_auc(spark, sf):
    return _als_auc_defined(split(spark, sf))


def q_unseen_als_recency_auc(spark, sf):
    return _als_auc_defined(unseen_split(spark, sf))


def _als_lists(data):
    _, scores = flows.als_scores(data)
    return overlap_at_n(data.validation, scores, n=SMALL_N)


def als_overlap_values(spark, sf):
    """Per user the overlap of the model of all train rows."""
    return _als_lists(indexed(spark, sf))


def als_recency_auc_value(spark, sf):
    """AUC of the recency model of all train rows."""
    return _als_auc(split(spark, sf))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}

# what the fit decides: no statement in SQL, the rows only
FIT_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "als_overlap_values": als_overlap_values,
    "als_recency_auc_value": als_recency_auc_value,
}
