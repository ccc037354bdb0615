"""Relational operators. Each takes and returns DataFrames."""

from cadenza.operators.als import (
    COUNTS_PRESET,
    RECENCY_PRESET,
    RatingModel,
    als_fit,
    als_optimality,
    als_predict,
    mean_ratings,
)
from cadenza.operators.auc import evaluator_auc, exact_auc
from cadenza.operators.bias import BiasModel, bias_fit, bias_predict
from cadenza.operators.clean import clean_interactions
from cadenza.operators.counts import interaction_counts
from cadenza.operators.indexing import apply_item_index, extend_item_index, fit_item_index
from cadenza.operators.listmap import list_average_precision, list_map
from cadenza.operators.metrics import ideal_dcg, ideal_gain, ranking_metrics, ranking_summary
from cadenza.operators.overlap import overlap_at_n, overlap_mean
from cadenza.operators.popularity import item_popularity, popularity_topk
from cadenza.operators.positions import (
    global_index,
    pin,
    rank_within,
    window_rank,
)
from cadenza.operators.rating import compress_rating, recency_weight, threshold_label
from cadenza.operators.sampling import sample_fraction
from cadenza.operators.slices import Slices, measure, rank_sliced
from cadenza.operators.split import event_slices, split_points, temporal_split, train_part, validation_part
from cadenza.operators.topn import top_n_per_user

__all__ = [
    "COUNTS_PRESET", "RECENCY_PRESET", "RatingModel", "als_fit", "als_optimality", "als_predict", "mean_ratings",
    "evaluator_auc", "exact_auc",
    "BiasModel", "bias_fit", "bias_predict",
    "clean_interactions", "interaction_counts",
    "apply_item_index", "extend_item_index", "fit_item_index",
    "list_average_precision", "list_map",
    "ideal_dcg", "ideal_gain", "ranking_metrics", "ranking_summary",
    "overlap_at_n", "overlap_mean",
    "item_popularity", "popularity_topk",
    "global_index", "pin", "rank_within", "window_rank",
    "compress_rating", "recency_weight", "threshold_label",
    "sample_fraction",
    "Slices", "measure", "rank_sliced",
    "event_slices", "split_points", "temporal_split", "train_part", "validation_part",
    "top_n_per_user",
]
