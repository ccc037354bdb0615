"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts the hashed n-grams of every labelled text: each task adds its
texts into one dense table per label and emits the non-zero cells, which are
summed in Spark. The log-probability matrix (labels x buckets) is collected and
broadcast in blocks of at most ``LABEL_BLOCK`` x ``BUCKETS`` doubles, one block at
a time; scoring is a gather and a segmented sum in numpy over Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import add_columns, code_points, mix64, slices, stored, text_slices

BUCKETS = 1 << 13
ORDERS = (2, 3)
LABEL_BLOCK = 512  # labels of one broadcast matrix; more labels take more matrices
SLICE_CHARS = 500_000
UNKNOWN = "und"


@dataclass
class LanguageModel:
    """One block of labels; ``later`` makes the blocks of the labels after them."""

    labels: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray  # labels x buckets
    later: LaterLabels | None = None

    def blocks(self) -> Iterator[LanguageModel]:
        """All blocks in the order of the labels, one in memory at a time."""
        yield LanguageModel(self.labels, self.log_prior, self.log_prob)
        if self.later is not None:
            yield from self.later.after(self.labels[-1])


@dataclass
class LaterLabels:
    """Counts that stay in Spark: ``label`` and its ``cells``, and the texts of all labels."""

    by_label: DataFrame
    documents: int

    def after(self, label: str) -> Iterator[LanguageModel]:
        while rows := _next_block(self.by_label.where(F.col("label") > label)):
            yield _block(rows, self.documents)
            label = rows[-1]["label"]


def _grams(texts, order: int):
    """Bucket of every n-gram of ``texts`` and the bounds of each text's grams.

    A text is lower-cased and framed by one space on both sides, so a gram
    never crosses into another text.
    """
    points, bounds = code_points([f" {t.lower()} " for t in texts])
    key = np.zeros(max(0, len(points) - order + 1), dtype=np.uint64)
    for k in range(order):
        key = key * np.uint64(1 << 21) + points[k:k + len(key)]
    bucket = (mix64(key + np.uint64(order)) & np.uint64(BUCKETS - 1)).astype(np.int32)
    sizes = np.diff(bounds) - (order - 1)  # >= 0: a framed text has two characters
    sizes = np.maximum(sizes, 0)
    inside = np.repeat(bounds[:-1], sizes) + (
        np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    return bucket[inside], starts


def _next_block(by_label: DataFrame) -> list:
    return by_label.orderBy("label").limit(LABEL_BLOCK).collect()


def _block(rows, all_documents: int | None = None) -> LanguageModel:
    """Smoothed logarithms of the counts in ``rows`` (label, cells)."""
    counts = np.zeros((len(rows), BUCKETS))
    documents = np.zeros(len(rows))
    for k, row in enumerate(rows):
        for bucket, n in row["cells"]:
            if bucket < 0:
                documents[k] = n
            else:
                counts[k, bucket] = n
    smooth = counts + 1.0
    return LanguageModel([r["label"] for r in rows],
                         np.log(documents / (all_documents or documents.sum())),
                         np.log(smooth / smooth.sum(axis=1, keepdims=True)))


def fit(df: DataFrame, text_col: str = "text", label_col: str = "lang") -> LanguageModel | None:
    """Count n-grams by label over every row with a label and a text.

    Rows with a null label or text are not learned from; None without any row.
    With ``LABEL_BLOCK`` labels or more the counts are stored, and only the first
    block of the matrix is returned in memory.
    """
    rows = df.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(label_col).cast("string").alias("label"), F.col(text_col).alias("text"))

    def count(batches):
        tables: dict[str, np.ndarray] = {}
        documents: dict[str, int] = {}
        for batch in slices(batches):
            by_label: dict[str, list[str]] = {}
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
                by_label.setdefault(label, []).append(text)
            for label, texts in by_label.items():
                table = tables.setdefault(label, np.zeros(BUCKETS, dtype=np.int64))
                documents[label] = documents.get(label, 0) + len(texts)
                for a, b in text_slices(texts, SLICE_CHARS):
                    for order in ORDERS:
                        table += np.bincount(_grams(texts[a:b], order)[0], minlength=BUCKETS)
        for label, table in tables.items():
            at = np.flatnonzero(table)
            yield pa.RecordBatch.from_pydict({  # bucket -1 holds the number of texts
                "label": [label] * (len(at) + 1), "bucket": np.append(at, -1).astype(np.int32),
                "n": np.append(table[at], documents[label])})

    cells = (rows.mapInArrow(count, "label string, bucket int, n long")
             .groupBy("label", "bucket").agg(F.sum("n").alias("n")))
    def lists(cells):
        return cells.groupBy("label").agg(F.collect_list(F.struct("bucket", "n")).alias("cells"))

    first = _next_block(lists(cells))
    if not first:
        return None
    if len(first) < LABEL_BLOCK:
        return _block(first)
    cells = stored(cells)
    documents = cells.where("bucket < 0").agg(F.sum("n")).first()[0]
    model = _block(first, documents)
    model.later = LaterLabels(lists(cells), documents)
    return model


def _posterior(model: LanguageModel, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best label of the block for each text, its log-likelihood with the prior, and
    the sum of the likelihoods of all labels of the block over that of the best."""
    best = np.zeros(len(texts), dtype=np.int64)
    top = np.zeros(len(texts))
    mass = np.zeros(len(texts))
    room = max(1, SLICE_CHARS * 4 // (4 + len(model.labels)))
    for a, b in text_slices(texts, room):
        total = np.tile(model.log_prior, (b - a, 1))
        for order in ORDERS:
            bucket, starts = _grams(texts[a:b], order)
            full = np.flatnonzero(np.diff(starts))
            if len(full):
                for k in range(len(model.labels)):
                    total[full, k] += np.add.reduceat(model.log_prob[k][bucket], starts[full])
        best[a:b] = total.argmax(axis=1)
        top[a:b] = total.max(axis=1)
        total -= total.max(axis=1, keepdims=True)
        mass[a:b] = np.exp(total).sum(axis=1)
    return best, top, mass


_STATE = ("__label", "__top", "__mass")  # best label so far, its log-likelihood, relative sum of all


def _judge(df: DataFrame, block: LanguageModel, text_col: str, first: bool, drop=()) -> DataFrame:
    """``df`` with ``_STATE`` after one more block of labels; null without a letter."""
    shared = df.sparkSession.sparkContext.broadcast(block)

    def prepare():
        model = shared.value

        def compute(texts, *before):
            known = [k for k, t in enumerate(texts) if t is not None and any(map(str.isalpha, t))]
            labels, tops, sums = ([None] * len(texts) for _ in _STATE)
            if known:
                for k, b, top, mass in zip(known, *map(np.ndarray.tolist, _posterior(
                        model, [texts[k] for k in known]))):
                    label = model.labels[b]
                    if before:
                        old, old_top, old_mass = (column[k] for column in before)
                        most = max(top, old_top)
                        mass = mass * np.exp(top - most) + old_mass * np.exp(old_top - most)
                        label, top = (label, top) if top > old_top else (old, old_top)
                    labels[k], tops[k], sums[k] = label, top, mass
            return labels, tops, sums

        return compute

    return add_columns(df, [text_col, *(() if first else _STATE)],
                       "{} string, {} double, {} double".format(*_STATE), prepare, drop=drop)


def predict(df: DataFrame, model: LanguageModel | None, text_col: str = "text",
            drop=()) -> DataFrame:
    """``df`` with ``lang_pred`` and ``score`` (posterior of that label, 0 to 1).

    A null text, a text without any letter, and every text when nothing was
    learned get ``und`` with score 0. Ties go to the first label in order. All
    columns but ``drop`` and all repeated rows are kept; columns named
    ``lang_pred`` or ``score``, in any case, are replaced. Any number of labels
    works: each further block of them reads the texts once more, from a stored table.
    """
    label, score = F.lit(UNKNOWN), F.lit(0.0)
    judged = df
    if model is not None:
        for k, block in enumerate(model.blocks()):
            judged = _judge(stored(judged) if k else judged, block, text_col, first=not k,
                            drop=() if model.later else drop)
        label = F.coalesce(F.col(_STATE[0]), label)
        score = F.coalesce(1.0 / F.col(_STATE[2]), score)
    made = {"lang_pred": label, "score": score}
    kept = [c for c in df.columns if c.lower() not in made and c not in drop]
    return judged.select(*kept, *(column.alias(name) for name, column in made.items()))


def held_out(modulus: int, remainder: int, id_col: str = "doc_id"):
    """Whether crc32 of the id as text leaves ``remainder`` (a null id: no)."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus == remainder
