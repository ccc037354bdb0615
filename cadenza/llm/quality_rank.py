"""Text quality by Bradley-Terry ranking of features.

A text's score is a weighted sum of features of its form. The weights make the
better text of a preference pair win: logistic loss on the difference of the two
feature vectors. Pairs come from all labelled texts, each worse one against several
better ones. The texts are dealt out in blocks that hold both classes; each Newton
step adds up gradient and curvature of the blocks' pairs in Spark tasks. The cut
between good and bad is the exact quantile of all training scores that leaves as many
below as are labelled bad.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import add_columns, code_points, map_groups, slices, stored, text_slices
from cadenza.operators.positions import global_index, rank_within

BLOCK_ROWS = 20_000  # labelled texts that are paired with one another in one task
RIVALS = 8  # better texts that each worse one is paired with
STEPS = 60
PENALTY = 1e-3
SLICE_CHARS = 500_000
FEATURES = ("log_chars", "log_words", "word_length", "upper", "digits", "spaces", "line_ends",
            "stops", "marks", "bars", "signs", "shouts", "other_marks", "beyond_ascii",
            "repeated_chars", "distinct_words", "top_word", "distinct_lines", "line_length",
            "packed", "short_text", "capital_words", "plain_words")

_UPPER, _DIGIT, _SPACE, _LINE, _STOP, _MARK, _BAR, _SIGN, _SHOUT, _OTHER = range(1, 11)
_KIND = np.zeros(128, dtype=np.int8)
for _chars, _kind in (("ABCDEFGHIJKLMNOPQRSTUVWXYZ", _UPPER), ("0123456789", _DIGIT),
                      (" \t", _SPACE), ("\n\r", _LINE), (".", _STOP), (",;:'\"-()", _MARK),
                      ("|<>{}[]\\/=_", _BAR), ("#$%&*@^~+", _SIGN), ("!?", _SHOUT), ("`", _OTHER)):
    _KIND[[ord(c) for c in _chars]] = _kind


def features(texts) -> np.ndarray:
    """One row of ``FEATURES`` per whole text; an empty text has zeros."""
    out = np.zeros((len(texts), len(FEATURES)))
    for a, b in text_slices(texts, SLICE_CHARS):
        points, bounds = code_points([t + "\x00" for t in texts[a:b]])
        kind = np.where(points < 128, _KIND[np.minimum(points, 127)], _OTHER + 1)
        upper = (points >= 0xC0) & (points <= 0xDE)
        kind = np.where(upper, _UPPER, kind)
        again = np.zeros(len(points), dtype=np.int64)
        again[1:] = points[1:] == points[:-1]
        size = np.diff(bounds) - 1
        shares = [np.add.reduceat(kind == k, bounds[:-1], dtype=np.int64) for k in range(1, _OTHER + 2)]
        shares = [s / np.maximum(size, 1) for s in [*shares, np.add.reduceat(again, bounds[:-1])]]
        for i, text in enumerate(texts[a:b]):
            if not text:
                continue
            words = text.split()
            lines = text.split("\n")
            count: dict[str, int] = {}
            for w in words:
                count[w] = count.get(w, 0) + 1
            n = max(len(words), 1)
            packed = len(zlib.compress(text.encode("utf-8", "surrogatepass"), 1))
            plain = sum(c for w, c in count.items() if w.isalpha() or (w[:-1].isalpha() and w[-1] in ".,"))
            out[a + i] = (
                np.log1p(size[i]), np.log1p(len(words)), np.log1p(size[i] / n),
                *(s[i] for s in shares), len(count) / n, max(count.values(), default=0) / n,
                len(set(lines)) / len(lines), np.log1p(size[i] / len(lines)),
                packed / max(1, size[i]), float(len(words) < 10),
                sum(c for w, c in count.items() if w[0].isupper()) / n, plain / n)
    return out


def featured(df: DataFrame, text_col: str = "text", drop=()) -> DataFrame:
    """``df`` with ``features`` (array of doubles); a null text counts as empty."""
    def prepare():
        return lambda texts: (list(features([t or "" for t in texts])),)

    return add_columns(df, [text_col], "features array<double>", prepare, drop=drop)


@dataclass
class Ranking:
    weights: np.ndarray
    means: np.ndarray
    scales: np.ndarray
    cut: float  # training score at the quantile of the share labelled bad
    slope: float  # of the logistic curve around the cut

    def logits(self, rows: np.ndarray) -> np.ndarray:
        return self.slope * (((rows - self.means) / self.scales) @ self.weights - self.cut)


def _gaps(z: np.ndarray, labels: np.ndarray, block: int = 0) -> np.ndarray:
    """Feature differences of the pairs of a block: each worse text against ``RIVALS``
    better ones, each better one against a worse one."""
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    random = np.random.Generator(np.random.PCG64(3 + block))
    better = random.choice(good, (len(bad), RIVALS))
    # every better text takes part as well, against one worse
    cover = np.stack([good, random.choice(bad, len(good))], axis=1)
    return np.concatenate([(z[better] - z[bad][:, None]).reshape(-1, z.shape[1]),
                           z[cover[:, 0]] - z[cover[:, 1]]])


def _sums(gap: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Summed gradient and curvature of the loss of the pairs, and their number."""
    win = 1 / (1 + np.exp(-np.clip(gap @ weights, -30, 30)))
    curve = (gap * (win * (1 - win))[:, None]).T @ gap
    return np.concatenate([gap.T @ (1 - win), curve.ravel(), [len(gap)]])


def _newton(sums, width: int) -> np.ndarray:
    """Weights by Newton steps; ``sums`` gives ``_sums`` of all pairs at some weights."""
    weights = np.zeros(width)
    for _ in range(STEPS):
        total = sums(weights)
        slope = total[:width] / total[-1] - PENALTY * weights
        curve = total[width:-1].reshape(width, width) / total[-1] + PENALTY * np.eye(width)
        step = np.linalg.solve(curve, slope)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _ranking(weights, means, scales, share: float, quantiles) -> Ranking:
    """``quantiles`` gives those of all training scores; ``share`` is labelled bad."""
    cut, low, high = quantiles([share, max(0.0, share - 0.05), min(1.0, share + 0.05)])
    return Ranking(weights, means, scales, float(cut), 4.0 / max(float(high - low), 1e-6))


def train(rows: np.ndarray, labels: np.ndarray) -> Ranking | None:
    """Weights from the pairs of one block of texts; None without both classes."""
    if not (labels == 1).any() or not (labels == 0).any():
        return None
    means, scales = rows.mean(axis=0), rows.std(axis=0)
    scales[scales < 1e-9] = 1.0
    z = (rows - means) / scales
    gap = _gaps(z, labels)
    weights = _newton(lambda w: _sums(gap, w), z.shape[1])
    return _ranking(weights, means, scales, (labels == 0).mean(), lambda q: np.quantile(z @ weights, q))


def _blocks(own: DataFrame, block_rows: int) -> tuple[DataFrame, dict[int, int]]:
    """Stored blocks of the labelled texts, and the number of texts by label.

    Every text is dealt to a block by its number within its label (1, 0, 2: others).
    Where a class has fewer texts than there are blocks, its texts go to several, so
    that every block holds both; ``own`` marks the first. One row per block, its texts in the order of the ids.
    """
    placed = rank_within(own, ["label"], [F.xxhash64("id"), F.col("id")], "place")
    counts = {r["label"]: r["count"] for r in placed.groupBy("label").count().collect()}
    if not counts.get(1) or not counts.get(0):
        return placed, counts
    number = -(-sum(counts.values()) // block_rows)
    first = F.pmod(F.col("place") - 1, F.lit(number))
    dealt = F.array(first)
    for label in (0, 1):
        if counts[label] < number:
            dealt = F.when(F.col("label") == label, F.sequence(
                first, F.lit(number - 1).cast("long"), F.lit(counts[label]).cast("long"))).otherwise(dealt)
    rows = placed.select("id", "features", "label", first.alias("first"), F.explode(dealt).alias("block"))

    def pack(table):
        table = table.take(pc.sort_indices(table["id"]))
        values = table["features"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        block = table["block"].to_numpy()
        return ([int(block[0])], [values.astype(np.float64).tobytes()],
                [table["label"].to_numpy().astype(np.int8).tobytes()],
                [(table["first"].to_numpy() == block).tobytes()])

    return stored(map_groups(rows, ["block"], "block long, rows binary, labels binary, own binary", pack)), counts


def _unpacked(batches):
    """(block, features, labels, own) of every block of Arrow batches."""
    for batch in slices(batches):
        for block, rows, labels, own in zip(*(c.to_pylist() for c in batch.columns)):
            labels = np.frombuffer(labels, np.int8)
            yield block, np.frombuffer(rows).reshape(len(labels), -1), labels, np.frombuffer(own, np.bool_)


def _per_task(blocks: DataFrame, add) -> list[np.ndarray]:
    """One array per task: ``add`` folds a task's blocks into it (None at first)."""
    def run(batches):
        total = None
        for block in _unpacked(batches):
            total = add(total, *block)
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([total.ravel()], pa.list_(pa.float64()))], ["total"])

    return [np.array(r["total"]) for r in blocks.mapInArrow(run, "total array<double>").collect()]


def _merged(a: np.ndarray | None, b: np.ndarray) -> np.ndarray:
    """Numbers, means and summed squared deviations (three rows) of two sets of texts."""
    if a is None:
        return b
    size = a[0] + b[0]
    gap = b[1] - a[1]
    return np.stack([size, a[1] + gap * b[0] / size, a[2] + b[2] + gap**2 * a[0] * b[0] / size])


def _moments(total, block, rows, labels, own) -> np.ndarray:
    rows = rows[own]
    if not len(rows):
        return total
    means = rows.mean(axis=0)
    return _merged(total, np.stack([np.full(len(means), float(len(rows))), means, ((rows - means)**2).sum(axis=0)]))


def _quantiles(scores: DataFrame, rows: int, shares) -> list[float]:
    """Exact quantiles of the one column of ``scores``, between two rows in proportion."""
    places = [share * (rows - 1) for share in shares]
    wanted = sorted({int(f(p)) for p in places for f in (np.floor, np.ceil)})
    at = {r["place"]: r["score"] for r in global_index(scores, [F.col("score")], "place").where(
        F.col("place").isin(wanted)).collect()}
    return [at[int(np.floor(p))] + (at[int(np.ceil(p))] - at[int(np.floor(p))]) * (p - np.floor(p))
            for p in places]


def fit(features_by_id: DataFrame, labels: DataFrame, id_col: str = "doc_id",
        label_col: str = "quality", block_rows: int = BLOCK_ROWS) -> Ranking | None:
    """Train on every labelled text, in blocks of at most about ``block_rows``.

    ``labels`` holds only rows that may be learned from; null labels are left
    out, and the larger of several labels of one id counts; of several texts of
    one id the smallest feature vector. What reaches the driver is one sum per task
    and step. None without both classes.
    """
    label = F.max(F.col(label_col)).cast("int")
    chosen = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("id")).agg(
                  F.when(label.isin(0, 1), label).otherwise(2).alias("label")))
    own = features_by_id.select(F.col(id_col).alias("id"), "features").join(chosen, "id").groupBy("id").agg(
        F.min("features").alias("features"), F.first("label").alias("label"))
    blocks, counts = _blocks(own, block_rows)
    if not counts.get(1) or not counts.get(0):
        return None
    rows = sum(counts.values())
    total = None
    for part in _per_task(blocks, _moments):
        total = _merged(total, part.reshape(3, -1))
    means, scales = total[1], np.sqrt(total[2] / rows)
    scales[scales < 1e-9] = 1.0

    def sums(weights):
        def add(total, block, rows, labels, own):
            part = _sums(_gaps((rows - means) / scales, labels, block), weights)
            return part if total is None else total + part

        return np.sum(_per_task(blocks, add), axis=0)

    weights = _newton(sums, len(means))

    def run(batches):
        for _, rows, _, own in _unpacked(batches):
            yield pa.RecordBatch.from_arrays([pa.array(((rows[own] - means) / scales) @ weights)], ["score"])

    scores = blocks.mapInArrow(run, "score double")
    return _ranking(weights, means, scales, counts[0] / rows, lambda q: _quantiles(scores, rows, q))


def score(df: DataFrame, ranking: Ranking | None) -> DataFrame:
    """``df`` (with ``features``) with ``score`` in 0 to 1 instead of the features.

    0.5 is the cut. Without a ranking every score is 0.5.
    """
    if ranking is None:
        return df.drop("features", "score").withColumn("score", F.lit(0.5))
    shared = df.sparkSession.sparkContext.broadcast(ranking)

    def prepare():
        def compute(rows):
            logit = np.clip(shared.value.logits(np.array(rows)), -500, 500)
            return (1 / (1 + np.exp(-logit)),)
        return compute

    return add_columns(df, ["features"], "score double", prepare, drop=["features"])
