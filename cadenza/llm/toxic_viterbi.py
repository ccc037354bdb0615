"""Toxicity of texts after noisy-channel deobfuscation.

Tokens that look disguised (digits and signs for letters, letters spelled apart,
stretched letters) become lattices of the letters they may stand for. Viterbi
decoding finds the reading that a character trigram model, counted over the
whole corpus, likes best together with the cost of each disguise. The restored
text is then scored with a lexicon of words and word beginnings learned from
labelled texts.
"""

from __future__ import annotations

import math
import re
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import add_columns, code_points, mix64, slices, stored, text_slices
from cadenza.llm.word_shingles import hash_runs, shingle_sets

# fixed values: what signs stand for
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b",
        "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
SWAP_COST = 1.0  # nats for a sign read as a letter
KEEP_COST = 5.0  # for a sign in a disguised token that is read as itself
REPEAT_COST = 0.5  # for a stretched letter read once or twice
JOIN_COST = 0.2  # for a gap between letters spelled apart that is closed
GAP_COST = 2.0  # for one that is kept as a word end

SYMBOLS = 28  # word end, a to z, any other letter
SAMPLE_ROWS = 20_000  # labelled texts the lexicon is learned from
MIN_TEXTS = 4  # positive sample texts with an entry of the lexicon
MIN_PRECISION = 0.5  # lower bound of an entry's share of positive texts
PREFIXES = (3, 4, 5, 6, 7, 8, 9, 10)  # bytes
BASE_SCORE = 0.0025  # of a text without any entry of the lexicon
PRIOR = 0.1  # share of toxic texts that an entry's share is compared with
SLICE_CHARS = 500_000

_SIGNS = re.escape("".join(LEET))
_LETTER = r"[^\W\d_]"
DISGUISED = re.compile(
    # single letters or signs with one separator between them, four or more
    rf"(?<!\w)(?:[^\W_]|[@$!])(?:([ .\-_*])(?:[^\W_]|[@$!]))(?:\1(?:[^\W_]|[@$!])){{2,}}(?!\w)"
    # a sign between, before or (digits) behind letters
    rf"|(?:(?<![\w$@!|+(€£])[@$€£(]|{_LETTER}[{_SIGNS}]++(?={_LETTER})|(?<!\w)[0-9]++(?={_LETTER})"
    rf"|{_LETTER}[0-9@$]++(?!\w|[@$]))(?:{_LETTER}|[{_SIGNS}](?=[\w@$!]))*+"
    # a letter three times or more
    rf"|({_LETTER})\2\2+", re.I)


def _symbol(c: str) -> int:
    base = unicodedata.normalize("NFD", c.lower())[0]
    return ord(base) - 96 if "a" <= base <= "z" else 27 if base.isalpha() else 0


_SYMBOL = np.array([_symbol(chr(n)) for n in range(0x250)], dtype=np.int32)


def _trigrams(texts) -> np.ndarray:
    points, _ = code_points([f"\n{t}\n" for t in texts])
    one = np.where(points < len(_SYMBOL), _SYMBOL[np.minimum(points, len(_SYMBOL) - 1)], 0)
    key = (one[:-2] * SYMBOLS + one[1:-1]) * SYMBOLS + one[2:]
    return key[(one[1:-1] > 0) | (one[2:] > 0)]


def fit_language(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log-probability of each symbol after two others, counted over every text.

    The result has ``SYMBOLS`` ** 3 cells whatever the size of the corpus.
    """
    def run(batches):
        total = np.zeros(SYMBOLS ** 3, np.int64)
        for batch in slices(batches):
            texts = [t for t in batch.column(0).to_pylist() if t]
            for a, b in text_slices(texts, SLICE_CHARS):
                total += np.bincount(_trigrams(texts[a:b]), minlength=SYMBOLS ** 3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"cell": at.astype(np.int32), "n": total[at]})

    rows = (df.select(text_col).mapInArrow(run, "cell int, n long")
            .groupBy("cell").agg(F.sum("n").alias("n")).collect())
    three = np.zeros(SYMBOLS ** 3)
    for r in rows:
        three[r["cell"]] = r["n"]
    three = three.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    two = three.sum(axis=0)
    one = two.sum(axis=0) + 1.0
    low = (two + one / one.sum()) / (two.sum(axis=1, keepdims=True) + 1.0)
    return np.log((three + 4.0 * low) / (three.sum(axis=2, keepdims=True) + 4.0))


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """Readings (letters, cost) of each stretch of a disguised token."""
    apart = len(token) > 6 and re.fullmatch(r"(?:.[ .\-_*])+.", token, re.S)
    out: list[list[tuple[str, float]]] = []
    k = 0
    while k < len(token):
        c = token[k]
        if apart and k % 2:
            out.append([("", JOIN_COST), (" ", GAP_COST)])
            k += 1
            continue
        end = k + 1
        while not apart and end < len(token) and token[end] == c:
            end += 1
        own = [(c, 0.0 if c.isalpha() else KEEP_COST)] + [(x, SWAP_COST) for x in LEET.get(c, "")]
        if end - k >= 3 or (end - k == 2 and not c.isalpha()):
            out.append([(x * n, cost + REPEAT_COST) for x, cost in own for n in (1, 2)])
        else:
            out += [own] * (end - k)
        k = end
    return out


def restore(token: str, language: np.ndarray) -> str:
    """Best reading of a disguised token in lower case (Viterbi over its lattice)."""
    best = {(0, 0): (0.0, None)}  # last two symbols -> (cost, path)
    for step in lattice(token.lower()):
        new: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (cost, path) in best.items():
            for text, extra in step:
                x, y, total = a, b, cost + extra
                for c in text:
                    z = _SYMBOL[ord(c)] if ord(c) < len(_SYMBOL) else 27 if c.isalpha() else 0
                    total -= language[x, y, z] if y or z else 0.0
                    x, y = y, z
                if (x, y) not in new or total < new[x, y][0]:
                    new[x, y] = (total, (path, text))
        best = new
    ends = ((cost - (language[x, y, 0] if y else 0.0), path) for (x, y), (cost, path) in best.items())
    path = min(ends, key=lambda e: e[0])[1]
    out = []
    while path:
        path, text = path
        out.append(text)
    return "".join(reversed(out))


class Restorer:
    """Restores whole texts; remembers the tokens it has met (bounded)."""

    def __init__(self, language: np.ndarray, limit: int = 100_000):
        self.language, self.limit = language, limit
        self.known: dict[str, str] = {}

    def _token(self, token: str) -> str:
        got = self.known.get(token)
        if got is None:
            got = restore(token, self.language)
            if len(self.known) >= self.limit:
                self.known.clear()
            self.known[token] = got
        return got

    def text(self, text: str) -> str:
        """Lower-cased text with every disguised token replaced by its reading."""
        low = text.lower()
        out, at = [], 0
        for found in DISGUISED.finditer(low):
            start, end = found.span()
            if start < at:
                continue
            if not found[1]:  # the whole token around a sign or a stretched letter
                while start > at and (low[start - 1].isalnum() or low[start - 1] in "@$"):
                    start -= 1
                while end < len(low) and low[end].isalnum():
                    end += 1
            out += [low[at:start], self._token(low[start:end])]
            at = end
        return "".join([*out, low[at:]]) if out else low


_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def _features(texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every word of lower-cased texts and of its beginnings.

    Returns a (words, 1 + prefixes) table, 0 where a word is not longer than the
    prefix, and the bounds of each text's words.
    """
    raws = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(raws) + b"\n", dtype=np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raws])
    inside = _WORD[data]
    before = np.concatenate([[False], inside[:-1]])
    first, last = np.flatnonzero(inside & ~before), np.flatnonzero(~inside & before)
    cuts = [last] + [np.minimum(first + k, last) for k in PREFIXES]
    table = np.stack(hash_runs(data, first, cuts), axis=1)
    for column, k in enumerate(PREFIXES, 1):
        table[:, column] = np.where(last - first > k, mix64(table[:, column] + np.uint64(k)), 0)
    return table, np.concatenate([[0], np.searchsorted(first, ends)])


@dataclass
class Lexicon:
    """Feature hashes in order and their estimated probability of toxicity."""

    hashes: np.ndarray
    shares: np.ndarray


def _lower_bound(share, n):
    """Lower end of the 90 % Wilson interval of a share seen in n texts."""
    z = 1.645
    return (share + z * z / (2 * n) - z * np.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (
        1 + z * z / n)


def fit_lexicon(df: DataFrame, labels: DataFrame, language: np.ndarray, id_col: str = "doc_id",
                text_col: str = "text", label_col: str = "toxic",
                sample_rows: int = SAMPLE_ROWS) -> Lexicon:
    """Learn from at most ``sample_rows`` labelled texts (lowest hashes of the ids).

    ``labels`` holds only rows that may be learned from; null labels are left
    out. The sample is bounded, so its ids are broadcast and its features counted
    in two steps: those of positive texts, then the same ones in negative texts.
    Positive texts with the same smallest word shingle (copies, as a rule) count
    once, or the words of a copied text would look like evidence.
    """
    spark = df.sparkSession
    chosen = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("label"))
              .orderBy(F.xxhash64("id"), "id").limit(sample_rows))
    shared = spark.sparkContext.broadcast(language)

    def prepare():
        restorer = Restorer(shared.value)

        def compute(texts):
            table, bounds = _features([restorer.text(t or "") for t in texts])
            return ([np.unique(table[a:b]).astype(np.int64) for a, b in zip(bounds, bounds[1:])],
                    [int(s[0].astype(np.int64)) if len(s) else 0 for s in shingle_sets(texts)])

        return compute

    rows = stored(add_columns(
        df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .join(F.broadcast(stored(chosen)), "id"), ["text"],
        "features array<bigint>, origin long", prepare, drop=["text"]))
    each = rows.select("label", "origin", F.explode("features").alias("feature")).where("feature <> 0")
    positive = stored(each.where("label = 1").select("feature", "origin").distinct()
                      .groupBy("feature").agg(F.count(F.lit(1)).alias("yes"))
                      .where(F.col("yes") >= MIN_TEXTS))
    both = (each.where("label <> 1").join(positive.select("feature"), "feature", "left_semi")
            .groupBy("feature").agg(F.count(F.lit(1)).alias("no")))
    # a bounded sample has a bounded number of features
    found = (positive.join(both, "feature", "left").na.fill(0, ["no"])
             .where(f"yes >= {MIN_PRECISION} * (yes + no)").collect())
    hashes = np.array([r["feature"] for r in found], dtype=np.int64).view(np.uint64)
    yes, no = (np.array([r[k] for r in found], dtype=np.float64) for k in ("yes", "no"))
    share = _lower_bound(yes / np.maximum(yes + no, 1), np.maximum(yes + no, 1))
    good = share >= MIN_PRECISION
    order = np.argsort(hashes[good])
    return Lexicon(hashes[good][order], share[good][order])


def _scores(lexicon: Lexicon, texts) -> np.ndarray:
    """Probability from the log-odds of the different lexicon words of each text."""
    out = np.full(len(texts), BASE_SCORE)
    if not len(lexicon.hashes):
        return out
    gain = np.log(lexicon.shares / (1 - lexicon.shares)) - math.log(PRIOR / (1 - PRIOR))
    for a, b in text_slices(texts, SLICE_CHARS):
        table, bounds = _features(texts[a:b])
        at = np.minimum(np.searchsorted(lexicon.hashes, table), len(lexicon.hashes) - 1)
        found = np.where(lexicon.hashes[at] == table, gain[at], 0.0).max(axis=1, initial=0)
        hit = np.flatnonzero(found)
        owner = np.searchsorted(bounds, hit, side="right") - 1
        seen: dict[int, dict[int, float]] = {}
        for word, text in zip(hit, owner):
            seen.setdefault(int(text), {})[int(table[word, 0])] = found[word]
        for text, words in seen.items():
            odds = math.log(BASE_SCORE / (1 - BASE_SCORE)) + sum(words.values())
            out[a + text] = 1 / (1 + math.exp(-min(odds, 500.0)))
    return out


def score(df: DataFrame, language: np.ndarray, lexicon: Lexicon, text_col: str = "text",
          drop=()) -> DataFrame:
    """``df`` with ``score``: estimated probability of toxicity, 0 to 1.

    A null or empty text, and every text when nothing was learned, gets
    ``BASE_SCORE``. Rows, repeated ones too, and columns but ``drop`` stay; a
    column named ``score`` is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast((language, lexicon))

    def prepare():
        language, lexicon = shared.value
        restorer = Restorer(language)
        return lambda texts: (_scores(lexicon, [restorer.text(t or "") for t in texts]),)

    return add_columns(df, [text_col], "score double", prepare, drop=drop)
