"""Importance resampling towards a target distribution, with lines as segments.

Features are the words of a text and its pairs of consecutive words, hashed into
buckets by CRC-32. Newlines separate words, so a text falls into lines: the words
and pairs inside a line are the line's own, and only the pair across two lines
(the last word of one, the first word of the next that has any) belongs to the
text.

Counting a corpus: every task folds its lines to distinct ones with a number of
occurrences, Spark adds these up per line, and the features of each distinct line
are computed once and counted as often as the line occurs. Pairs across lines are
counted beside them, hashed already. Only one row per bucket reaches the driver.

Weighing a text: the gain of a bucket is known then. A task sums the gains of each
distinct line of a slice of texts once, adds them up per text by occurrences, and
adds the pairs across lines. (Joining the texts' lines to a table of all distinct
lines would shuffle a row per line to save this arithmetic.)

All steps inside a task are array operations on UTF-8 bytes. The CRC of a pair is
put together from the CRCs of its two words: appending n bytes multiplies a CRC by
x^(8 n), four look-ups in a table of that n.
"""

from __future__ import annotations

import math
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import add_columns, slices, stored, text_slices

BUCKETS = 10_000
SLICE_CHARS = 1 << 20
_STEPS = 32  # bytes up to which words are hashed together; zlib hashes longer ones


@lru_cache(maxsize=1)
def _byte_table() -> np.ndarray:
    """CRC register after one byte, by its low eight bits."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


@lru_cache(maxsize=4096)
def _append_table(n: int) -> np.ndarray:
    """What a CRC becomes when ``n`` bytes follow, by each of its four bytes: 4 x 256."""
    table = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None])
    if n >= 64:  # appending is linear, so half of the way twice
        half, rest = _append_table(n // 2), n - 2 * (n // 2)
        table = _through(half, _through(half, table))
        return _through(_append_table(rest), table) if rest else table
    step = _byte_table()
    for _ in range(n):
        table = step[table & 255] ^ (table >> 8)
    return table


def _through(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return (table[0][crc & 255] ^ table[1][(crc >> 8) & 255]
            ^ table[2][(crc >> 16) & 255] ^ table[3][crc >> 24])


class Words:
    """The words of some texts: place, line, text, length and CRC of each, in order."""

    def __init__(self, texts):
        data = "\n".join(texts).encode("utf-8", "surrogatepass")
        raw = np.frombuffer(data, dtype=np.uint8)
        points = raw | (((raw >= 65) & (raw <= 90)) << 5).astype(np.uint8)  # A-Z to a-z
        inside = (points >= 128) | ((points >= 97) & (points <= 122)) | ((points >= 48) & (points <= 57))
        edge = np.diff(inside.view(np.int8), prepend=0, append=0)
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.size = self.end - self.start
        self.line = np.searchsorted(np.flatnonzero(raw == 10), self.start)
        lines = np.cumsum([t.count("\n") + 1 for t in texts])
        self.text = np.searchsorted(lines, self.line, side="right")
        self.crc = self._hash(points)

    def _hash(self, points: np.ndarray) -> np.ndarray:
        table = _byte_table()
        register = np.full(len(self.size), 0xFFFFFFFF, dtype=np.uint32)
        order = np.argsort(self.size, kind="stable")  # words still running form a suffix
        start, size = self.start[order], self.size[order]
        held = register[order]
        for k in range(min(_STEPS, int(size[-1]) if len(size) else 0)):
            go = int(np.searchsorted(size, k, side="right"))
            r = held[go:]
            held[go:] = table[(r ^ points[start[go:] + k]) & 255] ^ (r >> 8)
        register[order] = held ^ np.uint32(0xFFFFFFFF)
        for n in np.flatnonzero(self.size > _STEPS).tolist():
            register[n] = zlib.crc32(points[self.start[n]:self.end[n]])
        return register

    def buckets(self) -> np.ndarray:
        return (self.crc % BUCKETS).astype(np.int64)

    def pair_buckets(self, first: np.ndarray) -> np.ndarray:
        """Buckets of the pairs of words ``first`` and the words after them."""
        left = self.crc[first]
        # the CRC of a word and one space after it
        register = left ^ np.uint32(0xFFFFFFFF)
        left = (_byte_table()[(register ^ np.uint32(32)) & 255] ^ (register >> 8)) ^ np.uint32(0xFFFFFFFF)
        size = self.size[first + 1]
        crc = np.empty(len(first), dtype=np.uint32)
        order = np.argsort(size, kind="stable")
        cuts = np.flatnonzero(np.diff(size[order], prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(order)]):
            own = order[a:b]
            crc[own] = _through(_append_table(int(size[own[0]])), left[own])
        return ((crc ^ self.crc[first + 1]) % BUCKETS).astype(np.int64)

    def pairs(self):
        """Numbers of the words that start a pair inside a line, and of those that
        start one across lines of a text."""
        near = np.flatnonzero(self.text[1:] == self.text[:-1])
        same = self.line[near + 1] == self.line[near]
        return near[same], near[~same]


def _lines_of(texts):
    """Distinct lines of ``texts``, and for every line of a text its text and number."""
    numbers: dict[str, int] = {}
    which, owner = [], []
    for k, text in enumerate(texts):
        lines = text.split("\n")
        which += [numbers.setdefault(line, len(numbers)) for line in lines]
        owner += [k] * len(lines)
    return list(numbers), np.array(which, dtype=np.int64), np.array(owner, dtype=np.int64)


def bucket_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``bucket``, ``n``: features of every bucket over all rows (buckets without any
    are missing). Null texts have none, repeated rows count again."""
    texts = df.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"))

    def fold(batches):
        for batch in slices(batches):
            every = batch.column(0).to_pylist()
            for a, b in text_slices(every, SLICE_CHARS):
                part = every[a:b]
                lines, which, _ = _lines_of(part)
                words = Words(part)
                _, across = words.pairs()
                bucket, n = np.unique(words.pair_buckets(across), return_counts=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array(lines + [None] * len(bucket), pa.string()),
                    pa.array(np.concatenate([np.full(len(lines), -1), bucket]).astype(np.int32)),
                    pa.array(np.concatenate([np.bincount(which, minlength=len(lines)), n]).astype(np.int64))],
                    names=["line", "bucket", "n"])

    def count(batches):
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in slices(batches):
            n = batch.column(2).to_numpy()
            bucket = batch.column(1).to_numpy()
            ready = bucket >= 0  # pairs across lines
            np.add.at(total, bucket[ready], n[ready])
            lines, n = batch.column(0).filter(pa.array(~ready)).to_pylist(), n[~ready]
            for a, b in text_slices(lines, SLICE_CHARS):
                words = Words(lines[a:b])  # every line is a text of its own here
                inside, _ = words.pairs()
                times = n[a:b]
                np.add.at(total, words.buckets(), times[words.text])
                np.add.at(total, words.pair_buckets(inside), times[words.text[inside]])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": at.astype(np.int32), "n": total[at]})

    distinct = (texts.mapInArrow(fold, "line string, bucket int, n long")
                .groupBy("line", "bucket").agg(F.sum("n").alias("n")).select("line", "bucket", "n"))
    return (distinct.mapInArrow(count, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(corpus: DataFrame, target: DataFrame, text_col: str = "text") -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of each of the B buckets, where
    s, t are its counts in ``corpus`` and ``target`` and S, T their totals."""
    counts = []
    for df in (corpus, target):
        table = [0] * BUCKETS
        for row in bucket_counts(df, text_col).collect():  # at most one row per bucket
            table[row["bucket"]] = row["n"]
        counts.append(table)
    s, t = counts
    big_s, big_t = float(sum(s) + BUCKETS), float(sum(t) + BUCKETS)
    return np.array([math.floor(1000 * math.log(float(b + 1) * big_s / (float(a + 1) * big_t)))
                     for a, b in zip(s, t)], dtype=np.int64)


def weigh(df: DataFrame, gain: np.ndarray, text_col: str = "text", drop=()) -> DataFrame:
    """``df`` with ``n_words``, ``n_features`` and ``weight`` (long): the floored mean of
    the gains over the features of a text, 0 for a null text or one without words.

    Other columns but ``drop`` and repeated rows stay; columns of these names are
    replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(gain)

    def prepare():
        gain = shared.value

        def compute(texts):
            texts = [t or "" for t in texts]
            n_words, n_features, weight = (np.zeros(len(texts), dtype=np.int64) for _ in range(3))
            for a, b in text_slices(texts, SLICE_CHARS):
                part = texts[a:b]
                lines, which, owner = _lines_of(part)
                words = Words(lines)  # every distinct line once
                inside, _ = words.pairs()
                own = np.zeros((3, len(lines)), dtype=np.int64)  # words, pairs, gains of a line
                np.add.at(own[0], words.text, 1)
                np.add.at(own[1], words.text[inside], 1)
                np.add.at(own[2], words.text, gain[words.buckets()])
                np.add.at(own[2], words.text[inside], gain[words.pair_buckets(inside)])
                total = np.zeros((3, len(part)), dtype=np.int64)
                for k in range(3):
                    np.add.at(total[k], owner, own[k][which])
                first, after = _across(words, which, owner)
                np.add.at(total[1], first, 1)
                np.add.at(total[2], first, gain[after])
                n_words[a:b] = total[0]
                n_features[a:b] = total[0] + total[1]
                weight[a:b] = total[2] // np.maximum(n_features[a:b], 1)
            return n_words, n_features, weight

        return compute

    return add_columns(df, [text_col], "n_words long, n_features long, weight long", prepare, drop=drop)


def _across(words: Words, which: np.ndarray, owner: np.ndarray):
    """Text and bucket of every pair of words across two lines of a text.

    ``words`` are those of the distinct lines; the lines of the texts with any word
    are laid one after another, and each hands its last word to the next.
    """
    lines = int(which.max()) + 1 if len(which) else 0
    n = np.bincount(words.text, minlength=lines)
    last = np.cumsum(n) - 1
    first = last - n + 1
    filled = np.flatnonzero(n[which] > 0)
    at, text = which[filled], owner[filled]
    pair = np.flatnonzero(text[1:] == text[:-1])
    left, right = last[at[pair]], first[at[pair + 1]]
    joint = _Joint(words, left, right)
    return text[pair], joint.buckets()


class _Joint(Words):
    """Pairs of any two words of another list: left, right, left, right, ..."""

    def __init__(self, words: Words, left: np.ndarray, right: np.ndarray):
        both = np.stack([left, right], axis=1).ravel()
        self.crc, self.size = words.crc[both], words.size[both]

    def buckets(self) -> np.ndarray:
        return self.pair_buckets(np.arange(0, len(self.crc), 2))


def draw_score(df: DataFrame, seed: int = 7, id_col: str = "doc_id") -> DataFrame:
    """``df`` (with ``weight``) with ``score``: weight plus Gumbel noise of the id, in
    thousandths, floored. A null id is hashed as the empty text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    return df.withColumn("score", F.col("weight") + noise)


COPIES = 1 << 20  # equal rows that a task numbers at once


def rank_drawn(df: DataFrame, percent: int = 25, min_words: int = 20, id_col: str = "doc_id",
               out: str = "rank") -> DataFrame:
    """``df`` (with ``n_words`` and ``score``) with ``rank``: the floor(percent * N / 100)
    best of the N rows with at least ``min_words`` words numbered from 1 by score
    descending, ties by id (null last), then by the other columns; null for all others.

    ``df`` is read three times, so it should be stored; its columns must be orderable.
    Scores are whole numbers in a range set by logarithms (some 10^5 values whatever
    the input), so a table of rows per score, which goes to the driver, gives the
    lowest score drawn and the number of rows before each score. Equal rows are folded
    to one with a count before they are ordered inside their score (the noise spreads
    different ids over scores, at most 1 in 2,700 has the same), and unfolded in pieces.
    """
    able = F.coalesce(F.col("n_words") >= min_words, F.lit(False))
    per_score = df.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()
    take = percent * sum(r["n"] for r in per_score) // 100
    before, seen = [], 0
    for row in sorted(per_score, reverse=True):
        if seen >= take:
            break
        before.append((row["score"], seen))
        seen += row["n"]
    if not before:
        return df.withColumn(out, F.lit(None).cast("bigint"))
    drawn = able & (F.col("score") >= before[-1][0])
    names = [c for c in df.columns if c != out]
    starts = df.sparkSession.createDataFrame(before, "__score long, __before long")
    order = [F.col(id_col).asc_nulls_last(), *(F.col(c).asc_nulls_last() for c in names)]
    earlier = Window.partitionBy("score").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    folded = df.where(drawn).groupBy(*names).agg(F.count(F.lit(1)).alias("__copies"))
    placed = (folded.withColumn("__first", F.coalesce(F.sum("__copies").over(earlier), F.lit(0)))
              # at most one row per score drawn
              .join(F.broadcast(starts), F.col("score") == F.col("__score"))
              .withColumn("__first", F.col("__first") + F.col("__before"))
              .withColumn("__piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__copies") - 1,
                                                          F.lit(COPIES).cast("bigint"))))
              .repartition("__first", "__piece")
              .withColumn("__copy", F.explode(F.sequence(
                  F.col("__piece"), F.least(F.col("__piece") + COPIES, F.col("__copies")) - 1))))
    place = F.col("__first") + F.col("__copy") + 1
    return (placed.select(*names, F.when(place <= take, place).alias(out))
            .unionByName(df.where(~drawn).select(*names, F.lit(None).cast("bigint").alias(out))))


def resample(documents: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20,
             seed: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``documents``: ``id_col``, ``n_features``, ``weight``, ``score`` and
    ``rank`` (null: not drawn) of a draw without replacement towards ``target``.

    Runs jobs when called: the counts of both tables, then the scores (stored). Only
    the id and the text are read. Empty tables draw nothing; a null text has no
    features, weight 0 and no rank.
    """
    rows = documents.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
    gain = gains(documents.select(F.col(text_col).alias("text")), target.select(F.col(text_col).alias("text")))
    scored = stored(draw_score(weigh(rows, gain, drop=["text"]), seed, "__id"))
    ranked = rank_drawn(scored, percent, min_words, "__id")
    return ranked.select(F.col("__id").alias(id_col), "n_features", "weight", "score", "rank")


def oracle_sql(percent: int = 25, min_words: int = 20, seed: int = 7) -> str:
    """The draw over ``documents`` and ``benchmark`` in DuckDB, feature by feature; CRC-32 in
    arithmetic on the table of single bytes."""
    def features(table, key):
        return f"""
    SELECT {key} AS id, unnest(list_concat(w, list_transform(range(1, len(w)),
               lambda i: w[i] || ' ' || w[i + 1]))) AS f
    FROM (SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {table})"""

    return f"""
WITH RECURSIVE shifts(b, k, c) AS (
    SELECT b, 0, b FROM range(256) t(b) UNION ALL
    SELECT b, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM shifts WHERE k < 8),
bytes AS MATERIALIZED (SELECT list(c ORDER BY b) AS t FROM shifts WHERE k = 8),
d AS MATERIALIZED ({features("documents", "doc_id")}),
e AS MATERIALIZED ({features("benchmark", "item_id")}),
hashed AS MATERIALIZED (
    SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, strlen(f)),
                  lambda i: ('0x' || substr(hex(encode(f)), 2 * i + 1, 2))::BIGINT)),
               lambda r, x: xor(t[(xor(r, x) & 255) + 1], r // 256)), 4294967295) % {BUCKETS} AS bucket
    FROM (SELECT f FROM d UNION SELECT f FROM e), bytes),
s AS (SELECT bucket, count(*) AS n FROM d JOIN hashed USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM e JOIN hashed USING (f) GROUP BY bucket),
gain AS MATERIALIZED (
    SELECT b.bucket, CAST(floor(1000 * ln(
               CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * ((SELECT count(*) FROM d) + {BUCKETS})
               / (CAST(coalesce(s.n, 0) + 1 AS DOUBLE) * ((SELECT count(*) FROM e) + {BUCKETS})))) AS BIGINT) AS g
    FROM range({BUCKETS}) b(bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
weights AS (
    SELECT id, count(*) AS n, sum(g) AS total
    FROM d JOIN hashed USING (f) JOIN gain USING (bucket) GROUP BY id),
scored AS MATERIALIZED (
    SELECT doc_id, coalesce(n, 0) AS n_features,
           CAST(coalesce((total - ((total % n) + n) % n) // n, 0) AS BIGINT) AS weight
    FROM documents LEFT JOIN weights ON id = doc_id),
noisy AS MATERIALIZED (
    SELECT *, weight + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('{seed}:' || CAST(doc_id AS VARCHAR)), 1, 8))
               ::BIGINT + 0.5) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM scored),
able AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS total
    FROM noisy WHERE n_features >= {2 * min_words - 1})
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {percent} * total // 100 THEN place END AS rank
FROM noisy LEFT JOIN able USING (doc_id)"""
