"""Secret scans: fixed patterns, and Markov models of random strings and identifiers.

All of it is DataFrame expressions. The fixed patterns give the base spans.
Beside them every long run of token characters outside base spans is scored by
the log-likelihood ratio of two first-order character chains, one of random
strings and one of ordinary identifiers; runs well above it are spans of their
own (``markov``).

The chains are counted over every text: random strings are the tokens that hold
a base secret and one base64 digest per text, ordinary ones are all other long
tokens. What reaches the driver is one count per character pair and label, at
most 2 x ``len(ALPHABET)`` ** 2 rows.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the base patterns
ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ASSIGN_LENGTH = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"  # a run of at least 16 in all: shorter runs hold no other
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = string.ascii_letters + string.digits + "+/_=-"
TRAIN_TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
SCORE_TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
MIN_RATIO = 15.0  # nats over the whole token
MIN_MEAN = 0.6  # nats per character pair
SMOOTHING = 0.5  # added to the count of each character
FALLBACK = 4.0  # weight of the second character alone in the pair's share
SPAN = "array<struct<start:int,kind:int,end:int>>"


def _spans(text: Column, hits: Column, values: Column | None, pattern: str, kind: int,
           least: int = 0) -> Column:
    """Spans of ``hits`` of ``pattern``: the pieces between them give the offsets."""
    pieces = F.slice(F.split(text, pattern, -1), 1, F.size(hits))
    rows = F.arrays_zip(pieces.alias("piece"), hits.alias("hit"),
                        (hits if values is None else values).alias("value"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def step(acc, row):
        begin = acc["at"] + F.length(row["piece"])
        end = begin + F.length(row["hit"])
        own = F.array(F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(F.length(row["value"]) >= least, F.concat(
            acc["spans"], own)).otherwise(acc["spans"]).alias("spans"))

    found = F.aggregate(rows, start, step, lambda acc: acc["spans"])
    return F.when(F.size(hits) == 0, F.array().cast(SPAN)).otherwise(found)


def base_spans(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with ``base``: sorted (start, kind, end) of the fixed patterns.

    Per kind leftmost non-overlapping matches in code points, end exclusive; a
    null text has none.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (df.withColumn("__assign", F.regexp_extract_all(text, F.lit(ASSIGN), 0))
            .withColumn("__access", F.regexp_extract_all(text, F.lit(ACCESS), 0))
            .withColumn("__hex", F.regexp_extract_all(text, F.lit(HEX), 0))
            .withColumn("base", F.array_sort(F.concat(
                _spans(text, F.col("__assign"), F.regexp_extract_all(text, F.lit(ASSIGN), 2),
                       ASSIGN, 0, ASSIGN_LENGTH),
                _spans(text, F.col("__access"), None, ACCESS, 1),
                _spans(text, F.col("__hex"), None, HEX, 2))))
            .drop("__assign", "__access", "__hex"))


def fit(df: DataFrame, text_col: str = "text") -> list[float]:
    """Log-likelihood ratio of each character pair, indexed by 128 * first + second."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = F.concat_ws("|", F.lit(HEX), F.lit(ACCESS))
    tokens = df.select(
        F.regexp_extract_all(text, F.lit(TRAIN_TOKEN), 0).alias("tokens"),
        F.regexp_extract_all(text, F.lit(ASSIGN), 2).alias("assigned"),
        F.regexp_replace(F.base64(F.unhex(F.sha2(text, 256))), "=", "").alias("digest"))
    labelled = tokens.select(F.explode(F.concat(
        F.transform("tokens", lambda t: F.struct(
            t.alias("token"), (F.regexp_like(t, base) | F.array_contains(
                F.col("assigned"), t)).alias("random"))),
        F.array(F.struct(F.col("digest").alias("token"), F.lit(True).alias("random"))))).alias("s"))
    counts = (labelled.select("s.random", F.col("s.token").alias("token"), F.explode(
        F.sequence(F.lit(1), F.length("s.token") - 1)).alias("at"))
        .groupBy("random", F.substring("token", F.col("at"), F.lit(2)).alias("pair"))
        .count().collect())
    chains = {}
    for label in (True, False):
        pairs = {r["pair"]: r["count"] for r in counts if r["random"] == label}
        seconds = {c: SMOOTHING for c in ALPHABET}
        firsts = dict.fromkeys(ALPHABET, 0)
        for pair, n in pairs.items():
            firsts[pair[0]] += n
            seconds[pair[1]] += n
        every = sum(seconds.values())
        chains[label] = [[0.0] * 128 for _ in range(128)]
        for a in ALPHABET:
            for b in ALPHABET:  # a pair unseen so far falls back on its second character
                own = pairs.get(a + b, 0) + FALLBACK * seconds[b] / every
                chains[label][ord(a)][ord(b)] = math.log(own / (firsts[a] + FALLBACK))
    return [chains[True][a][b] - chains[False][a][b] for a in range(128) for b in range(128)]


def _ratio(token: Column, model: list[float]) -> Column:
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in model)), ",").cast("array<double>")
    codes = F.transform(F.split(token, ""), lambda c: F.ascii(c))
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))

    def step(acc, code):
        gain = F.when(acc["last"] < 0, F.lit(0.0)).otherwise(F.get(table, acc["last"] * 128 + code))
        return F.struct(code.alias("last"), (acc["sum"] + gain).alias("sum"))

    return F.aggregate(codes, start, step, lambda acc: acc["sum"])


def scan(df: DataFrame, model: list[float], text_col: str = "text") -> DataFrame:
    """``df`` with ``base`` and ``spans``: base spans and scored tokens, sorted.

    Columns ``base`` and ``spans`` of the input are replaced; rows, repeated ones
    too, and other columns stay. A null or empty text has no spans. Scored spans
    never overlap a base span.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = (base_spans(df.drop("base", "spans"), text_col)
             .withColumn("__long", F.regexp_extract_all(text, F.lit(SCORE_TOKEN), 0))
             .withColumn("__at", _spans(text, F.col("__long"), None, SCORE_TOKEN, 3)))

    def random(row):
        span, token = row["0"], row["1"]
        free = ~F.exists("base", lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))
        ratio = _ratio(token, model)
        return free & (ratio >= F.greatest(F.lit(MIN_RATIO), (F.length(token) - 1) * MIN_MEAN))

    pairs = F.filter(F.arrays_zip(F.col("__at").alias("0"), F.col("__long").alias("1")), random)
    return (found.withColumn("spans", F.array_sort(F.concat(
        "base", F.transform(pairs, lambda row: row["0"]))))
        .drop("__long", "__at"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])))


def redact(df: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``text_col`` with each span of ``spans`` replaced by ``mark``.

    Overlapping spans are replaced together, once; a text without spans stays as
    it is, null included.
    """
    text = F.col(text_col)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc, s):
        part = F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(
            s["start"] >= acc["at"], F.concat(acc["parts"], F.array(part))).otherwise(
            acc["parts"]).alias("parts"))

    whole = F.aggregate("spans", start, step, lambda acc: F.concat(
        F.array_join(acc["parts"], ""), F.substring(text, acc["at"] + 1, F.length(text))))
    return df.withColumn(text_col, F.when(F.size("spans") > 0, whole).otherwise(text))
