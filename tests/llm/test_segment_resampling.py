"""Resampling by segments against a plain count of every feature."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cadenza.llm import segment_resampling as sr
from cadenza.llm.queries import ORACLE_SQL, op11_segment_resampling
from helpers import HAVE_TABLES, SF, duck

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def bucket(feature):
    return zlib.crc32(feature.encode()) % sr.BUCKETS


def brute(docs, target, percent=25, min_words=20, seed=7):
    """[(id, n_features, weight, score, rank)] of rows (id, text)."""
    s = Counter(bucket(f) for _, t in docs for f in features(t))
    t = Counter(bucket(f) for text in target for f in features(text))
    big_s, big_t = sum(s.values()), sum(t.values())
    out = []
    for i, text in docs:
        own = [math.floor(1000 * math.log(float(t[b] + 1) * (big_s + sr.BUCKETS)
                                          / (float(s[b] + 1) * (big_t + sr.BUCKETS))))
               for b in map(bucket, features(text))]
        weight = sum(own) // len(own) if own else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(own), weight, score, None])
    able = sorted((r for r in out if (r[1] + 1) // 2 >= min_words),
                  key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for n, r in enumerate(able[:percent * len(able) // 100], 1):
        r[4] = n
    return sorted(map(tuple, out), key=repr)


def _docs(n=300):
    rng = random.Random(5)
    words = ["a", "Bb", "tOp", "été", "日本", "x1", "z" * 40, "q" * 5000, "ÀB", "7", "word"]
    seps = [" ", "\n", "\n\n", ", ", "\t", "-", "\r\n", " \n "]
    lines = ["shared line of Words", "", "---", "a"]
    docs = []
    for i in range(n):
        parts = [rng.choice(words[:9] if i % 50 else words) if rng.random() < .8 else rng.choice(lines)
                 for _ in range(rng.randint(0, 60))]
        docs.append((i, "".join(p + rng.choice(seps) for p in parts)))
    docs += [(n, None), (n + 1, ""), (n + 2, "\n\n\n"), (n + 3, "!!! ---"), (None, "a b " * 30)]
    return docs + [(7, docs[7][1])] * 60 + [(n + 4 + i, docs[3][1]) for i in range(50)]


TARGET = ["a Bb tOp word\nword shared line", None, "日本 x1 x1", ""]


def test_equals_plain_count(spark, monkeypatch):
    monkeypatch.setattr(sr, "COPIES", 7)
    monkeypatch.setattr(sr, "SLICE_CHARS", 3_000)
    docs = _docs()
    df = spark.createDataFrame([(i, t, 1, "w") for i, t in docs], "doc_id long, text string, n long, weight string")
    target = spark.createDataFrame([(1, t) for t in TARGET], "item_id long, text string")
    got = sr.resample(df.repartition(5), target)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, TARGET)


def test_counts_of_lines_and_pairs_across(spark):
    texts = ["a b\nc", "a b\n\n!\nc d", "a b", None, "", "\n"]
    got = {r["bucket"]: r["n"] for r in sr.bucket_counts(
        spark.createDataFrame([(t,) for t in texts], "text string")).collect()}
    assert got == Counter(bucket(f) for t in texts for f in features(t))


@pytest.mark.parametrize("n", [1, 2, 7, 63, 64, 65, 200, 4097])
def test_appended_crc(n):
    import numpy as np

    rng = random.Random(n)
    left, right = rng.randbytes(9), rng.randbytes(n)
    joint = sr._through(sr._append_table(n), np.array([zlib.crc32(left)], dtype=np.uint32))[0]
    assert int(joint) ^ zlib.crc32(right) == zlib.crc32(left + right)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c " * 20)], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in sr.resample(docs, none).collect()] == brute([(1, "a b c " * 20)], [])
    assert sr.resample(docs.limit(0), none).count() == 0


@pytest.mark.skipif(not HAVE_TABLES, reason="test tables missing")
def test_query_equals_sql_and_plain_count(spark):
    table = op11_segment_resampling(spark, SF)
    con = duck()
    names = ["doc_id", "n_features", "weight", "score", "rank"]
    got = sorted((tuple(r) for r in table.select(names).collect()), key=repr)
    docs = con.execute("SELECT doc_id, text FROM documents").fetchall()
    target = [r[0] for r in con.execute("SELECT text FROM benchmark").fetchall()]
    assert got == brute(docs, target)
    result = con.execute(ORACLE_SQL["op11_segment_resampling"])
    assert [d[0] for d in result.description] == names
    assert got == sorted(result.fetchall(), key=repr)
    assert {t for _, t in table.dtypes} == {"bigint"}
    assert table.where(F.col("rank").isNotNull()).count() > 0
