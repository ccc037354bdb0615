"""Scaled sketches, Poisson mixing, secret scans and the pipeline."""

import base64
import hashlib
import math
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from cadenza.llm import poisson_mix, scaled_sketch, secret_markov
from cadenza.llm.queries import op5_scaled_sketch, op6_secret_scan, op8_poisson_mix
from helpers import HAVE_TABLES, SF, duck

tables = pytest.mark.skipif(not HAVE_TABLES, reason="test tables missing")


# ---- scaled sketches ---------------------------------------------------------

def _hash(shingle):
    """The hash of one shingle, one code point after another."""
    key = 0
    for c in shingle:
        key = (key * scaled_sketch._BASE + ord(c) + 1) % (1 << 64)
    mixed = scaled_sketch.mix64(np.array([key], dtype=np.uint64))
    return int(mixed[0]) >> (64 - scaled_sketch.HASH_BITS)


def _sketch(text):
    size = scaled_sketch.SHINGLE
    text = text + "\x00" * (size - len(text)) if text else ""
    every = {_hash(text[k:k + size]) for k in range(len(text) - size + 1)}
    kept = {h for h in every if h < (1 << scaled_sketch.HASH_BITS) // scaled_sketch.SCALE}
    return sorted(kept or ({min(every)} if every else ()))


def test_sketches_match_brute_force(monkeypatch):
    monkeypatch.setattr(scaled_sketch, "SLICE_CHARS", 300)
    rng = random.Random(2)
    texts = ["", "a", "short", "exactly sixteen!", "é🙂" * 30] + [
        "".join(rng.choice("abcde fgh") for _ in range(n)) for n in (17, 100, 500, 2000)]
    got = scaled_sketch.sketches(texts)
    assert [s.tolist() for s in got] == [_sketch(t) for t in texts]
    assert all(scaled_sketch.from_string(scaled_sketch.to_string(s)).tolist() == s.tolist() for s in got)


def test_sketches_merge_and_estimate_containment():
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefghij ") for _ in range(60_000))
    whole, part = scaled_sketch.sketches([text, text[20_000:26_000]])
    assert scaled_sketch.likeness(whole, part) == 1.0
    left, right = scaled_sketch.sketches([text[:30_000], text[30_000 - scaled_sketch.SHINGLE + 1:]])
    assert np.union1d(left, right).tolist() == whole.tolist()
    half, = scaled_sketch.sketches([text[:3000] + "".join(rng.choice("klmnopqr") for _ in range(3000))])
    assert scaled_sketch.likeness(whole, half) == pytest.approx(0.5, abs=0.08)


def _edits(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for k, (i, text) in enumerate(rows):
        after, cut = rows[(k + 1) % len(rows)][1], len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(),
                    np.array(_sketch(text), dtype=np.uint64), np.array(_sketch(edited), dtype=np.uint64),
                    np.array(_sketch(after), dtype=np.uint64)))
    return out


def _check_edits(got, rows):
    want = _edits(rows)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    got = sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"],
                   r["near_edited"], r["near_next"]) for r in got), key=key)
    want = sorted(((i, n, sha, scaled_sketch.to_string(s), scaled_sketch.to_string(e),
                    scaled_sketch.likeness(s, e), scaled_sketch.likeness(s, a))
                   for i, n, sha, s, e, a in want), key=key)
    assert got == want


@pytest.mark.parametrize("count", [1, 2, 150])
def test_edits_match_brute_force(spark, count):
    rng = random.Random(count)
    rows = [(rng.randrange(10**9), "".join(rng.choice("abc d") for _ in range(rng.randrange(200))))
            for _ in range(count)]
    df = spark.createDataFrame([(i, t, 1, 1) for i, t in rows], "doc_id long, text string, id int, group int")
    _check_edits(scaled_sketch.fingerprint_edits(df).collect(), rows)


def test_edit_edge_rows(spark):
    rows = [(None, "first of all there is a row without an id"), (3, None), (3, None), (4, ""),
            (9, "some words and more words, 🙂 and more"), (9, "some words and more words, 🙂 and more"),
            (11, "z" * 100_000)]
    _check_edits(scaled_sketch.fingerprint_edits(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect(), rows)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert scaled_sketch.fingerprint_edits(empty).count() == 0


def _groups(spark, rows):
    laid = scaled_sketch.with_next(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    return sorted(r["count"] for r in laid.where("ahead = 0").groupBy("group").count().collect())


@pytest.mark.parametrize("ids", [
    [*range(3000), 10**15], [*range(0, 3000), *range(10**12, 10**12 + 40)], [2**62 + i for i in range(3000)]])
def test_groups_of_far_ids_are_even(spark, ids):
    rows = [(i, f"text {i}") for i in random.Random(4).sample(ids, len(ids))]
    sizes = _groups(spark, rows)
    assert sizes[-1] <= 2 * len(ids) / (4 * 4) or ids[0] >= 2**62  # doubles blur ids beyond 2**53
    _check_edits(scaled_sketch.fingerprint_edits(
        spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)


@pytest.mark.parametrize("heavy", [[None], [5], [None, 5, 900]])
def test_groups_of_one_id_are_cut_by_text(spark, heavy):
    rng = random.Random(9)
    text = lambda: "".join(rng.choice("abcdefghij é") for _ in range(30))
    rows = [(i, text()) for i in range(1000)] + [(i, text()) for i in heavy for _ in range(1000)]
    rows += [(i, None) for i in heavy] + [(heavy[0], "\x00"), (heavy[0], "a\x00b"), (heavy[0], "a")]
    rng.shuffle(rows)
    assert _groups(spark, rows)[-1] <= 2.5 * len(rows) / (4 * 4)
    _check_edits(scaled_sketch.fingerprint_edits(
        spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)


@tables
def test_op5_query(spark):
    _check_edits(op5_scaled_sketch(spark, SF).collect(),
                 duck().execute("SELECT doc_id, text FROM documents").fetchall())


# ---- Poisson mixing ----------------------------------------------------------

def _poisson_count(rate, doc, seed=poisson_mix.SEED):
    parts = max(1, math.ceil(rate / poisson_mix.PART_RATE))
    mean, total = rate / parts, 0
    for part in range(1, parts + 1):
        text = f"{seed}|{'' if doc is None else doc}|{part}"
        u = int(hashlib.md5(text.encode()).hexdigest()[:poisson_mix.HASH_DIGITS], 16) / 16.0 ** 12
        p = below = math.exp(-mean)
        k = 0
        while round(below, 12) <= u and k <= poisson_mix.LAST_COUNT:
            k += 1
            p *= mean / k
            below += p
            total += 1
    return total


def test_mix_matches_brute_force_and_target(spark):
    rows = [(i, "x" * (10 + i % 7), "hot" if i % 3 else f"s{i % 4}", 1, "p") for i in range(1500)]
    rows += [(5000, "tiny source text", "rare", 1, "p"), (5001, None, "void", 1, "p"),
             (None, "no id", None, 1, "p"), (7, "x" * 10, "hot", 1, "p"), (5002, "", "s0", 1, "p")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, parts int, mix_key string")
    got = poisson_mix.poisson_mix(df).collect()
    sizes = {}
    for _, text, source, *_ in rows:
        sizes[source] = sizes.get(source, 0) + len(text or "")
    full = [s for s, n in sizes.items() if n]
    rate = {s: round(1 / len(full) * sum(sizes.values()) / n, 9) if n else 0.0 for s, n in sizes.items()}
    want = []
    for i, text, source, *_ in rows:
        want += [(i, text, source, c + 1) for c in range(_poisson_count(rate[source], i))]
    assert sorted(((r["doc_id"], r["text"], r["source"], r["copy_no"]) for r in got), key=repr) == sorted(
        want, key=repr)
    keys = [r["mix_key"] for r in got]
    assert keys == sorted(keys)
    share = sum(len(r["text"]) for r in got if r["source"] == "hot") / sum(len(r["text"]) for r in got)
    assert share == pytest.approx(1 / len(full), abs=0.03)
    assert rate["rare"] > poisson_mix.PART_RATE  # several parts were drawn


def test_mix_weights_and_empty_table(spark):
    rows = [(i, "abcd", "ab"[i % 2]) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = poisson_mix.poisson_mix(df, {"a": 3.0}).collect()
    assert {r["source"] for r in got} == {"a"} and len(got) == pytest.approx(400, abs=60)
    assert poisson_mix.poisson_mix(df.limit(0)).count() == 0


@tables
def test_op8_query_matches_sql(spark):
    result = duck().execute(poisson_mix.oracle_sql())
    names = [d[0] for d in result.description]
    df = op8_poisson_mix(spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(repr, (tuple(r) for r in df.select(*names).collect()))) == sorted(
        map(repr, result.fetchall()))


# ---- secrets -----------------------------------------------------------------

_ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.ASCII)


def _base(text):
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def _random_texts():
    rng = random.Random(8)
    bits = ["token", "PassWord", "api_key", "apikey", "secret", " ", "  ", ":", "=", '"', "'", "abc", "12345678",
            "AKIA", "AKIAABCDEFGHIJKL", "deadbeef" * 4, "f" * 31, "é", "🙂", "\n", "passwd", "ſecret", "a.b-c/d+e=",
            "toKen=token=abcdefgh", "token=api_key:abcdefghi"]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(400)]


def _random_secret(n):
    return base64.b64encode(hashlib.sha512(str(n).encode()).digest()).decode()[:44].replace("/", "x")


def test_base_spans_match_brute_force(spark):
    texts = _random_texts() + ["", None]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = {r["doc_id"]: [tuple(s) for s in r["base"]] for r in secret_markov.base_spans(df).collect()}
    assert got == {i: _base(t or "") for i, t in enumerate(texts)}


@pytest.fixture(scope="module")
def chains(spark):
    rng = random.Random(9)
    part = ["customer", "Account", "address", "_number", "order", "Handler", "total", "internal", "verein", "heit"]
    rows = [(i, f"the {''.join(rng.choice(part) for _ in range(4))} and {hashlib.sha1(str(i).encode()).hexdigest()}")
            for i in range(300)]
    return secret_markov.fit(spark.createDataFrame(rows, "doc_id long, text string"))


def test_markov_spans(spark, chains):
    secret = _random_secret(1)
    rows = [(1, f"the key {secret} here"), (2, "an ordinaryInternal_customerAccountHandler name"),
            (3, f"token = {secret}"), (4, "customerAccountaddress"), (5, None), (6, ""), (6, ""),
            (7, "🙂 " + _random_secret(2))]
    got = secret_markov.scan(spark.createDataFrame(rows, "doc_id long, text string"), chains)
    spans = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in got.collect()}
    assert spans[1] == [(8, 3, 8 + len(secret))]
    assert spans[2] == spans[4] == spans[5] == spans[6] == []
    assert spans[3] == _base(f"token = {secret}")
    assert spans[7] == [(2, 3, 46)]
    assert got.count() == len(rows)


def test_pair_counts_match_brute_force(spark, chains):
    ratio = np.array(chains).reshape(128, 128)
    low, up = map(ord, ("e", "r"))
    assert ratio[ord("7"), ord("3")] > 1 and ratio[low, up] < 0


def test_redaction(spark, chains):
    hexes = "deadbeef" * 4
    rows = [(1, f"a token = {hexes} b {hexes}🙂c"), (2, None), (3, "clean"), (4, f"{hexes}")]
    found = secret_markov.scan(spark.createDataFrame(rows, "doc_id long, text string"), chains)
    got = {r["doc_id"]: r["text"] for r in secret_markov.redact(found).collect()}
    assert got == {1: "a [SECRET] b [SECRET]🙂c", 2: None, 3: "clean", 4: "[SECRET]"}


def test_secrets_of_empty_table(spark, chains):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert secret_markov.scan(df, secret_markov.fit(df)).count() == 0


@tables
def test_op6_query(spark):
    rows = duck().execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall()
    got = {r["doc_id"]: r for r in op6_secret_scan(spark, SF).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        base = _base(text)
        joined = ",".join(f"{secret_markov.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in secret_markov.KINDS[:3]] == [
            sum(s[1] == k for s in base) for k in range(3)]
        assert set(filter(None, joined.split(","))) <= set(got[i]["spans"].split(","))


# ---- pipeline ----------------------------------------------------------------

@tables
def test_pipeline_stages(spark):
    import sentencepiece
    from cadenza.llm.queries import tokenizer_path
    from test_near_duplicates import _brute

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    hexes = "deadbeef" * 4
    extra = spark.createDataFrame(
        [(90_001, None, "en", "src1", 0), (90_002, "", "en", "src1", 0), (90_003, "12 34 !!", "en", "src1", 8),
         (90_004, f"the house of the others with the token = {hexes} in it", "en", "src1", None)], docs.schema)
    rows = docs.unionByName(extra)
    tables = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in rows.collect()}
        out = stage(spark, rows, SF)
        tables[name] = out.collect()
        if name != "encode":
            assert out.columns == corpus_pipeline.COLUMNS
            assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        if name == "language_id":
            gone = set(before) - {r["doc_id"] for r in tables[name]}
            assert gone == {90_001, 90_002, 90_003}
            assert all(before[r["doc_id"]] == r for r in tables[name])
        elif name == "near_duplicates":
            want = _brute([(i, r["text"]) for i, r in before.items()])
            assert {r["doc_id"] for r in tables[name]} == {i for i, (_, c) in want.items() if i == c}
        elif name == "secrets":
            assert {r["doc_id"] for r in tables[name]} == set(before)
            for r in tables[name]:
                found = _base(before[r["doc_id"]]["text"])
                assert ("[SECRET]" in r["text"]) == bool(found) and not _base(r["text"])
                if found:
                    assert r["n_chars"] == len(r["text"])
                else:
                    assert r == before[r["doc_id"]]
        elif name == "mix_sources":
            assert {r["doc_id"] for r in tables[name]} <= set(before)
            assert all(before[r["doc_id"]] == r for r in tables[name])
        else:
            library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
            for r in tables[name]:
                ids = library.encode(before[r["doc_id"]]["text"], add_eos=True)
                assert r["n_tokens"] == len(ids)
                assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        rows = spark.createDataFrame(tables[name], out.schema)


@tables
def test_pipeline_run(spark):
    got = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(got.columns)
    assert got.count() > 0


def test_pipeline_returns_the_token_ids(spark):
    import sentencepiece
    from cadenza.llm.queries import tokenizer_path

    texts = {1: "the house of the others", 2: "", 3: None, 4: "日本🙂 x  \n y"}
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in texts.items()],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    got = {r["doc_id"]: r for r in corpus_pipeline.encode(spark, docs, "").collect()}
    for i, text in texts.items():
        assert got[i]["ids"] == library.encode(text or "", add_eos=True)
        joined = " ".join(map(str, got[i]["ids"]))
        assert got[i]["n_tokens"] == len(got[i]["ids"])
        assert got[i]["ids_sha256"] == hashlib.sha256(joined.encode()).hexdigest()


def test_pipeline_on_empty_documents(spark):
    rows = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, "")
        assert rows.count() == 0
