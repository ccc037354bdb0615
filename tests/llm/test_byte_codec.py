"""Exact byte-level encoding and decoding against the tiktoken library."""

import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from cadenza.llm import byte_codec
from cadenza.llm.queries import op13_byte_bpe, tokenizer_path
from helpers import HAVE_TABLES, SF, duck

PATH = tokenizer_path("byte_bpe_50k.tiktoken")
TEXTS = ["", " ", "  a", "a  ", " 's", "x's's 'sabc ''s I'll we're they've 'lla", " \n a\t\tb  c", "'", "''",
         "a'", "a 'b", "123 abc4 5", "!!! ...\n\n\nx", "日本語 テスト🙂🙂 é́", "x" * 3000, " " * 500 + "a",
         "\0a\0 \0", "a 　b\u0085 ", "ab" * 2000 + " " + "!" * 999, "ß'S 'Re'VE٣½Ⅷ", "﻿a​ b"]


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return byte_codec.ByteCodec(byte_codec.load_ranks(PATH))


def _same(codec, library, text):
    ids = codec.encode(text).tolist()
    assert ids == library.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


@pytest.mark.parametrize("text", TEXTS)
def test_edge_texts(codec, library, text):
    _same(codec, library, text)


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(st.characters(exclude_categories=["Cs"]), max_size=60),
                 st.text(alphabet="  \n\t'stmdrevl1a!é 　日", max_size=60)))
def test_random_texts(codec, library, text):
    _same(codec, library, text)


def test_many_texts_at_once(codec, library):
    ids, bounds = codec.encode_slice(TEXTS * 3)
    for k, text in enumerate(TEXTS * 3):
        assert ids[bounds[k]:bounds[k + 1]].tolist() == library.encode_ordinary(text)


def test_every_code_point(codec, library):
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    for start in range(0, len(points), 40_000):
        text = "".join(f"a{chr(p)} {chr(p)}" for p in points[start:start + 40_000])
        assert codec.encode(text).tolist() == library.encode_ordinary(text)


def test_long_texts_and_small_cache(codec, library, monkeypatch):
    monkeypatch.setattr(byte_codec, "LONG_CHARS", 300)
    monkeypatch.setattr(byte_codec, "SLICE_CHARS", 100)
    monkeypatch.setattr(byte_codec, "CACHE_BYTES", 2_000)
    text = " ".join(TEXTS) * 4
    assert len(list(byte_codec._parts(text))) > 5
    _same(codec, library, text)
    got = {}
    for number, ids in codec.encode_texts([text, "", "b c", text]):
        got.setdefault(number, []).extend(ids.tolist())
    want = [library.encode_ordinary(t) for t in (text, "", "b c", text)]
    assert [got[k] for k in range(4)] == want


def test_offsets_point_into_the_text(codec):
    text = "naïve 日本🙂 don't"
    ids = codec.encode(text)
    at = [*codec.offsets(ids).tolist(), len(text.encode())]
    assert [text.encode()[a:b] for a, b in zip(at, at[1:])] == [codec.decode([i]) for i in ids]


def test_scan_is_the_machine_step_by_step():
    import numpy as np

    step, _ = byte_codec._machine()
    generators, _, maps = byte_codec._monoid()
    symbols = np.random.default_rng(1).integers(0, 9, 70_001)
    got = maps[byte_codec._scan(generators[symbols]), 0]
    state, want = 0, []
    for s in symbols.tolist():
        state = int(step[s, state])
        want.append(state)
    assert got.tolist() == want


def test_rows_nulls_and_extra_columns(spark, library):
    df = spark.createDataFrame(
        [(1, None, "k", 7), (2, "", "k", 7), (2, "", "k", 7), (None, "a b", "k", 7)],
        "doc_id long, text string, __text string, ids int")
    got = byte_codec.encode(df, PATH)
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["ids"], r["offsets"]) for r in got.collect()) == [
        (0, 2, library.encode_ordinary("a b"), [0, 1]), (1, 0, [], []), (2, 0, [], []), (2, 0, [], [])]
    back = byte_codec.decode(got, PATH).collect()
    assert sorted(bytes(r["decoded"]) for r in back) == [b"", b"", b"", b"a b"]
    odd = spark.createDataFrame([(None,), ([-1],), ([50256],), ([1, None],), ([],)], "ids array<int>")
    assert [r["decoded"] for r in byte_codec.decode(odd, PATH).collect()] == [None] * 4 + [b""]
    assert byte_codec.encode_decode(df.limit(0), PATH).count() == 0


@pytest.mark.skipif(not HAVE_TABLES, reason="test tables missing")
def test_query(spark, library):
    got = {r["doc_id"]: r for r in op13_byte_bpe(spark, SF).collect()}
    rows = duck().execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall()
    assert len(got) == len(rows)
    for i, text in rows:
        ids = library.encode_ordinary(text)
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(library.decode_bytes(ids)).hexdigest()
