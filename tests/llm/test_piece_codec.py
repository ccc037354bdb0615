"""Exact encoding and decoding against the sentencepiece library."""

import hashlib

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from cadenza.llm.piece_codec import Codec, Vocabulary, encode_decode
from cadenza.llm.queries import op2_sentencepiece, tokenizer_path
from helpers import HAVE_TABLES, SF, duck

TEXTS = ["", " ", "  a", "▁x", "a▁ b", "日本🙂 x", "\x00", "a  \n  b", " " * 77, "x" * 500,
         "aaaa" * 300, "  a", "1234567890" * 20, "a\r\n\tb", "ﬁ ￿", "naïve café — “quotes”…",
         "thandedble### theaou&&& ENUNG!!", "a" * 5000 + " " + "é" * 3000]


@pytest.fixture(scope="module")
def both():
    path = tokenizer_path()
    return Codec(Vocabulary.load(path)), sentencepiece.SentencePieceProcessor(model_file=path)


def _same(both, text):
    codec, library = both
    ids = library.encode(text, add_eos=True)
    assert codec.encode(text) == ids
    assert codec.decode(ids) == library.decode(ids)
    assert codec.round_trip(text) == (" ".join(map(str, ids)), library.decode(ids))


@pytest.mark.parametrize("text", TEXTS)
def test_edge_texts(both, text):
    _same(both, text)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60),
                 st.text(alphabet="▁ the anding.,\nSsx", max_size=80)))
def test_random_texts(both, text):
    if any(0xD800 <= ord(c) < 0xE000 for c in text):
        return
    _same(both, text)


def test_remembered_cuts_are_replaced_without_change(both, monkeypatch):
    from cadenza.llm import piece_codec
    monkeypatch.setattr(piece_codec, "CACHE_BYTES", 1200)
    for text in TEXTS * 2:
        _same(both, text)


def test_rows_nulls_and_extra_columns(spark, both):
    df = spark.createDataFrame(
        [(1, None, "k"), (2, "", "k"), (2, "", "k"), (None, "a b", "k")],
        "doc_id long, text string, __text string")
    got = encode_decode(df, tokenizer_path(), with_text=True).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["ids"], r["decoded"]) for r in got) == [
        (0, 3, " ".join(map(str, both[1].encode("a b", add_eos=True))), "a b"),
        (1, 1, "2", ""), (2, 1, "2", ""), (2, 1, "2", "")]
    assert encode_decode(df.limit(0), tokenizer_path()).count() == 0


@pytest.mark.skipif(not HAVE_TABLES, reason="test tables missing")
def test_query(spark, both):
    got = {r["doc_id"]: r for r in op2_sentencepiece(spark, SF).collect()}
    rows = duck().execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall()
    assert len(got) == len(rows)
    for i, text in rows:
        ids = both[1].encode(text, add_eos=True)
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(
            both[1].decode(ids).encode()).hexdigest()
