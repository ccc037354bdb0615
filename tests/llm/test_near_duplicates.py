"""Components, HyperMinHash near-duplicates and the subspace join against brute force."""

import random

import numpy as np
import pytest

from cadenza.llm import hyperminhash, subspace_join
from cadenza.llm.components import components
from cadenza.llm.queries import op3_subspace_join, op4_hyperminhash
from cadenza.llm.word_shingles import shingle_sets
from helpers import HAVE_TABLES, SF, Union, duck


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(i, i + 1) for i in range(40)], [(50 - i, 49 - i) for i in range(40)],
    [(7, i) for i in range(30)] + [(100, 101), (101, 100)],
    [(random.Random(3).randrange(60), random.Random(i).randrange(60)) for i in range(50)]])
def test_components(spark, edges):
    union = Union()
    for a, b in edges:
        if a != b:
            union.join(a, b)
    df = spark.createDataFrame(edges + [(None, 3)], "a long, b long")
    got = {r["id"]: r["component"] for r in components(df).collect()}
    assert got == {x: union.find(x) for x in union.up}


def _words(text):
    words = (text or "").encode().lower().split()
    return (frozenset(tuple(words[k:k + 5]) for k in range(len(words) - 4)) if len(words) >= 5
            else frozenset([tuple(words)] if words else []))


def _brute(rows):
    sets, union = [(i, _words(t)) for i, t in rows], Union()
    for k, (i, a) in enumerate(sets):
        union.find(i)
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                union.join(i, j)
    return {i: (len(s), union.find(i)) for i, s in sets}


def test_shingle_sets_match_words():
    texts = ["", None, " \t\n", "One two", "one\x0btwo", "a b c d e", "A B C D E f a b c d e",
             "é à ü x y z w", "x " * 3000, "one two three four"]
    got = shingle_sets(texts)
    assert [len(s) for s in got] == [len(_words(t)) for t in texts]
    assert got[3].tolist() == got[4].tolist()
    assert all((np.diff(s.astype(object)) > 0).all() for s in got if len(s) > 1)


def _edited(source, rng, share):
    words = source.split()
    for _ in range(max(1, int(len(words) * share))):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_near_duplicates_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hyperminhash, "BLOCK", 8)  # several comparison blocks
    rng = random.Random(1)
    base = [" ".join(f"w{rng.randrange(3000)}" for _ in range(n)) for n in (5, 12, 60, 200, 200, 900)]
    texts = []
    for text in base:
        texts += [text, text.upper(), text] + [_edited(text, rng, s) for s in
                                               (0.005, 0.01, 0.02, 0.03, 0.04, 0.05) for _ in range(8)]
    texts += [text + " tail words here" for text in base] + ["", None, "  \n", "one", "ONE", "one two"]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, id int, key int")
    got = {r["doc_id"]: r for r in hyperminhash.near_duplicates(df).collect()}
    want = _brute(rows)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_near_duplicates_edge_rows(spark):
    text = "a b c d e f g h"
    rows = [(1, text), (1, text), (None, text), (None, None), (5, text), (6, ""), (7, None)]
    got = sorted(hyperminhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect(), key=repr)
    assert sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0, r["kept"]) for r in got) == [
        (0, 0, 0, True), (0, 4, 0, True), (1, 4, 1, True), (1, 4, 1, True), (5, 4, 1, False),
        (6, 0, 6, True), (7, 0, 7, True)]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert hyperminhash.near_duplicates(empty).count() == 0


def test_registers_estimate_similarity():
    rng = np.random.default_rng(0)
    for n, shared in ((40, 30), (500, 400), (5000, 2500)):
        got = []
        for _ in range(60):
            pool = rng.integers(0, 1 << 63, 2 * n - shared, dtype=np.uint64) * np.uint64(2)
            a, b = np.unique(pool[:n]), np.unique(pool[n - shared:])
            same = (hyperminhash.registers(a) == hyperminhash.registers(b)).mean()
            got.append(hyperminhash.estimate(same, np.array(n), np.array(n)))
        assert np.mean(got) == pytest.approx(shared / (2 * n - shared), abs=0.04)


@pytest.mark.skipif(not HAVE_TABLES, reason="test tables missing")
def test_op4_query(spark):
    rows = duck().execute("SELECT doc_id, text FROM documents").fetchall()
    got = op4_hyperminhash(spark, SF).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == _brute(rows)


def _brute_vectors(rows):
    union, links = Union(), {}
    usable = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v and None not in v
              and np.isfinite(v).all() and np.any(np.array(v) != 0)]
    for i, _ in rows:
        union.find(i)
        links[i] = 0
    for k, (i, a) in enumerate(usable):
        for j, b in usable[:k]:
            if len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.95:
                union.join(i, j)
                links[i] += 1
                links[j] += 1
    return {i: (links[i], union.find(i)) for i, _ in rows}


@pytest.mark.parametrize("members,probes,cell", [(1024, 4096, 1600), (16, 16, 20)])
def test_subspace_join_matches_brute_force(spark, monkeypatch, members, probes, cell):
    monkeypatch.setattr(subspace_join, "MEMBERS", members)
    monkeypatch.setattr(subspace_join, "PROBES", probes)
    monkeypatch.setattr(subspace_join, "CELL", cell)
    rng = np.random.default_rng(2)
    vectors = []
    for size in (12, 12, 12, 3, 1):
        base = rng.standard_normal(size)
        near = [base + rng.standard_normal(size) * s for s in np.linspace(0.02, 0.4, 40)]
        vectors += [base, base, 3 * base, *near, *rng.standard_normal((30, size))]
    vectors = [v.astype(np.float32).tolist() for v in vectors]
    vectors += [[0.0] * 12, None, [], [1.0, None, 2.0], [float("nan")] * 3, [float("inf"), 1.0, 1.0]]
    rows = list(enumerate(vectors))
    df = spark.createDataFrame([(i, v, 1) for i, v in rows],
                               "vec_id long, embedding array<float>, size int")
    got = {r["vec_id"]: r for r in subspace_join.near_duplicates(df).collect()}
    assert {i: (r["n_links"], r["component_id"]) for i, r in got.items()} == _brute_vectors(rows)
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_many_vector_lengths(spark):
    rng = np.random.default_rng(8)
    vectors = [v for size in range(1, 71) for base in [rng.standard_normal(size)]
               for v in (base, base + 0.01 * rng.standard_normal(size), rng.standard_normal(size))]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in subspace_join.near_duplicates(df).collect()}
    assert got == _brute_vectors(rows)


def test_subspace_join_edge_rows(spark):
    schema = "vec_id long, embedding array<float>"
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (4, None)]
    got = subspace_join.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0, r["kept"]) for r in got) == [
        (0, 0, 0, True), (1, 1, 1, True), (1, 1, 1, True), (4, 0, 4, True)]
    assert subspace_join.near_duplicates(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.skipif(not HAVE_TABLES, reason="test tables missing")
def test_op3_query(spark):
    rows = duck().execute("SELECT vec_id, embedding FROM embeddings").fetchall()
    got = op3_subspace_join(spark, SF).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == _brute_vectors(rows)
