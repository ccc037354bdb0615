"""Language ID, toxicity and quality: learning, scoring, edge rows, held-out accuracy."""

import numpy as np
import pytest

from cadenza.llm import lang_bayes, quality_rank, toxic_viterbi
from cadenza.llm.queries import op7_language_id, op9_toxic_viterbi, op10_quality_rank
from helpers import HAVE_TABLES, duck

SF_LARGER = "/root/testdata/sf0.01"
TEXTS = {
    "en": ["the cat and the dog went home", "this is the house that they built", "where are the others"],
    "de": ["der hund und die katze gehen nach hause", "das ist nicht das haus", "wo sind die anderen"],
}


def _labelled(spark):
    rows = [(i, t, lang, "x") for lang, texts in TEXTS.items() for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + [(90, None, "en", "x"), (91, "abc", None, "x")],
                                 "doc_id long, text string, lang string, label string")


def test_language_counts_match_brute_force(spark):
    model = lang_bayes.fit(_labelled(spark))
    assert model.labels == ["de", "en"]
    for k, lang in enumerate(model.labels):
        counts = np.zeros(lang_bayes.BUCKETS)
        for text in TEXTS[lang]:  # one text and one gram at a time
            framed = f" {text.lower()} "
            for order in lang_bayes.ORDERS:
                for at in range(len(framed) - order + 1):
                    counts[_bucket(framed[at:at + order])] += 1
        want = np.log((counts + 1) / (counts + 1).sum())
        assert np.allclose(model.log_prob[k], want)


def _bucket(gram):
    key = 0
    for c in gram:
        key = (key * (1 << 21) + ord(c)) % (1 << 64)
    mixed = lang_bayes.mix64(np.array([(key + len(gram)) % (1 << 64)], dtype=np.uint64))
    return int(mixed[0] % lang_bayes.BUCKETS)


def test_language_prediction_rows(spark):
    df = _labelled(spark)
    model = lang_bayes.fit(df)
    rows = [(1, "the dog", "q"), (1, "the dog", "q"), (2, None, "q"), (3, "", "q"), (4, "12 !", "q"),
            (None, "das haus", "q"), (6, "the cat " * 90_000, "q")]
    got = lang_bayes.predict(spark.createDataFrame(rows, "doc_id long, text string, score string"),
                             model).collect()
    assert sorted((r["doc_id"] or 0, r["lang_pred"]) for r in got) == [
        (0, "de"), (1, "en"), (1, "en"), (2, "und"), (3, "und"), (4, "und"), (6, "en")]
    assert all(0 <= r["score"] <= 1 and (r["score"] == 0) == (r["lang_pred"] == "und") for r in got)
    assert lang_bayes.fit(df.limit(0)) is None
    assert lang_bayes.predict(df, None).select("lang_pred").distinct().collect() == [("und",)]


def test_posterior_matches_brute_force(spark):
    model = lang_bayes.fit(_labelled(spark))
    texts = ["the dog", "das haus", "the haus 12", "ß", "x" * 500]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in lang_bayes.predict(rows, model).collect():
        framed = f" {row['text'].lower()} "
        total = [model.log_prior[k] + sum(model.log_prob[k][_bucket(framed[at:at + order])]
                                          for order in lang_bayes.ORDERS for at in range(len(framed) - order + 1))
                 for k in range(len(model.labels))]
        odds = np.exp(np.array(total) - max(total))
        assert row["lang_pred"] == model.labels[int(odds.argmax())]
        assert row["score"] == pytest.approx(odds.max() / odds.sum())


@pytest.mark.parametrize("block", [1, 2, 3, 7])
def test_any_number_of_labels(spark, monkeypatch, block):
    rng = np.random.default_rng(3)
    rows = [(i, "".join(rng.choice(list("abcdef"), 40, p=rng.dirichlet(np.ones(6)))), f"l{i % 7}") for i in range(70)]
    rows += [(70, None, "l0"), (71, "12", "l1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole = lang_bayes.fit(df)
    assert whole.later is None and len(whole.labels) == 7
    want = {r["doc_id"]: r for r in lang_bayes.predict(df, whole).collect()}
    monkeypatch.setattr(lang_bayes, "LABEL_BLOCK", block)
    model = lang_bayes.fit(df)
    assert [label for part in model.blocks() for label in part.labels] == whole.labels
    assert all(len(part.labels) <= block for part in model.blocks())
    got = lang_bayes.predict(df, model, drop=["text"])
    assert got.columns == ["doc_id", "lang", "lang_pred", "score"]
    for row in got.collect():
        assert row["lang_pred"] == want[row["doc_id"]]["lang_pred"]
        assert row["score"] == pytest.approx(want[row["doc_id"]]["score"])


def test_more_labels_than_a_block(spark):
    rows = [(i, f"word{i} " * 20, f"l{i:04d}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = lang_bayes.predict(df, lang_bayes.fit(df)).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) > 570


def test_columns_that_clash_in_another_case(spark):
    df = _labelled(spark).withColumnRenamed("label", "Score").selectExpr("*", "1 AS LANG_pred")
    got = lang_bayes.predict(df, lang_bayes.fit(df))
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    assert got.select("score").count() == 8


@pytest.fixture(scope="module")
def language(spark):
    words = "the idiot and a stupid moron went to the house of the loser while the pathetic clown sat"
    rows = [(i, words) for i in range(30)] + [(99, None), (100, "")]
    return toxic_viterbi.fit_language(spark.createDataFrame(rows, "doc_id long, text string"))


def test_language_model_is_normalised(language):
    assert language.shape == (toxic_viterbi.SYMBOLS,) * 3
    assert np.allclose(np.exp(language).sum(axis=2), 1.0, atol=0.05)


@pytest.mark.parametrize("text,want", [
    ("m0r0n", "moron"), ("l0s3r!", "loser!"), ("stuuuupid", "stupid"), ("i d i o t", "idiot"),
    ("m-o-r-o-n", "moron"), ("p4thetic cl0wn", "pathetic clown"), ("$tupid", "stupid"),
    ("plain words stay", "plain words stay"), ("in 1999 and 2,000", "in 1999 and 2,000"), ("", "")])
def test_restored_texts(language, text, want):
    assert toxic_viterbi.Restorer(language).text(text) == want


def test_viterbi_matches_all_paths(language):
    def cost(parts):
        x = y = 0
        total = 0.0
        for text, extra in parts:
            total += extra
            for c in text:
                z = toxic_viterbi._symbol(c)
                total -= language[x, y, z] if y or z else 0.0
                x, y = y, z
        return total - (language[x, y, 0] if y else 0.0)

    def paths(steps):
        return [[first, *rest] for first in steps[0] for rest in paths(steps[1:])] if steps else [[]]

    for token in ("1d10t", "m00r0n", "cl0w|n", "s t u p", "aaa1"):
        best = min(map(cost, paths(toxic_viterbi.lattice(token))))
        found = toxic_viterbi.restore(token, language)
        assert any("".join(t for t, _ in p) == found and abs(cost(p) - best) < 1e-9
                   for p in paths(toxic_viterbi.lattice(token)))


def test_toxicity_rows(spark, language):
    rng = np.random.default_rng(4)
    word = lambda: f"w{rng.integers(10**6)}"
    bad = ["moron", "idiot", "loser"]
    rows = [(i, " ".join([word() for _ in range(30)] + ([bad[i % 3], bad[(i + 1) % 3]] if i % 4 == 0 else [])))
            for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0), 7) for i in range(200)] + [(None, 1, 7), (3, None, 7)],
                                   "doc_id long, toxic int, text int")
    lexicon = toxic_viterbi.fit_lexicon(df, labels, language)
    tests = [(1, "such a m0r0n and an i d i o t", 0.1), (2, "a calm text", 0.1), (3, None, 0.1), (3, "", 0.1),
             (None, "moron idiot " * 40_000, 0.1)]
    got = toxic_viterbi.score(spark.createDataFrame(tests, "doc_id long, text string, score double"),
                              language, lexicon).collect()
    score = {(r["doc_id"], (r["text"] or "")[:9]): r["score"] for r in got}
    assert score[1, "such a m0"] > 0.5 and score[None, "moron idi"] > 0.5
    assert score[2, "a calm te"] == score[3, ""] == toxic_viterbi.BASE_SCORE
    none = toxic_viterbi.fit_lexicon(df, labels.limit(0), language)
    assert len(none.hashes) == 0
    assert {r["score"] for r in toxic_viterbi.score(df, language, none).collect()} == {
        toxic_viterbi.BASE_SCORE}


def test_quality_features_of_edge_texts(spark):
    rows = [(1, None, "f"), (2, "", "f"), (2, "", "f"), (3, " \n", "f"), (4, "word " * 50_000, "f"), (5, "é", "f")]
    got = quality_rank.featured(spark.createDataFrame(rows, "doc_id long, text string, features string"))
    assert all(len(r["features"]) == len(quality_rank.FEATURES) and np.isfinite(r["features"]).all()
               for r in got.collect())
    assert got.count() == 6
    together = quality_rank.features(["one two", "", "THREE!! four", "x" * 600_000])
    alone = np.concatenate([quality_rank.features([t]) for t in ["one two", "", "THREE!! four", "x" * 600_000]])
    assert np.allclose(together, alone)


def test_quality_training_ranks_pairs():
    rng = np.random.default_rng(5)
    labels = (rng.random(600) < 0.8).astype(int)
    rows = rng.standard_normal((600, 4)) + labels[:, None] * np.array([2.5, 0, -2.5, 0])
    ranking = quality_rank.train(rows, labels)
    logits = ranking.logits(rows)
    pairs = logits[labels == 1][:, None] > logits[labels == 0][None]
    assert pairs.mean() > 0.97
    assert (logits < 0).mean() == pytest.approx(1 - labels.mean(), abs=0.01)  # the quantile cut
    assert quality_rank.train(rows, np.ones(600)) is None


def test_quality_is_learned_from_every_labelled_text(spark):
    rng = np.random.default_rng(6)
    rows = rng.standard_normal((21_000, 2))
    for few, block_rows in ((0, 20_000), (1, 20_000), (0, 700), (1, 700)):  # a rare class too
        labels = (rng.random(len(rows)) < 0.7).astype(int)
        if few:
            labels[:] = few - 1
            labels[[5, 900, 20_500]] = few
        better = rows + labels[:, None] * np.array([2.0, -1.0])
        table = list(zip(range(len(rows)), better.tolist(), labels.tolist()))
        df = spark.createDataFrame(table, "doc_id long, features array<double>, quality int")
        got = quality_rank.fit(df.select("doc_id", "features"), df.select("doc_id", "quality"),
                               block_rows=block_rows)
        assert np.allclose(got.means, better.mean(axis=0)) and np.allclose(got.scales, better.std(axis=0))
        scores = (better - got.means) / got.scales @ got.weights
        assert got.cut == pytest.approx(np.quantile(scores, (labels == 0).mean()))
        whole = quality_rank.train(better, labels)
        assert np.corrcoef(scores, better @ (whole.weights / whole.scales))[0, 1] > 0.98
    # up to one block the fit is that of the local form
    small = quality_rank.fit(df.where("doc_id < 1000").select("doc_id", "features"),
                             df.select("doc_id", "quality"))
    assert np.allclose(small.weights, quality_rank.train(better[:1000], labels[:1000]).weights)


def test_quality_without_labels(spark):
    df = quality_rank.featured(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_rank.fit(df, none) is None
    assert quality_rank.score(df, None).collect()[0]["score"] == 0.5


@pytest.mark.skipif(not HAVE_TABLES, reason="test tables missing")
def test_queries_on_held_out_rows(spark):
    con = duck(SF_LARGER)
    lang = dict(con.execute("SELECT doc_id, lang FROM documents").fetchall())
    got = op7_language_id(spark, SF_LARGER).collect()
    assert len(got) == len(lang)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.98 * len(held)

    for query, column, least in ((op9_toxic_viterbi, "toxic", 0.9), (op10_quality_rank, "quality", 0.95)):
        label = dict(con.execute(f"SELECT doc_id, {column} FROM labels WHERE {column} IS NOT NULL").fetchall())
        got = query(spark, SF_LARGER).collect()
        assert len(got) == len(lang)
        assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in got)
        held = [r for r in got if r["held_out"] and r["doc_id"] in label]
        assert sum(r["predicted"] == label[r["doc_id"]] for r in held) >= least * len(held)
