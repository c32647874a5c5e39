"""Latent embeddings and the grown lexicon on planted texts."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brightloom.operators import latent, lexicon, text


def vectors(df):
    return {r["t"]: np.array(r["embedding"]) for r in df.collect()}


@pytest.fixture(scope="module")
def topics(spark):
    """Two names of one thing never meet, but share their company; a third thing has company of its own."""
    rng = random.Random(1)
    company = {"car": "engine road wheel driver fuel brake garage".split(), "fruit": "tree sweet juice seed basket orchard market".split()}
    texts = []
    for _ in range(300):
        for name, of in (("car", "car"), ("automobile", "car"), ("banana", "fruit")):
            texts.append(" ".join(rng.sample([name] * 2 + rng.sample(company[of], 4), 6)))
    return spark.createDataFrame([(t,) for t in texts] + [(None,), ("",)], "t string")


def test_words_of_one_company_are_near(spark, topics):
    model = latent.fit_latent(topics, "t", dims=2, buckets=512)
    assert model.basis.shape == (512, 2)
    v = vectors(latent.embed_latent(spark.createDataFrame([("car",), ("automobile",), ("banana",), ("zzz unknown",), ("",), (None,)], "t string"), "t", model))
    assert v["car"] @ v["automobile"] > 0.9 > 0.3 > v["car"] @ v["banana"]
    assert np.linalg.norm(v["car"]) == pytest.approx(1, abs=1e-5) and not v[""].any() and not v[None].any()


def test_basis_is_that_of_the_decomposition(spark, topics):
    model = latent.fit_latent(topics, "t", dims=3, buckets=128, passes=8)
    rows = topics.select(latent._cells("t", 128).alias("c")).select("c.bucket", "c.tf").filter(F.size("bucket") > 0).toPandas()
    row, col, value = latent._sparse(rows["bucket"], rows["tf"], model.idf)
    dense = np.zeros((len(rows), 128))
    np.add.at(dense, (row, col), value)
    _, s, vt = np.linalg.svd(dense, full_matrices=False)
    got = np.linalg.norm(dense @ model.basis, axis=0)
    assert got == pytest.approx(s[:3], rel=1e-3)
    assert np.linalg.svd(vt[:3] @ model.basis)[1] == pytest.approx(np.ones(3), abs=0.01)


@pytest.mark.parametrize("filled", [0.02, 0.9])
def test_products_of_short_and_long_texts(filled):
    """Texts of few and of many terms are multiplied in different ways; buckets may come twice in a row, rows may be empty."""
    rng = np.random.default_rng(3)
    dense, basis, back = rng.random((40, 128)) * (rng.random((40, 128)) < filled), rng.normal(size=(128, 5)), np.ones((128, 5))
    dense[7] = 0
    row, col = np.nonzero(dense)
    value = dense[row, col]
    row, col, value = np.repeat(row, 2), np.repeat(col, 2), np.repeat(value / 2, 2)
    assert (len(row) >= latent._FULL * 40) == (filled > 0.5)
    assert latent._times(row, col, value, 40, basis, back) == pytest.approx(dense @ basis)
    assert back == pytest.approx(1 + dense.T @ dense @ basis)


def test_terms_are_counted_over_a_batch():
    got = latent._term_counts(pa.array([[5, -3, 5, 5], [], [5], [-3, -3]], pa.list_(pa.int64())), 4)
    assert [sorted(zip(*(x.tolist() for x in got)))] == [[(0, 1, 1.0), (0, 1, 3.0), (2, 1, 1.0), (3, 1, 2.0)]]
    assert [len(x) for x in latent._term_counts(pa.array([[], []], pa.list_(pa.int64())), 4)] == [0, 0, 0]
    assert list(latent._runs(pa.array([[1] * 3, [], [1] * 9, [1]]), 4, 2)) == [(0, 2), (2, 1), (3, 1)]


def test_latent_of_nothing(spark):
    none = spark.createDataFrame([], "t string")
    model = latent.fit_latent(none, "t", dims=4, buckets=64)
    assert not model.basis.any() and latent.embed_latent(none, "t", model).count() == 0


@pytest.fixture(scope="module")
def reviews(spark):
    rng = random.Random(2)
    good, bad = ["good", "great", "superb", "delightful", "sturdy"], ["bad", "terrible", "flimsy", "dreadful", "rusty"]
    things = [f"thing{i}" for i in range(30)]
    rows = []
    for _ in range(600):
        side = good if rng.random() < 0.5 else bad
        rows.append((f"{rng.choice(things)} was {rng.choice(side)} and {rng.choice(side)}. {rng.choice(things)} {rng.choice(things)}",))
    return spark.createDataFrame(rows + [(None,), ("",)], "t string")


def test_planted_words_get_their_sign(spark, reviews):
    words = lexicon.grown_lexicon(reviews, "t", {"good": 1.0, "bad": -1.0})
    assert all(words[w] > 0 for w in ("great", "superb", "delightful", "sturdy")) and all(words[w] < 0 for w in ("terrible", "flimsy", "dreadful", "rusty"))
    polar = [abs(v) for w, v in words.items() if w.startswith("thing")]
    assert max(polar, default=0.0) < min(abs(words[w]) for w in ("superb", "dreadful"))
    scored = {r["t"]: r["label"] for r in text.lexicon_sentiment(spark.createDataFrame([("a superb sturdy thing",), ("rusty and flimsy",)], "t string"), "t", words).collect()}
    assert scored == {"a superb sturdy thing": "POSITIVE", "rusty and flimsy": "NEGATIVE"}


def test_graph_weights(spark):
    df = spark.createDataFrame([("alpha beta",)] * 6 + [("alpha gamma",)] * 2 + [("beta delta. gamma delta",)] * 4, "t string")
    edges = {(r["a"], r["b"]): r["weight"] for r in lexicon.word_graph(df, "t", least=2, least_pairs=2).collect()}
    n = {("alpha", "beta"): 6, ("alpha", "gamma"): 2, ("beta", "delta"): 4, ("delta", "gamma"): 4}
    k = {"alpha": 8, "beta": 10, "gamma": 6, "delta": 8}
    want = {p: np.log(c * 32 / (k[p[0]] * k[p[1]])) for p, c in n.items()}
    want = {q: v for p, v in want.items() if v > 0 for q in (p, p[::-1])}
    assert edges == pytest.approx(want)


def test_lexicon_of_nothing(spark):
    none = spark.createDataFrame([], "t string")
    assert lexicon.grown_lexicon(none, "t", {"good": 1.0}) == {"good": 1.0}


@pytest.mark.parametrize("most", [1, 7, 1000])
def test_pairs_are_summed_inside_the_task(most):
    """Every pair within the window, over sentences of any length and batches of any size."""
    texts = [["b", "a", "b", "c"], ["a"], [], ["d", "d", "a", "c", "b", "a"], ["c", "a"]]
    batches = [pa.RecordBatch.from_arrays([pa.array(t, pa.list_(pa.string()))], ["w"]) for t in (texts[:2], texts[2:4], [], texts[4:])]
    wanted = Counter(tuple(sorted((x, y))) for t in texts for i, x in enumerate(t) for y in t[i + 1 : i + 3] if x != y)
    got = Counter()
    for out in lexicon._pair_counts(2, most)(iter(batches)):
        for r in out.to_pylist():
            got[r["a"], r["b"]] += r["n"]
    assert got == wanted


def test_summary_joins_rare_terms_alone(spark):
    """Scores do not hang on how many terms are broadcast."""
    rows = [(i, f"Common words stand here. Rare{chr(97 + i)} words follow common ones! Odd{chr(97 + i)} thing.") for i in range(9)] + [(90, None), (91, "")]
    df = spark.createDataFrame(rows, "id int, t string")
    whole = {(r["id"], r["rank"]): (r["position"], r["sentence"], round(r["score"], 9)) for r in text.extractive_summary(df, "id", "t", 2).collect()}
    for frequent in (1, 3):
        some = {(r["id"], r["rank"]): (r["position"], r["sentence"], round(r["score"], 9)) for r in text.extractive_summary(df, "id", "t", 2, frequent=frequent).collect()}
        assert some == whole and len(some) == 18


def test_themes_cache_no_tokens(spark, monkeypatch):
    seen, fit = [], text.LDA.fit
    monkeypatch.setattr(text.LDA, "fit", lambda self, data: (seen.append((data.columns, data.storageLevel.useMemory)), fit(self, data))[1])
    df = spark.createDataFrame([(i, "apple pear plum" if i % 2 else "engine wheel brake") for i in range(20)], "id int, t string")
    assert text.theme_extraction(df, "id", "t", themes=2, steps=2).agg({"n_texts": "sum"}).first()[0] == 20
    assert seen == [(["id", "features"], True)]
