"""Trained text operators: held-out accuracy, exact counts and defined results for odd rows."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from brightloom.llm import language_id, line_quality, toxicity
from brightloom.plans.common import table

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, __toxicity double, __language string"
ODD = [(1, None), (2, ""), (3, "  \n\t "), (4, "12345 !!!"), (5, "x"), (None, "the and of"), (7, "a b c " * 60000), (7, "a b c " * 60000)]


def odd(spark):
    return spark.createDataFrame([(i, t, None, "s", 0.5, "zz") for i, t in ODD], SCHEMA)


def test_language_accuracy_on_held_out_texts(spark):
    docs = table(spark, SF, "documents")
    got = language_id.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out AND lang IS NOT NULL")
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 150 and right > 0.97
    assert got.filter("score < 0 OR score > 1").count() == 0


def test_language_of_odd_rows(spark):
    train = table(spark, SF, "documents").select("doc_id", "text", "lang", "source", F.lit(0.0).alias("__toxicity"), F.lit("").alias("__language"))
    got = language_id.identify_languages(train.unionByName(odd(spark).withColumn("doc_id", -F.col("doc_id") - 1)))
    rows = {r["doc_id"]: r for r in got.filter("doc_id < 0 OR doc_id IS NULL").collect()}
    assert {rows[-i - 1]["lang_pred"] for i in (1, 2, 3, 4)} == {"und"} and rows[-2]["score"] == 0
    assert rows[None]["lang_pred"] == "en"
    empty = language_id.identify_languages(odd(spark).limit(0))
    assert empty.count() == 0
    assert {r["lang_pred"] for r in language_id.identify_languages(odd(spark)).collect()} == {"und"}
    assert language_id.drop_unidentified(odd(spark)).count() == len(ODD)
    kept = language_id.drop_unidentified(train.unionByName(odd(spark)))
    assert kept.columns == train.columns and train.count() <= kept.count() + 5 < train.count() + len(ODD) + 5


def test_long_texts_are_counted_whole():
    model = (("a", "b"), np.log(np.array([[0.6, 0.4]] * 64 + [[1.0, 1.0]])), np.zeros(2))
    text = "word " * ((1 << 18))
    want = sum((ids < 64).sum() for codes, room, _ in [(language_id._codes(text), np.arange(len(text), 0, -1), None)] for ids in language_id._gram_ids(codes, room, 64, 3))
    got = sum((ids < 64).sum() for codes, room, _ in language_id._pieces([text], 3) for ids in language_id._gram_ids(codes, room, 64, 3))
    assert got == want
    names, scores = language_id.score_texts(*model, [text, None, "é"])
    assert names == ["a", "und", "a"] and scores[0] > 0.99


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_base_counts_match_brute_force(spark):
    texts = [r["text"] for r in table(spark, SF, "documents").select("text").collect()]
    texts += ["", " ", "a a a a", "a b c a b c", "é é é x\n\n é é é x ", "x\ny\nx\r\nx", "a b", "<#> $\n<#> $"]
    assert [line_quality.base_counts(t) for t in texts] == [brute_counts(t) for t in texts]


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    for n in range(1, 8):
        scores, move = rng.normal(size=(n, 2)), rng.normal(size=(2, 2))
        paths = [[k >> i & 1 for i in range(n)] for k in range(1 << n)]
        value = [sum(scores[i, p[i]] for i in range(n)) + sum(move[p[i], p[i + 1]] for i in range(n - 1)) for p in paths]
        assert line_quality.viterbi(scores, move).tolist() == paths[int(np.argmax(value))]


def test_line_quality_keeps_good_and_rejects_junk(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = line_quality.judge_documents(docs, labels).join(labels, "doc_id").filter("NOT base_failed")
    share = {r["quality"]: r["kept"] for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] > 0.97 and share[0] < 0.1


GOOD = [
    "The report says that all of the houses near the river were built in one summer by the same people.", "She walked to the market in the morning and came back with bread and a letter.",
    "Nobody knew why the old clock had stopped, but everyone had an idea of what to do about it.", "In the end the council agreed to repair the bridge before the winter.",
    "He had not thought of the garden for years until the smell of rain brought it back to him.", "They sat at the long table and talked about the harvest until it was dark outside.",
    "A letter came from the north with news that the road would be closed for another month.", "It is said that the lake was once so clear that fish could be counted from the shore.",
]
GOOD = [f"{a} {b}" for a, b in zip(GOOD, GOOD[1:] + GOOD[:1])]
JUNK = ["HOME | ABOUT | CONTACT | LOGIN", "CLICK HERE!!! >>> $$$ 100% FREE!!", "*** SALE *** 50% *** OFF ***", "NEWS | SHOP | CART | HELP", "### TAGS ### $$$ %%%", "BUY NOW!! BUY NOW!!", "A&&& B$$$ C%%% D***", "MENU >>> LINKS >>> MORE >>>"]


def test_lines_of_mixed_texts_are_told_apart(spark):
    """Labels switch inside a text, in blocks and line by line."""
    model = line_quality.train(table(spark, SF, "documents"), table(spark, SF, "labels"))
    emit = np.hstack([model.emit, np.zeros((2, 1))])

    def marks(lines):
        return line_quality.viterbi(emit[:, line_quality.line_features("\n".join(lines))[0]].sum(-1).T, model.move).tolist()

    assert marks(GOOD + JUNK) == [1] * 8 + [0] * 8
    mixed = marks([x for pair in zip(GOOD, JUNK) for x in pair])
    assert sum(mixed[::2]) >= 7 and sum(mixed[1::2]) <= 1
    shares = [line_quality.content_share("\n".join(GOOD[:n] + JUNK[n:]), model) for n in range(9)]
    assert shares == sorted(shares) and shares[0] < 0.1 and shares[8] > 0.9 and len({round(x, 2) for x in shares}) >= 7


def test_line_labels_that_the_texts_do_not_give():
    """Good texts with one junk line each, and the other way round: the lines change sides before the last fit."""
    lines = {True: line_quality.line_features("\n".join(GOOD))[0], False: line_quality.line_features("\n".join(JUNK))[0]}
    rng = np.random.default_rng(3)
    pieces, quality = [], []
    for i in range(120):
        good = bool(i % 2)
        most = lines[good][rng.permutation(8)[:6]]
        pieces.append(np.insert(most, int(rng.integers(0, 7)), lines[not good][int(rng.integers(0, 8))], axis=0))
        quality.append(int(good))
    model = line_quality.fit_latent(pieces, quality)
    emit = np.hstack([model.emit, np.zeros((2, 1))])
    for p, q in zip(pieces, quality):
        assert (line_quality.viterbi(emit[:, p].sum(-1).T, model.move) != q).sum() == 1


def test_line_quality_of_odd_rows(spark):
    labels = table(spark, SF, "labels")
    rows = line_quality.judge_documents(odd(spark), labels).collect()
    assert len(rows) == len(ODD)
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["n_words"] == by[2]["n_words"] == by[3]["n_words"] == 0 and by[1]["base_failed"] and not by[1]["kept"]
    assert by[7]["n_words"] == 180000 and by[7]["n_repeat_words"] == 180000 and by[7]["base_failed"]
    assert line_quality.judge_documents(odd(spark).limit(0), labels.limit(0)).count() == 0


def test_gradients_of_the_likelihoods():
    rng = np.random.default_rng(1)
    seqs = [rng.integers(0, line_quality.N_FEATURES, (n, 4)).astype(np.int16) for n in (1, 3, 5, 2)]
    seen = {}

    def check(f, x, **_):
        value, g = f(x + 0.1)
        for i in range(0, len(x), 7):
            e = np.zeros(len(x))
            e[i] = 1e-5
            seen[i] = abs((f(x + 0.1 + e)[0] - f(x + 0.1 - e)[0]) / 2e-5 - g[i])
        return x

    with pytest.MonkeyPatch.context() as m:
        m.setattr(line_quality, "lbfgs", check)
        line_quality._fit(seqs, [0, 1, 1, 0], 1e-3)
        m.setattr(toxicity, "lbfgs", check)
        toxicity._fit([rng.integers(0, 12, 5) for _ in range(9)], np.array([0, 1, 2, 0, 1, 2, 0, 0, 1]), 12, 1e-3)
    assert max(seen.values()) < 1e-6


def test_toxic_texts_are_graded_higher(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = toxicity.score_severity(docs, labels).join(labels, "doc_id")
    r = {x["toxic"]: x for x in got.groupBy("toxic").agg(F.avg(F.col("rejected").cast("int")).alias("rejected"), F.avg("severity").alias("severity")).collect()}
    assert r[1]["rejected"] > 0.7 and r[0]["rejected"] < 0.02 and r[1]["severity"] > 10 * r[0]["severity"]


def test_toxicity_grades_follow_planted_severity(spark):
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "theta"]
    bad = ["grr", "bah", "meh", "ugh"]
    rows = [(i, " ".join(words[(i * 3 + j) % 8] for j in range(20)) + " " + " ".join(bad[(i + j) % 4] for j in range(i % 3)), i % 3) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, grade int")
    model = toxicity.train(docs.drop("grade"), docs.select("doc_id", "grade"))
    got = docs.select("grade", toxicity.severity_of(docs, model).alias("s")).groupBy("grade").agg(F.avg("s.severity").alias("s")).orderBy("grade").collect()
    assert [round(r["s"]) for r in got] == [0, 1, 2]


def test_toxicity_of_odd_rows(spark):
    labels = table(spark, SF, "labels")
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang", "source", F.lit(0.0).alias("__toxicity"), F.lit("").alias("__language"))
    got = toxicity.score_severity(docs.unionByName(odd(spark).withColumn("doc_id", -F.col("doc_id"))), labels).filter("doc_id < 0 OR doc_id IS NULL").collect()
    assert len(got) == len(ODD) and not any(r["rejected"] for r in got)
    assert [r["severity"] for r in got if r["doc_id"] in (-1, -2, -3)] == [0, 0, 0]
    assert toxicity.score_severity(odd(spark).limit(0), labels.limit(0)).count() == 0
    kept = toxicity.drop_toxic(docs.unionByName(odd(spark)), labels)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count() + len(ODD)
    assert toxicity.drop_toxic(odd(spark), labels.limit(0)).count() == len(ODD)
