"""Planted signals for operators without a SQL equivalent."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brightloom.operators import anomaly, features, forests, kpi, modeling, segments, text, timeseries


def test_isolation_forest_finds_spikes(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"id": range(2000), "v": rng.normal(10, 1, 2000)})
    pdf.loc[[5, 700, 1500], "v"] = [60.0, -40.0, 90.0]
    pdf.loc[9, "v"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("v", F.nanvl("v", F.lit(None)))
    out = anomaly.isolation_forest(df, ["v"], "id", contamination=0.1).toPandas()
    assert len(out) == 2000 and set(out.nlargest(3, "if_score")["id"]) == {5, 700, 1500}
    assert 0.05 < (out["if_anomaly"] == True).mean() <= 0.101  # noqa: E712
    assert pd.isna(out.set_index("id").loc[9, "if_score"])


def test_isolation_forest_small_table(spark):
    df = spark.createDataFrame([(i, 1.0) for i in range(20)] + [(20, 50.0)], "id int, v double")
    out = anomaly.isolation_forest(df, ["v"], "id", 0.05).toPandas()
    assert out.loc[out["if_score"].idxmax(), "id"] == 20


def test_reconstruction_error_flags_off_plane(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (300, 2)) @ rng.normal(0, 1, (2, 6))
    x[17] += 5 * np.array([1, -1, 1, -1, 1, -1])
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id int, v array<double>")
    out = anomaly.reconstruction_error(df, "v", 2).toPandas()
    assert out.loc[out["recon_error"].idxmax(), "id"] == 17


def test_zscore_of_constant_column(spark):
    out = anomaly.zscore_scale(spark.createDataFrame([(3.0,), (3.0,), (None,)], "x double"), ["x"]).collect()
    assert [r["x_z"] for r in out] == [0.0, 0.0, None]


def test_forecast_follows_weekly_sine(spark):
    start = dt.date(2024, 1, 1)
    f = lambda i: 100 + 0.5 * i + 10 * math.sin(2 * math.pi * i / 7)
    rows = [(k, start + dt.timedelta(days=i), f(i) if k == "k" else 5.0) for i in range(140) for k in ("k", "flat")]
    out = kpi.kpi_forecast(spark.createDataFrame(rows, "kpi string, date date, value double"), 14).toPandas().sort_values("date")
    assert out[out["kpi"] == "flat"]["forecast"].to_numpy() == pytest.approx([5.0] * 154)
    out = out[out["kpi"] == "k"]
    assert out["forecast"].to_numpy() == pytest.approx([f(i) for i in range(154)], abs=1e-6)
    assert out["actual"].notna().sum() == 140
    assert (out["lower"] <= out["forecast"] + 1e-9).all()


def blobs(spark):
    rng = np.random.default_rng(2)
    c = np.array([[0, 0], [20, 0], [0, 20]])
    rows = [(i, i % 3, [float(v) for v in c[i % 3] + rng.normal(0, 1, 2)]) for i in range(150)]
    return segments.vectors_from_array(spark.createDataFrame(rows, "id int, blob int, v array<double>"), "v")


def test_kmeans_recovers_blobs(spark):
    out = segments.kmeans_segments(blobs(spark), 3, restarts=3)
    assert out.groupBy("blob").agg(F.count_distinct("segment").alias("n")).filter("n > 1").count() == 0
    best = segments.optimal_clusters(blobs(spark), range(2, 6)).filter("best").first()
    assert best["k"] == 3


def test_fits_share_their_passes(spark, monkeypatch):
    """All restarts of all k take at most 20 passes over the rows together, and end where Spark's own fits do."""
    from pyspark.ml.clustering import KMeans

    passes, one = [], segments._round
    monkeypatch.setattr(segments, "_round", lambda points, centres, middle: passes.append(len(centres)) or one(points, centres, middle))
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in 1000 + rng.normal(0, 1 + i % 3, 3)]) for i in range(600)]
    data = segments.vectors_from_array(spark.createDataFrame(rows, "id int, v array<double>"), "v").select("features").persist()
    got = segments._fits(data, [2, 5], 4, 7, 4)
    assert len(passes) <= 20 and passes[0] == 8
    for k, centres in got.items():
        own = min((KMeans(k=k, seed=7 + i, featuresCol="features").fit(data) for i in range(4)), key=lambda m: m.summary.trainingCost)
        assert centres == pytest.approx(np.array(own.clusterCenters()), abs=1e-6)
    data.unpersist()


def test_target_encode_shrinks_small_groups(spark):
    df = spark.createDataFrame([("big", 1)] * 200 + [("small", 0)] * 2 + [(None, 1)], "c string, y int")
    out = {r["c"]: r["c_target"] for r in features.target_encode(df, "c", "y").distinct().collect()}
    prior = 201 / 203
    assert out["big"] == pytest.approx(1.0, abs=1e-3) and out["small"] == pytest.approx(prior * (1 - 1 / (1 + math.exp(1.8))))
    assert out[None] == pytest.approx(prior)


def test_one_hot_leaves_wide_columns(spark):
    df = spark.createDataFrame([(str(i),) for i in range(10)], "c string")
    assert features.one_hot(df, "c").columns == ["c"]
    assert len(features.one_hot(df.limit(9), "c").columns) == 10


def test_selection_prefers_signal(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 400)
    pdf = pd.DataFrame({"good": y * 3 + rng.normal(0, 0.5, 400), "noise": rng.normal(0, 1, 400), "also": rng.normal(0, 1, 400), "y": y})
    df = spark.createDataFrame(pdf)
    assert features.select_features(df, ["good", "noise", "also"], "y", 1, trees=5).first()["feature"] == "good"
    ranks = {r["feature"]: r["ranking"] for r in features.recursive_elimination(df, ["good", "noise", "also"], "y", 1, trees=5).collect()}
    assert ranks["good"] == 1 and sorted(ranks.values()) == [1, 2, 3]


def test_decompose_removes_known_season(spark):
    season = [3.0, -1.0, -2.0]
    rows = [(i, 2.0 * i + season[i % 3]) for i in range(30)]
    for period, ends in ((3, 1),):
        out = timeseries.seasonal_decompose(spark.createDataFrame(rows, "i int, v double"), "i", "v", period).toPandas().sort_values("i")
        assert out["trend"].isna().sum() == 2 * ends
        assert out["seasonal"].to_numpy()[:3] == pytest.approx(season)
        assert out["residual"].dropna().abs().max() < 1e-9


def test_text_classifier_learns(spark):
    rows = [(i, ("lovely sunny day " if i % 2 else "broken rainy night ") + str(i), i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, t string, y int")
    out = text.apply_text_classifier(text.train_text_classifier(df, "t", "y"), df, "t")
    assert out.filter("predicted = y").count() == 60


def test_sentiment_unknown_and_sign(spark):
    df = spark.createDataFrame([(1, "Great, GOOD value"), (2, "terrible waste"), (3, " "), (4, None)], "id int, t string")
    out = {r["id"]: (r["label"], round(r["score"], 3)) for r in text.lexicon_sentiment(df, "t").collect()}
    assert out == {1: ("POSITIVE", 0.881), 2: ("NEGATIVE", 0.881), 3: ("UNKNOWN", 0.0), 4: ("UNKNOWN", 0.0)}


def test_lemmas_keep_order_and_repeats(spark):
    df = spark.createDataFrame([(1, "cats chase cats, the dogs!"), (2, "the")], "id int, t string")
    lemmas = spark.createDataFrame([("cats", "cat"), ("dogs", "dog")], "token string, lemma string")
    out = {r["id"]: r["clean_text"] for r in text.tokenize_filter(df, "t", key="id", lemmas=lemmas).collect()}
    assert out == {1: "cat chase cat dog", 2: ""}


def test_long_conversation_is_split_not_cut(spark):
    rows = [(1, i, "user", f"t{i}") for i in range(1203)]
    out = text.conversation_transcripts(spark.createDataFrame(rows, "c int, turn int, role string, text string"), "c", "turn", "role", "text", 500).collect()
    assert sorted((r["part"], r["n_turns"]) for r in out) == [(0, 500), (1, 500), (2, 203)]
    whole = text.conversation_transcripts(spark.createDataFrame(rows, "c int, turn int, role string, text string"), "c", "turn", "role", "text").collect()
    assert [r["n_turns"] for r in whole] == [1203]


def test_forest_over_counted_groups(spark):
    """Rows are counted by bins once; the trees' fits do not see single rows."""
    df = spark.range(4000).selectExpr("id % 5 AS a", "7 AS constant", "id % 3 AS b", "CAST(id % 5 >= 3 AS int) AS y")
    data = features._vectors(df, ["a", "constant", "b"], "y").select("features", "label")
    counted = features._counted_bins(data, 3)
    assert counted.count() == 15 and counted.agg({"n": "sum"}).first()[0] == 4000
    found = {r["feature"]: r["importance"] for r in features.rf_importance(df, ["a", "constant", "b"], "y", trees=8).collect()}
    assert found["a"] > 0.9 and found["constant"] == 0 and abs(sum(found.values()) - 1) < 1e-9
    ranks = {r["feature"]: r["ranking"] for r in features.recursive_elimination(df, ["a", "constant", "b"], "y", 1, trees=8).collect()}
    assert ranks["a"] == 1 and sorted(ranks.values()) == [1, 2, 3]
    assert features._counted_bins(features._vectors(spark.range(500).selectExpr("rand(1) AS a", "rand(2) AS b", "id % 2 AS y"), ["a", "b"], "y"), 2) is None


def test_forests_over_groups_grow_together(spark, monkeypatch):
    """No fit per tree, and splits, draws and votes as of a forest over the rows."""
    df = spark.range(6000).selectExpr("id % 40 AS a", "id % 7 AS b", "id % 3 AS c", "CASE WHEN id % 40 < 13 THEN 'low' WHEN id % 7 < 3 THEN 'mid' ELSE 'top' END AS y")
    monkeypatch.setattr(features.RandomForestClassifier, "fit", lambda *_: pytest.fail("a fit of its own"))
    found = {r["feature"]: r["importance"] for r in features.rf_importance(df, ["a", "b", "c"], "y", trees=30).collect()}
    assert sum(found.values()) == pytest.approx(1) and found["a"] > found["b"] > 10 * found["c"]
    groups = spark.createDataFrame([(float(a), float(b), int(a > 2), 50 + a) for a in range(6) for b in range(3)], "b0 double, b1 double, label int, n long")
    packed = forests.blocks(groups, ["b0", "b1"])
    grown = forests.grow(packed, 2, 2, 20, 3, 1)
    draws = grown.counts[:, 1].sum(axis=1)
    assert len(set(draws)) > 10 and abs(draws.mean() / 945 - 1) < 0.05
    assert (grown.upto[:, 1][grown.feature[:, 1] == 0] == 2).all()
    assert forests.accuracy(packed, 2, grown) == 1.0
    again = forests.grow(packed.repartition(5), 2, 2, 20, 3, 1)
    assert (grown.counts == again.counts).all()


def test_best_split_against_brute_force():
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 9, 300), rng.integers(0, 3, 300)
    h = np.zeros((1, 1, 34, 3))
    np.add.at(h[0, 0], (x, y), 1)

    def gini(v):
        return len(v) - (np.bincount(v, minlength=3) ** 2).sum() / len(v)

    gains = [gini(y) - gini(y[x <= u]) - gini(y[x > u]) for u in range(8)]
    place, upto, gain, left, right = forests._best_splits(h)
    assert place[0] == 0 and upto[0] == int(np.argmax(gains)) and gain[0] == pytest.approx(max(gains))
    assert (left[0] + right[0] == np.bincount(y, minlength=3)).all()
    assert forests._best_splits(np.where(np.arange(3) == 1, h, 0))[0][0] == -1  # one class only


def test_components_are_chosen_over_counted_bins(spark, monkeypatch):
    """The first component tells half of the classes, the second the rest."""
    rng = np.random.default_rng(8)
    a, b = rng.normal(0, 1, 3000), rng.normal(0, 1, 3000)
    df = spark.createDataFrame(pd.DataFrame({"a": a, "a2": a + rng.normal(0, 0.01, 3000), "b": b, "b2": b + rng.normal(0, 0.3, 3000), "flat": 1.0, "y": (a > 0).astype(int) + 2 * (b > 0)}))
    monkeypatch.setattr(features.RandomForestClassifier, "fit", lambda *_: pytest.fail("a fit over rows"))
    k, scores, rows = features.pca_optimize(df, ["a", "a2", "b", "b2", "flat"], "y", ks=[1, 2], trees=20)
    found = {r["k"]: r["accuracy"] for r in scores.collect()}
    assert k == 2 and found[2] > 0.85 and 0.35 < found[1] < 0.65
    assert rows.count() == 3000 and len(rows.first()["components"]) == 2


def test_boosted_trees_over_counted_groups(spark):
    """A fit sees groups with their sizes; the model takes raw features."""
    df = spark.range(20_000).selectExpr("CAST(id % 1000 AS double) / 7 AS a", "CAST(id % 3 AS double) AS b", "CAST((id % 1000 >= 300) != (id % 11 = 0) AS int) AS y")
    seen = []
    fit = modeling.GBTClassifier.fit
    with pytest.MonkeyPatch.context() as m:
        m.setattr(modeling.GBTClassifier, "fit", lambda self, data: (seen.append(data.count()), fit(self, data))[1])
        model, trials = modeling.tune_boosted_trees(df, ["a", "b"], "y", folds=3, settings=[{"maxIter": 3, "maxDepth": 2, "minInstancesPerNode": 5}])
    assert len(seen) == 4 and max(seen) < 5_000
    assert 0.85 < trials.first()["auc"] < 0.95
    assert model.featureImportances.toArray()[0] > 0.9
    out = model.transform(modeling.VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df))
    assert out.filter("prediction = y").count() / 20_000 > 0.88


def test_text_clusters_cache_vectors_only(spark, monkeypatch):
    seen, fit = [], text.KMeans.fit
    monkeypatch.setattr(text.KMeans, "fit", lambda self, data: (seen.append((data.columns, data.storageLevel.useMemory)), fit(self, data))[1])
    df = spark.createDataFrame([(i, "apple pear plum" if i % 2 else "engine wheel brake") for i in range(20)], "id int, t string")
    groups = {(r["id"] % 2, r["cluster"]) for r in text.text_clusters(df, "t", 2).collect()}
    assert len(groups) == 2 and seen == [(["features"], True)]
