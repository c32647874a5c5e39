"""Boosted trees over counted cells and the search of their settings."""

import inspect

import numpy as np
import pandas as pd
import pytest

from brightloom.operators import boosting, modeling
from brightloom.plans import modeling as plans

SETTING = {"maxIter": 30, "maxDepth": 3, "stepSize": 0.1, "minInstancesPerNode": 1, "subsamplingRate": 0.8, "featureSubsetStrategy": 1.0}


def cells(n=600, seed=1):
    rng = np.random.default_rng(seed)
    x = np.unique(rng.integers(0, 12, (n, 3)), axis=0)
    p = 1 / (1 + np.exp(-((x[:, 0] > 5) * 3.0 - (x[:, 1] > 3) * 2.0)))
    rows = rng.integers(0, 60, len(x))
    pos = rng.binomial(rows, p)
    return x.astype(np.uint8), rows - pos, pos


def test_trees_learn_and_predict_as_they_were_fitted():
    x, neg, pos = cells()
    model, score = boosting.fit(x, neg, pos, SETTING, 3)
    assert model.margins(x) == pytest.approx(score)
    assert boosting.auc(score, neg, pos) > 0.8
    assert model.importances.sum() == pytest.approx(1) and model.importances[2] < 0.05
    assert boosting.fit(x, neg, pos, SETTING, 3, keep=False)[1] == pytest.approx(score)
    assert boosting.fit(x, neg, pos, SETTING, 4)[1] != pytest.approx(score)


def test_first_tree_against_brute_force():
    """One tree of one split: the best second-order gain, and leaf values of a Newton step."""
    x, neg, pos = cells(200, 5)
    model, score = boosting.fit(x, neg, pos, SETTING | {"maxIter": 1, "maxDepth": 1, "subsamplingRate": 1.0, "minInstancesPerNode": 5}, 0)
    start = np.log((pos.sum() + 0.5) / (neg.sum() + 0.5))
    p = 1 / (1 + np.exp(-start))
    g, h = (neg + pos) * p - pos, (neg + pos) * p * (1 - p)
    part = lambda m: g[m].sum() ** 2 / (h[m].sum() + 1)
    tried = [(part(m) + part(~m), j, u) for j in range(3) for u in range(11) if h[m := x[:, j] <= u].sum() >= 5 and h[~m].sum() >= 5]
    _, j, u = max(tried)
    m = x[:, j] <= u
    want = np.where(m, -0.1 * g[m].sum() / (h[m].sum() + 1), -0.1 * g[~m].sum() / (h[~m].sum() + 1))
    assert score == pytest.approx(start + want)


def test_area_and_draws():
    rng = np.random.default_rng(2)
    score, neg, pos = rng.integers(0, 6, 40) / 2, rng.integers(0, 5, 40), rng.integers(0, 5, 40)
    pairs = [(p * n, (a > b) + (a == b) / 2) for a, p in zip(score, pos) for b, n in zip(score, neg)]
    assert boosting.auc(score, neg, pos) == pytest.approx(sum(w * v for w, v in pairs) / sum(w for w, _ in pairs))
    assert np.isnan(boosting.auc(score, neg, pos * 0))
    rows = np.array([0, 1, 2, 7, 32, 33, 400])
    draw = boosting._sampler(rows, 0.7)
    drawn = np.array([draw(rng) for _ in range(4000)])
    assert (drawn <= rows).all() and drawn.mean(axis=0) == pytest.approx(0.7 * rows, rel=0.05)
    assert drawn.var(axis=0)[1:] == pytest.approx(0.21 * rows[1:], rel=0.15)


def test_search_learns_from_its_trials():
    """Ten random settings at once, then one at a time, drawn to where the scores are high."""
    calls = []

    def scores(settings):
        calls.append(len(settings))
        return [-abs(s["stepSize"] - 0.09) * 10 - abs(s["maxDepth"] - 4) / 10 for s in settings]

    space = modeling._search_space(1000)
    late, early = [], []
    for seed in range(5):
        found = boosting.search(scores, space, 50, seed)
        assert len(found) == 50
        early += [a for _, a in found[:10]]
        late += [a for _, a in found[30:]]
        for name, (low, high, whole) in space.items():
            assert all(low <= s[name] <= high and isinstance(s[name], int if whole else float) for s, _ in found)
    assert calls == [10, *[1] * 40] * 5
    assert np.mean(late) > np.mean(early) / 2  # random settings stay as bad as the first
    assert boosting.search(scores, space, 12, 1)[-1] == boosting.search(scores, space, 12, 1)[-1]
    assert len(boosting.search(scores, space, 3, 1)) == 3


def test_density_has_the_mass_of_one():
    for whole, at in ((True, np.arange(3, 11)), (False, np.linspace(3, 10, 20001))):
        density = np.exp(boosting._Parzen.of([3, 4, 4, 9], 3, 10, whole).log_density(at.astype(float)))
        assert (density.sum() if whole else np.trapezoid(density, at)) == pytest.approx(1, abs=1e-3)
    weight = boosting._Parzen.of(list(np.linspace(0, 1, 30)), 0, 1, False).weight
    assert weight[0] < weight[3] < weight[4] == weight[-1]


def test_tuned_by_search(spark):
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 20, 3000).astype(float), rng.normal(0, 1, 3000)
    y = ((a > 9) ^ (rng.random(3000) < 0.1)).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"a": a, "b": b, "y": y}))
    df = df.selectExpr("CASE WHEN b < 2 THEN a END AS a", "b", "CASE WHEN b > -2 THEN y END AS y")
    model, trials = modeling.tune_boosted_trees(df, ["a", "b"], "y", budget=12, folds=3, max_trees=20)
    rows = trials.collect()
    assert len(rows) == 12 and max(r["auc"] for r in rows) > 0.85
    out = model.transform(modeling.VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df.na.drop()))
    assert out.filter("prediction = y").count() / out.count() > 0.88
    assert abs(out.first()["probability"].toArray().sum() - 1) < 1e-9 and {"rawPrediction", "a", "b"} <= set(out.columns)
    assert model.featureImportances.toArray()[0] > 0.8
    with pytest.raises(ValueError, match="labels"):
        modeling.tune_boosted_trees(df.selectExpr("a", "b", "y * 2 AS y"), ["a", "b"], "y", budget=1, folds=2, max_trees=2)


def test_more_cells_than_a_task_holds_are_fitted_by_spark(spark, monkeypatch):
    seen, fit = [], modeling.GBTClassifier.fit
    monkeypatch.setattr(modeling.GBTClassifier, "fit", lambda self, data: (seen.append(self.getMaxIter()), fit(self, data))[1])
    monkeypatch.setattr(boosting, "MOST_VALUES", 10)
    df = spark.range(2000).selectExpr("CAST(id % 50 AS double) AS a", "CAST(id % 3 AS double) AS b", "CAST(id % 50 > 20 AS int) AS y")
    _, trials = modeling.tune_boosted_trees(df, ["a", "b"], "y", budget=2, folds=2, max_trees=1)
    assert len(seen) == 5 and set(seen) == {1}
    assert all(r["auc"] > 0.9 for r in trials.collect())


@pytest.mark.parametrize("name", ["tune_boosted_trees", "modelling_workflow"])
def test_registered_queries_run_the_whole_search(spark, monkeypatch, name):
    """No settings of their own, the full budget and all trees reach the search."""
    asked = []

    def search(scores, space, budget, seed):
        asked.append((space, budget))
        return [({k: low for k, (low, _, _) in space.items()} | {"maxIter": 2}, 0.5)]

    monkeypatch.setattr(boosting, "search", search)
    getattr(plans, name)(spark, "/root/testdata/sf0.001").collect()
    assert [(s["maxIter"], s["maxDepth"], b) for s, b in asked] == [((100, 1000, True), (3, 10, True), 50)]
    assert inspect.signature(modeling.tune_boosted_trees).parameters["folds"].default == 5
