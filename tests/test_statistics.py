"""p-values and statistics with known answers, fairness and evaluation invariants."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brightloom.functions import pvalues as pv
from brightloom.operators import fairness, inference, modeling, profile


def test_p_values(spark):
    cases = [
        (pv.t_two_sided(F.lit(2.0), F.lit(10)), 0.07338803477074039), (pv.chi2_upper(F.lit(3.841458820694124), F.lit(1)), 0.05),
        (pv.f_upper(F.lit(4.0), F.lit(2), F.lit(10)), (1 + 2 * 4 / 10) ** -5), (pv.normal_two_sided(F.lit(1.959963984540054)), 0.05),
    ]
    for expr, want in cases:
        assert spark.range(1).select(expr.alias("p")).first()["p"] == pytest.approx(want, rel=1e-9)


@pytest.mark.parametrize("x_levels,y_levels", [(6, 4), (1, 5), (10**6, 10**6)])
def test_kendall_against_pairs(spark, x_levels, y_levels):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"x": rng.integers(0, x_levels, 80), "y": rng.integers(0, y_levels, 80)})
    c = d = tx = ty = 0
    for (a, b), (e, f) in itertools.combinations(pdf.itertuples(index=False, name=None), 2):
        s = (a - e) * (b - f)
        c, d, tx, ty = c + (s > 0), d + (s < 0), tx + (a == e), ty + (b == f)
    n0 = 80 * 79 / 2
    got = inference.kendall_tau(spark.createDataFrame(pdf), "x", "y").first()
    assert (got["concordant"], got["discordant"]) == (c, d)
    if x_levels > 1:
        assert got["tau"] == pytest.approx((c - d) / math.sqrt((n0 - tx) * (n0 - ty)))
    else:
        assert got["tau"] is None


def test_chi_square_two_by_two_is_corrected(spark):
    rows = [("a", "x")] * 10 + [("a", "y")] * 20 + [("b", "x")] * 30 + [("b", "y")] * 25
    got = inference.chi_square_independence(spark.createDataFrame(rows, "a string, b string"), "a", "b").first()
    e = [30 * 40 / 85, 30 * 45 / 85, 55 * 40 / 85, 55 * 45 / 85]
    want = sum((abs(o - x) - 0.5) ** 2 / x for o, x in zip([10, 20, 30, 25], e))
    assert got["chi2"] == pytest.approx(want) and got["dof"] == 1 and 0 < got["p"] < 1


def test_ttest_zero_variance_gives_null(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 1.0), ("b", 1.0)], "g string, x double")
    assert inference.ttest_independent(df, "x", "g", "a", "b").first()["t"] is None


def test_spearman_monotone_is_one(spark):
    df = spark.createDataFrame([(float(i), float(i) ** 3) for i in range(1, 40)], "a double, b double")
    got = inference.pearson_spearman(df, "a", "b").first()
    assert got["spearman"] == pytest.approx(1.0) and got["pearson"] < 1


def test_ab_test_significance(spark):
    rows = [("a", 10.0 + i % 3) for i in range(50)] + [("b", 11.0 + i % 3) for i in range(50)]
    got = inference.ab_test(spark.createDataFrame(rows, "g string, x double"), "x", "g", "a", "b").first()
    assert got["significant"] and got["effect_size"] < 0


def test_reweighing_invariants(spark):
    rows = [(i, i % 2, int(i % 3 == 0)) for i in range(100)] + [(100, None, 1)]
    df = spark.createDataFrame(rows, "id int, g int, y int")
    w = fairness.reweighing(df, "y", "g")
    assert w.count() == 101 and w.agg(F.sum("weight")).first()[0] == pytest.approx(100)
    m = fairness.fairness_metrics(w.filter("g IS NOT NULL"), "y", ["g"], "weight").first()
    assert m["disparate_impact"] == pytest.approx(1) and m["statistical_parity_difference"] == pytest.approx(0)


def test_protected_groups_skip_many_valued(spark):
    rows = [("F", "r1"), ("M", "r2"), ("F", "r3"), ("M", "r4")]
    got = fairness.protected_groups(spark.createDataFrame(rows, "gender string, race string"), ["gender", "race"]).collect()
    assert [(r["attribute"], r["privileged"], r["unprivileged"]) for r in got] == [("gender", "M", "F")]


def test_confusion_and_report(spark):
    rows = [(0, 0)] * 3 + [(0, 1)] + [(1, 1)] * 2 + [(2, 1)]
    df = spark.createDataFrame(rows, "y int, p int")
    m = modeling.confusion_matrix(df, "y", "p").collect()
    assert len(m) == 9 and sum(r["n"] for r in m) == 7
    rep = {r["item"]: r for r in modeling.classification_report(df, "y", "p").collect()}
    assert rep["2"]["precision"] == 0 and rep["accuracy"]["f1"] == pytest.approx(5 / 7)


def test_auc_with_ties_against_pairs(spark):
    rng = np.random.default_rng(4)
    y, s = rng.integers(0, 2, 200), rng.integers(0, 15, 200) / 10
    got = modeling.roc_auc(spark.createDataFrame(pd.DataFrame({"y": y, "s": s})), "y", "s").first()["auc"]
    pos, neg = s[y == 1], s[y == 0]
    assert got == pytest.approx(np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg]))


def test_moments_of_tiny_input(spark):
    out = profile.moments(spark.createDataFrame([(1.0,), (2.0,)], "x double"), ["x"]).first()
    assert out["skew"] is None and out["kurtosis"] is None
