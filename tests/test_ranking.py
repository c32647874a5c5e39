"""Order-dependent building blocks against numpy and pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brightloom.operators import ranking
from brightloom.operators.features import label_encode, quantile_bins


def frame(n=4000, seed=1):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(0, 1, n), rng.uniform(-1e9, 1e9, n), np.full(n, 42.5), np.zeros(50), rng.uniform(1.7e9, 1.7e9 + 5, n)])
    g = rng.choice(["hot"] * 8 + ["a", "b"], len(x))
    return pd.DataFrame({"id": np.arange(len(x)), "g": g, "x": x, "y": np.round(x, 1)})


PROBS = {"p0": 0.0, "p1": 0.01, "q1": 0.25, "med": 0.5, "q3": 0.75, "p99": 0.99, "p100": 1.0}


def test_exact_quantiles_global(spark):
    pdf = frame()
    out = {r["column"]: r for r in ranking.exact_quantiles(spark.createDataFrame(pdf), ["x", "y"], PROBS).collect()}
    for c in ("x", "y"):
        for name, p in PROBS.items():
            assert out[c][name] == pytest.approx(np.quantile(pdf[c], p), rel=1e-12, abs=1e-12)
        assert out[c]["n"] == len(pdf)


def test_exact_quantiles_grouped_with_null_key_and_values(spark):
    pdf = frame(800, 3)
    pdf["x"] = pdf["x"].where(pdf["id"] % 10 != 0)
    df = spark.createDataFrame(pdf).withColumn("g", F.when(F.col("g") != "b", F.col("g"))).withColumn("x", F.nanvl("x", F.lit(None)))
    out = {r["g"]: r for r in ranking.exact_quantiles(df, ["x"], PROBS, ["g"]).collect()}
    for g, part in pdf.groupby("g"):
        vals = part["x"].dropna()
        for name, p in PROBS.items():
            assert out[None if g == "b" else g][name] == pytest.approx(np.quantile(vals, p), rel=1e-12, abs=1e-12)


def test_exact_quantiles_empty_single_and_nan(spark):
    assert ranking.exact_quantiles(spark.createDataFrame([], "x double"), ["x"], PROBS).count() == 0
    one = ranking.exact_quantiles(spark.createDataFrame([(7.0,), (None,), (float("nan"),)], "x double"), ["x"], {"m": 0.5}).first()
    assert (one["n"], one["m"]) == (1, 7.0)


@pytest.mark.parametrize("by", [[], ["g"]])
def test_ranks_outside_of_their_brackets_are_found(spark, monkeypatch, by):
    """Summaries so coarse that the brackets miss their ranks."""
    monkeypatch.setattr(ranking, "_ACCURACY", 2)
    pdf = frame(1500, 4)
    out = ranking.exact_quantiles(spark.createDataFrame(pdf).repartition(6), ["x", "y"], PROBS, by, margin=0.0).collect()
    for g, part in pdf.groupby("g") if by else [(None, pdf)]:
        for c in ("x", "y"):
            (row,) = [r for r in out if r["column"] == c and (not by or r["g"] == g)]
            for name, p in PROBS.items():
                assert row[name] == pytest.approx(np.quantile(part[c], p), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("kind", ["micros", "offset", "mixed", "frequent"])
def test_ranges_follow_the_data(spark, kind):
    rng = np.random.default_rng(0)
    n = 8000
    x = {
        "micros": rng.integers(1_704_067_200_000_000, 1_706_745_600_000_000, n),
        "offset": 1e9 + rng.random(n),
        "mixed": np.concatenate([rng.normal(0, 10.0**e, n // 8) for e in range(-12, 12, 3)]),
        "frequent": np.where(rng.random(n) < 0.5, 7, rng.integers(0, 10**6, n)),
    }[kind]
    df = spark.createDataFrame(pd.DataFrame({"x": x, "id": rng.permutation(n)}))
    for descending in (False, True):
        out = ranking.value_ranges(df, "x", descending, "id", ranges=64).select("x", "id", "__range.*").toPandas()
        out = out.sort_values(["x", "id"], ascending=[not descending, True])
        assert out.sort_values(["a", "b"], kind="stable").index.equals(out.index)
        assert out.groupby(["a", "b"]).size().max() < 0.05 * n


@pytest.mark.parametrize("kind", ["spread", "frequent"])
def test_ranges_inside_ranges(spark, monkeypatch, kind):
    """More ranges than one step finds."""
    monkeypatch.setattr(ranking, "MOST_RANGES", 8)
    rng = np.random.default_rng(6)
    n = 8000
    x = rng.normal(size=n) if kind == "spread" else np.where(rng.random(n) < 0.4, 7.0, rng.integers(0, 10**6, n))
    df = spark.createDataFrame(pd.DataFrame({"x": x, "id": rng.permutation(n)})).unionAll(spark.createDataFrame([(None, -1), (None, -2)], "x double, id long"))
    for descending in (False, True):
        out = ranking.value_ranges(df, "x", descending, "id", ranges=64).select("x", "id", "__range.*").toPandas()
        out = out.sort_values(["x", "id"], ascending=[not descending, True], na_position="last" if descending else "first")
        assert out.sort_values(["a", "d", "b"], kind="stable").index.equals(out.index)
        groups = out.groupby(["a", "d", "b"]).size()
        assert groups.max() < (0.06 if kind == "frequent" else 0.04) * n and len(groups) > 40
    df = ranking.value_ranges(df, "x", tie="id", ranges=64)
    got = ranking.split_row_number(df, [F.asc("x"), F.asc("id")], F.col("__range")).orderBy("rn").select("x", "id").toPandas()
    want = df.select("x", "id").toPandas().sort_values(["x", "id"], na_position="first", ignore_index=True)
    assert got["id"].tolist() == want["id"].tolist()


@pytest.mark.parametrize("keys", [(), ("g",)])
def test_split_row_number(spark, keys):
    pdf = frame(500, 5)
    df = spark.createDataFrame(pdf)
    df = ranking.value_ranges(df, "y", descending=True, tie="id")
    got = ranking.split_row_number(df, [F.desc("y"), F.asc("id")], F.col("__range"), keys, split_above=100).toPandas().set_index("id")["rn"]
    want = pdf.sort_values(["y", "id"], ascending=[False, True])
    want = (want.groupby("g").cumcount() if keys else pd.Series(range(len(want)), index=want.index)) + 1
    assert (got.sort_index().to_numpy() == want.sort_index().to_numpy()).all()


def test_running_totals_with_null_order_values(spark):
    df = spark.createDataFrame([(1, None, 5), (2, 3.0, 7), (3, -1.0, 2), (4, 3.5, 1)], "id int, x double, m int")
    df = ranking.value_ranges(df, "x", tie="id")
    out = ranking.running_totals(df, [F.asc("x"), F.asc("id")], F.col("__range"), {"before": F.col("m")})
    assert {r["id"]: r["before"] for r in out.collect()} == {1: 0, 3: 5, 2: 7, 4: 14}


def test_label_encode_many_values_with_shared_prefix(spark):
    values = [f"Customer#{i:09d}" for i in range(3000)] + ["Ünique", "zed", ""]
    df = spark.createDataFrame([(v,) for v in values] * 2, "v string")
    df = df.withColumnRenamed("v", "name")
    got = {r["name"]: r["code"] for r in label_encode(df, "name", "code").distinct().collect()}
    assert got == {v: i for i, v in enumerate(sorted(values))}


def test_quantile_bins_match_pandas(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"id": range(1000), "x": rng.integers(0, 12, 1000).astype(float)})
    got = quantile_bins(spark.createDataFrame(pdf), ["x"]).toPandas().sort_values("id")["x_bin"].to_numpy()
    assert (got == pd.qcut(pdf["x"], 10, labels=False, duplicates="drop").to_numpy()).all()


def test_double_ranges_are_placed_in_arrays(spark):
    values = [None, float("nan"), -0.0, 0.0, 1.5, float("inf"), -float("inf")] * 3 + [float(i % 50) for i in range(400)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    placed = ranking.value_ranges(df, "v", ranges=20)
    assert "ArrowEvalPython" in placed._jdf.queryExecution().optimizedPlan().toString()
    seen = placed.filter("v IS NOT NULL").distinct().orderBy("v", "__range").collect()
    assert [r["__range"] for r in seen] == sorted(r["__range"] for r in seen) and len({r["__range"] for r in seen}) > 15
    assert placed.filter("v IS NULL").select("__range").distinct().collect() == [(0,)]
    back = ranking.value_ranges(df, "v", descending=True, ranges=20).filter("v IS NOT NULL")
    assert sorted(-r["__range"] for r in back.collect()) == sorted(r["__range"] for r in placed.filter("v IS NOT NULL").collect())
