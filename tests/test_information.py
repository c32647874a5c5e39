"""Nearest-neighbour mutual information against brute force."""

import math

import numpy as np
import pandas as pd
import pytest

from brightloom.operators.features import mutual_information


def psi(n):
    n = float(n)
    out = 0.0
    while n < 10:
        out, n = out - 1 / n, n + 1
    return out + math.log(n) - 1 / (2 * n) - 1 / (12 * n**2) + 1 / (120 * n**4) - 1 / (252 * n**6)


def brute(v, y, k=3):
    """Row by row: all distances, sorted."""
    keep = np.array([(y == c).sum() > 1 for c in y])
    v, y = v[keep], y[keep]
    total = 0.0
    for i in range(len(v)):
        own = np.flatnonzero((y == y[i]) & (np.arange(len(v)) != i))
        d = np.sort(np.abs(v[own] - v[i]))
        kk = min(k, len(own))
        r = d[kk - 1]
        if r == 0:
            m, kk = (v == v[i]).sum(), (v[y == y[i]] == v[i]).sum()
        else:
            m = (np.abs(v - v[i]) < r).sum()
        total += psi(kk) - psi(len(own) + 1) - psi(m)
    return max(psi(len(v)) + total / len(v), 0.0)


def test_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    n = 2000
    y = rng.choice(["a", "b", "c"], n, p=[0.6, 0.3, 0.1])
    shift = np.select([y == "a", y == "b"], [0, 2], 5)
    frame = pd.DataFrame(
        {
            "y": y, "told": np.round((rng.normal(size=n) + shift) * 1024) / 1024, "noise": np.round(rng.normal(size=n) * 4096) / 4096, "ties": rng.integers(0, 6, n) + (y == "c"),
            "half": np.where(rng.random(n) < 0.3, 0, np.round(rng.normal(size=n) * 1024) / 1024), "flat": 1.0,
        }
    )
    df = spark.createDataFrame(frame)
    rare = spark.createDataFrame([("lonely", 1.0, 2.0, 3, 4.0, 5.0), (None, 1.0, 2.0, 3, 4.0, 5.0), ("a", None, None, None, None, None), ("b", float("nan"), None, None, None, None)], df.schema)
    got = {r["feature"]: r["mi"] for r in mutual_information(df.unionAll(rare).repartition(9), ["told", "noise", "ties", "half", "flat"], "y").collect()}
    for c in ("told", "noise", "ties", "half", "flat"):
        assert got[c] == pytest.approx(brute(frame[c].to_numpy(float), y), abs=1e-9), c
    assert got["told"] > 0.4 and got["noise"] < 0.03 and got["flat"] < 1e-9


def test_rows_are_not_joined_with_their_counts(spark):
    """What a row's gain needs travels with the ends of its distance."""
    df = spark.createDataFrame([(float(i * i % 17), "ab"[i % 2]) for i in range(40)], "x double, y string")
    got = mutual_information(df, ["x"], "y")
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert got.first()["mi"] == pytest.approx(brute(np.array([i * i % 17 for i in range(40)], float), np.array(["ab"[i % 2] for i in range(40)])))


def test_tiny_and_empty(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "a"), (3.0, "b"), (4.0, "b")], "x double, y string")
    assert mutual_information(df, ["x"], "y").first()["mi"] == pytest.approx(brute(np.array([1.0, 2, 3, 4]), np.array(list("aabb"))))
    assert mutual_information(df.filter("x > 9"), ["x"], "y").count() == 0
