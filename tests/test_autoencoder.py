"""Network reconstruction: gradients, a curved manifold that planes miss, and independence of the partitions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from brightloom.operators import anomaly, autoencoder


def test_gradient():
    rng = np.random.default_rng(0)
    net = autoencoder.Network([4, 6, 2, 6, 4])
    x, w = rng.normal(size=(9, 4)), net.start(1)
    _, grad = net.loss(w, x)
    for i in range(0, net.size, 5):
        e = np.zeros(net.size)
        e[i] = 1e-6
        assert (net.loss(w + e, x)[0] - net.loss(w - e, x)[0]) / 2e-6 == pytest.approx(grad[i], abs=1e-5)


def circle(n=1200, wrong=40):
    """Points of a ring bent into six dimensions, and points off it in the same range."""
    rng = np.random.default_rng(2)
    t = rng.uniform(0, 2 * np.pi, n)

    def bend(a, b):
        return np.column_stack([a, b, a * a, b * b, a * b, a * a - b])

    good = bend(np.cos(t), np.sin(t)) + rng.normal(0, 0.01, (n, 6))
    bad = np.column_stack([rng.uniform(c.min(), c.max(), wrong) for c in good.T])
    return np.vstack([good, bad])


@pytest.fixture(scope="module")
def found(spark):
    x = circle()
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(9000, None), (9001, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (9002, [float("nan")] * 6)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    net = {"layers": (16, 8, 1, 8, 16), "epochs": 60, "quantile": 0.96}
    return {n: {r["id"]: r for r in autoencoder.autoencoder_error(df.repartition(n), "v", **net).collect()} for n in (2, 5)}, df


def test_curved_manifold_is_told_from_noise(spark, found):
    rows, df = found
    bad = set(range(1200, 1240))
    flagged = {i for i, r in rows[2].items() if r["recon_anomaly"]}
    planes = anomaly.reconstruction_error(df.filter("id < 9000"), "v", 1, 0.96)
    by_planes = {r["id"] for r in planes.filter("recon_anomaly").collect()}
    assert len(flagged & bad) >= 32 and len(flagged & bad) > len(by_planes & bad) + 5


def test_partitions_do_not_matter(found):
    a, b = found[0][2], found[0][5]
    known = [i for i in a if i < 9000]
    assert np.corrcoef([a[i]["recon_error"] for i in known], [b[i]["recon_error"] for i in known])[0, 1] > 0.99
    assert all(a[i]["recon_error"] is None and a[i]["recon_anomaly"] is None for i in (9000, 9001, 9002))


def test_empty(spark):
    df = spark.createDataFrame([], "id long, v array<double>")
    assert autoencoder.autoencoder_error(df, "v").count() == 0
    constant = spark.createDataFrame([(1, [2.0, 3.0])] * 5, "id long, v array<double>")
    assert autoencoder.autoencoder_error(constant, "v", layers=(2,), epochs=5).agg(F.max("recon_error")).first()[0] < 0.2
