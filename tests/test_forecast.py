"""Change points, fitted values and intervals of the KPI forecast."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from brightloom.operators import kpi

START = dt.date(2020, 1, 1)


def series(name, values):
    return pd.DataFrame({"kpi": name, "date": [START + dt.timedelta(days=i) for i in range(len(values))], "value": values})


@pytest.fixture(scope="module")
def forecast(spark):
    rng = np.random.default_rng(3)
    t = np.arange(1000.0)
    week = 4 * np.sin(2 * np.pi * t / 7)
    clean = 100 + 0.1 * t + week
    kinked = 50 + 0.05 * t + 0.4 * np.maximum(t - 300, 0) - 0.6 * np.maximum(t - 620, 0) + week
    frames = [
        series("straight", clean + rng.normal(0, 1, 1000)), series("kinked", kinked + rng.normal(0, 1, 1000)), series("exact", clean), series("short", [5.0, 7.0, 6.0]), series("one", [3.0]),
        series("flat", np.zeros(100)),
    ]
    df = spark.createDataFrame(pd.concat(frames), "kpi string, date date, value double").repartition(5)
    return kpi.kpi_forecast(df, 30).toPandas(), kinked


def test_planted_changes_are_found(forecast):
    found = forecast[0].groupby("kpi")["changes"].first()
    days = [(d - START).days for d in found["kinked"]]
    assert len(days) == 2 and abs(days[0] - 300) <= 5 and abs(days[1] - 620) <= 5
    assert len(found["straight"]) == 0 and len(found["exact"]) == 0 and len(found["flat"]) == 0


def test_fitted_values(forecast):
    out, kinked = forecast
    fit = out[(out["kpi"] == "kinked") & out["actual"].notna()].sort_values("date")["forecast"].to_numpy()
    assert np.abs(fit - kinked).max() < 1.0
    exact = out[(out["kpi"] == "exact")].sort_values("date")["forecast"].to_numpy()
    t = np.arange(1030.0)
    assert np.allclose(exact, 100 + 0.1 * t + 4 * np.sin(2 * np.pi * t / 7), atol=1e-6)
    short = out[out["kpi"] == "short"].sort_values("date")["forecast"].to_numpy()
    assert np.allclose(short[:3], [5.5, 6.0, 6.5])
    assert np.allclose(out[out["kpi"] == "one"]["forecast"], 3.0) and np.allclose(out[out["kpi"] == "flat"]["forecast"], 0.0)


def test_intervals_widen_where_slopes_have_changed(forecast):
    out = forecast[0]
    width = (out["upper"] - out["lower"]).where(out["actual"].isna())
    ahead = out.assign(width=width)[out["actual"].isna()].sort_values("date").groupby("kpi")["width"]
    assert ahead.last()["kinked"] > 1.1 * ahead.first()["kinked"]  # about six paths in a hundred change within the month
    assert abs(ahead.last()["straight"] - ahead.first()["straight"]) < 1e-9
    past = out[out["actual"].notna() & out["kpi"].isin(["kinked", "straight"])]
    inside = (past["actual"] >= past["lower"]) & (past["actual"] <= past["upper"])
    assert 0.93 < inside.mean() < 0.98


def test_penalty_selects_from_products():
    rng = np.random.default_rng(0)
    t = np.linspace(0, 1, 800)
    knots = np.linspace(0, 0.8, 26)[1:]
    x = np.hstack([np.ones((800, 1)), t[:, None], np.zeros((800, kpi._BASE - 2))])
    y = 1 + 2 * np.maximum(t - knots[9], 0) + rng.normal(0, 0.02, 800)
    z = np.column_stack([kpi._with_hinges(x, knots), y])
    places = kpi.change_places(z.T @ z, knots, 800)
    assert any(abs(p - knots[9]) < 0.03 for p in places)
