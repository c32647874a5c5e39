"""Distinct and duplicate counts by fingerprints, phrases with pruning, and what the small-input helpers do."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from brightloom import session
from brightloom.operators import kpi, profile, quality, text


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


ROWS = [(1, "a", None, 0.0), (1, None, "a", -0.0), (None, "a", "b", float("nan")), (None, "ab", "", float("nan")), (2, "a", "b", None), (1, "a", None, 0.0), (1, "a", None, -0.0)]


def test_distinct_counts(spark):
    df = spark.createDataFrame(ROWS, "i int, s string, t string, x double").withColumn("d", F.array("i"))
    got = {r["column"]: r["n_unique"] for r in profile.count_distinct(df, df.columns).collect()}
    want = df.agg(*[F.count_distinct(c).alias(c) for c in df.columns]).first().asDict()
    assert got == want
    counted = profile.count_distinct(df, df.columns)
    assert "Expand" not in plan(counted)
    none = {r["column"]: r["n_unique"] for r in profile.count_distinct(df.limit(0), ["i", "s"]).collect()}
    assert none == {"i": 0, "s": 0}


def test_duplicate_counts_tell_nulls_and_borders(spark):
    df = spark.createDataFrame(ROWS + [(None, "b", "a", None), (None, "", "ab", None), (None, None, None, None)] * 2, "i int, s string, t string, x double")
    got = profile.count_duplicates(df).first().asDict()
    n = df.distinct().count()
    assert got == {"n_rows": 13, "n_unique": n, "n_duplicates": 13 - n}
    assert profile.count_duplicates(df.limit(0)).first().asDict() == {"n_rows": 0, "n_unique": 0, "n_duplicates": 0}


def test_overview_and_metrics_use_them(spark):
    df = spark.createDataFrame(ROWS, "i int, s string, t string, x double")
    assert {r["column"]: (r["n_missing"], r["n_unique"]) for r in quality.dataset_overview(df).collect()} == {"i": (2, 2), "s": (1, 2), "t": (3, 3), "x": (1, 2)}


def test_cleaning_reports_what_is_left(spark):
    rows = [(i, "alpha" if i % 2 else "beta", 10.0 + i % 3) for i in range(60)] + [(100, "alpxa", 11.0), (101, None, None), (102, "b7ta", 900.0)]
    clean, report = quality.clean_and_report(spark.createDataFrame(rows, "id int, s string, x double"), ["s"], ["x"])
    assert {r["s"] for r in clean.collect()} == {"alpha", "beta"}
    bad = {(r["column"], r["item"], r["n"]) for r in report.filter("suspicious").collect()}
    assert ("x", "high", 1 + (clean.filter("id = 101").first()["x"] > 15)) in bad and not any(c == "s" for c, _, _ in bad)


def brute_phrases(texts, k, sizes, stop):
    counts = Counter()
    for t in texts:
        w = (t or "").split()
        for n in sizes:
            counts.update(" ".join(w[i : i + n]) for i in range(len(w) - n + 1) if w[i] not in stop and w[i + n - 1] not in stop)
    return sorted(counts.items(), key=lambda p: (-p[1], p[0]))[:k]


@pytest.mark.parametrize("most", [10_000, 3])
@pytest.mark.parametrize("k,sizes", [(10, (1, 2, 3)), (3, (2, 3)), (200, (1, 2, 3)), (5, (1,)), (4, (3,))])
def test_phrases_equal_brute_force(spark, k, sizes, most):
    rng = random.Random(k)
    words = ["new", "york", "the", "of", "city", "bank", "river", "tea", "x", "y", "z"]
    texts = [" ".join(rng.choices(words, [9, 8, 9, 7, 4, 3, 2, 1, 1, 1, 1], k=rng.randrange(0, 30))) for _ in range(80)] + ["new york city " * 30, "", "the of"]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    got = [(r["phrase"], r["n"]) for r in text.top_phrases(df, "t", k, sizes, ["the", "of"], most=most).orderBy(F.desc("n"), "phrase").collect()]
    assert got == brute_phrases(texts, k, sizes, {"the", "of"})


def test_stages_remove_what_is_not_kept(spark):
    def files(df):
        return [f for f in df.inputFiles() if "stage-" in f]

    with session.stages(spark):
        gone = session.measured(spark.range(3))
        kept = session.measured(spark.range(4), keep=True)
        with session.stages(spark):
            inner = session.measured(spark.range(5), keep=True)
        assert inner.count() == 5
    assert kept.count() == 4
    with pytest.raises(Exception):
        gone.collect()
    with pytest.raises(Exception):
        inner.collect()
    assert files(kept)


def test_small_inputs_are_dealt_to_all_cores(spark):
    one = session.measured(spark.range(1000).coalesce(1))
    assert "Exchange RoundRobin" in plan(session.spread(one)) and "Exchange" not in plan(session.spread(one, 0))
    assert session.small_in_parallel(one, 0) is one and session.small_in_parallel(one).count() == 1000


def test_kpis_hold_months_without_rows(spark):
    rows = [("2024-01-05", 1, 2.0), ("2024-01-06", 1, 3.0), ("2024-04-01", 2, 1.0)]
    df = spark.createDataFrame(rows, "d string, u int, v double").withColumn("d", F.to_timestamp("d"))
    rate = {str(r["date"]): r["value"] for r in kpi.order_kpis(df, "d", "v", "u").filter("kpi = 'retention_rate'").collect()}
    assert rate == {"2024-01-31": 100.0, "2024-02-29": 0.0, "2024-03-31": 0.0, "2024-04-30": 0.0}
