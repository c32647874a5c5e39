"""Cleaning on small frames shaped like the sample files."""

import random

from pyspark.sql import functions as F

from brightloom.operators import quality

PEOPLE = [
    ("Ann Lee", 34, "Boston", 10), ("Bob Ray", None, "Boston", 20), ("Cy Poe", 40, "Bostn", 30), ("Di Fox", 28, None, 40),
    ("Ed Kay", 31, "Denver", 50), ("Flo Orr", None, "Denver", 60), ("Gus Ito", 52, "Boston", 70),
]
SCHEMA = "name string, age long, city string, salary long"


def test_impute_and_typo(spark):
    df = spark.createDataFrame(PEOPLE, SCHEMA)
    out = {r["name"]: r for r in quality.clean_dataset(df, ["city"], ["age"]).collect()}
    assert out["Cy Poe"]["city"] == "Boston" and out["Di Fox"]["city"] == "Boston"
    assert out["Bob Ray"]["age"] == (34 + 40 + 28 + 31 + 52) / 5


def test_mode_tie_goes_to_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("a",)], "c string")
    assert {r["c"] for r in quality.impute_mean_mode(df, [], ["c"]).filter("c = 'a'").groupBy("c").count().collect()} == {"a"}
    assert quality.impute_mean_mode(df, [], ["c"]).filter("c = 'a'").count() == 3


def _lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def test_corrections_match_brute_force(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 5))): rng.randint(1, 20) for _ in range(60)}
    df = spark.createDataFrame([(w,) for w, n in words.items() for _ in range(n)], "w string")
    for d in (1, 2):
        want = {}
        for v, n in words.items():
            near = [(-m, w) for w, m in words.items() if w != v and m >= 2 * n and _lev(v, w) <= d]
            if near:
                want[v] = min(near)[1]
        got = {r["old"]: r["new"] for r in quality.propose_corrections(df, "w", d).collect()}
        assert got == want


def test_column_report_finds_odd_shapes(spark):
    rows = [(f"A-{i}", float(i % 7)) for i in range(60)] + [("??", 1000.0)]
    out = quality.column_anomaly_report(spark.createDataFrame(rows, "code string, v double")).filter("suspicious").collect()
    assert {(r["column"], r["item"]) for r in out} == {("code", "??"), ("v", "high")}


def test_cleaning_log_and_overview(spark):
    df = spark.createDataFrame(PEOPLE, SCHEMA)
    log = quality.cleaning_log(df, {("fill", "city"): (F.col("city"), F.coalesce("city", F.lit("x")))}).first()
    assert (log["step"], log["column"], log["n_changed"]) == ("fill", "city", 1)
    view = {r["column"]: r for r in quality.dataset_overview(df.withColumn("signup_month", F.lit(3))).collect()}
    assert view["signup_month"]["is_temporal"] and not view["age"]["is_temporal"]
    assert (view["age"]["n_missing"], view["city"]["n_unique"], view["city"]["kind"]) == (2, 3, "categorical")


def test_metrics_of_empty_table(spark):
    out = {(r["column"], r["metric"]): r["value"] for r in quality.data_quality_metrics(spark.createDataFrame([], SCHEMA)).collect()}
    assert out[("*", "row_count")] == 0 and out[("*", "duplicate_rows")] == 0 and out[("age", "mean")] is None
