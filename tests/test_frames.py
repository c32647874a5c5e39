"""Ordered frames cut into blocks with copied edges equal the plain windows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from brightloom.operators import timeseries as ts
from brightloom.operators.ranking import framed


@pytest.fixture(scope="module")
def series(spark):
    """One long key, short keys, a null key and null values."""
    d = spark.range(5000).select(
        F.when(F.col("id") < 4000, "long").when(F.col("id") < 4990, F.concat(F.lit("k"), (F.col("id") % 200).cast("string"))).alias("k"),
        F.expr("date'1990-01-01' + cast(id as int)").alias("day"), F.when(F.col("id") % 11 != 0, F.pmod(F.xxhash64("id"), F.lit(1000))).cast("double").alias("x"),
    )
    return d.cache()


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("block", [1, 7, 64, 100_000])
@pytest.mark.parametrize("by", [(), ("k",)])
def test_blocks_equal_plain_windows(series, by, block):
    def columns(w):
        return {"s": F.sum("x").over(w.rowsBetween(-3, 2)), "p": F.lag("x", 3).over(w), "n": F.lead("x", 2).over(w), "c": F.count("*").over(w.rowsBetween(-3, 2))}

    w = Window.partitionBy(*by).orderBy("day")
    want = series.withColumns(columns(w)).withColumn("i", F.row_number().over(w) - 1)
    got = framed(series, "day", columns, before=3, after=2, by=by, position="i", block=block)
    assert rows(got.select(want.columns)) == rows(want)


def test_text_order(spark):
    d = spark.range(300).select(F.md5(F.col("id").cast("string")).alias("t"), "id")
    w = Window.orderBy("t")
    got = framed(d, "t", lambda w: {"p": F.lag("id").over(w)}, before=1, block=20)
    assert rows(got) == rows(d.withColumn("p", F.lag("id").over(w)))


def test_empty(spark):
    d = spark.createDataFrame([], "day date, x double")
    assert ts.rolling_mean_std(d, "day", "x").count() == 0
    assert ts.running_total(d, "day", "x").count() == 0


@pytest.mark.parametrize("by", [(), ("k",)])
def test_running_total(series, by):
    w = Window.partitionBy(*by).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    assert rows(ts.running_total(series, "day", "x", by)) == rows(series.withColumn("running_total", F.sum("x").over(w)))


def test_long_series(spark):
    """A one-key series of 10 million rows: every value of a frame follows from its position."""
    d = spark.range(10_000_000).select("id", (F.col("id") * 2.0).alias("x"))
    out = ts.rolling_mean_std(d, "id", "x", size=7)
    wrong = out.filter(F.when(F.col("id") < 6, F.col("rolling_mean").isNotNull()).otherwise((F.col("rolling_mean") != (F.col("id") - 3) * 2.0) | F.col("rolling_mean").isNull()))
    assert wrong.count() == 0 and out.count() == 10_000_000
