"""Inferential statistics. Each test is a distributed moment or count pass; the result is one row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightloom.functions.numeric import safe_ratio
from brightloom.functions.pvalues import chi2_upper, f_upper, normal_two_sided, t_two_sided
from brightloom.operators.ranking import dense_ranks, range_count, running_totals, split_row_number, value_ranges, with_stats
from brightloom.session import measured


def _two_groups(df: DataFrame, value: str, group: str, a, b) -> DataFrame:
    aggs = []
    for s, g in (("a", a), ("b", b)):
        x = F.when(F.col(group) == g, F.col(value))
        aggs += [F.count(x).alias(f"n_{s}"), F.avg(x).alias(f"mean_{s}"), F.var_samp(x).alias(f"var_{s}")]
    out = df.filter(F.col(group).isin(a, b)).agg(*aggs)
    dof = F.col("n_a") + F.col("n_b") - 2
    pooled = ((F.col("n_a") - 1) * F.col("var_a") + (F.col("n_b") - 1) * F.col("var_b")) / dof
    return out.withColumns({"dof": dof, "pooled_var": pooled, "difference": F.col("mean_a") - F.col("mean_b")})


def ttest_independent(df: DataFrame, value: str, group: str, a, b) -> DataFrame:
    """Pooled-variance t test: group sizes and means, t, dof, p."""
    m = _two_groups(df, value, group, a, b)
    se = F.sqrt(F.col("pooled_var") * (1 / F.col("n_a") + 1 / F.col("n_b")))
    m = m.withColumn("t", safe_ratio(F.col("difference"), se))
    return m.select("n_a", "n_b", "mean_a", "mean_b", "t", "dof").withColumn("p", t_two_sided(F.col("t"), F.col("dof")))


def cohens_d(df: DataFrame, value: str, group: str, a, b) -> DataFrame:
    m = _two_groups(df, value, group, a, b)
    return m.select(safe_ratio(F.col("difference"), F.sqrt("pooled_var")).alias("d"))


def ttest_one_sample(df: DataFrame, value: str | Column, mu: float = 0.0) -> DataFrame:
    x = F.col(value) if isinstance(value, str) else value
    m = df.agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"))
    m = m.withColumns(
        {"t": safe_ratio(F.col("mean") - mu, F.col("std") / F.sqrt(F.col("n").cast("double"))), "dof": F.col("n") - 1}
    )
    return m.withColumn("p", t_two_sided(F.col("t"), F.col("dof")))


def ttest_paired(df: DataFrame, a: str, b: str) -> DataFrame:
    """t test on the row-wise differences ``a - b``."""
    return ttest_one_sample(df, F.col(a) - F.col(b), 0.0)


def contingency_expected(df: DataFrame, a: str, b: str) -> DataFrame:
    """Long contingency table ``(a, b, n, expected)``, cells without rows included."""
    cells = measured(df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count("*").alias("n")))
    cols = cells.groupBy(b).agg(F.sum("n").alias("c"))
    margin = cols.agg(F.collect_list(F.struct(b, "c"))).scalar()  # one entry per level of b
    total = cols.agg(F.sum("c")).scalar()
    grid = cells.groupBy(a).agg(F.sum("n").alias("r")).select(a, "r", F.inline(margin))
    out = grid.join(cells, [a, b], "left")
    return out.select(a, b, F.coalesce("n", F.lit(0)).alias("n"), (F.col("r") * F.col("c") / total).alias("expected"))


def chi_square_independence(df: DataFrame, a: str, b: str) -> DataFrame:
    """``(chi2, dof, n, p)``; a 2×2 table gets the continuity correction.

    Empty cells need no rows: the statistic is Σ O²/E - n over the observed cells.
    """
    cells = measured(df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count("*").alias("o")))
    total = cells.agg(F.sum("o")).scalar()
    rows = cells.groupBy(a).agg(F.sum("o").alias("r"))
    cols = cells.groupBy(b).agg(F.sum("o").alias("c"))
    e = F.col("r") * F.col("c") / total
    o = F.col("o").cast("double")
    stat = (
        cells.join(rows, a).join(cols, b)
        .agg(F.sum(o * o / e).alias("s"), F.sum("o").cast("double").alias("n"), F.max(F.abs(o - e)).alias("gap"))
    )
    stat = with_stats(stat, rows.agg(F.struct(F.count("*").alias("k"), F.sum(1 / F.col("r")).alias("inv"))), "__r")
    stat = with_stats(stat, cols.agg(F.struct(F.count("*").alias("k"), F.sum(1 / F.col("c")).alias("inv"))), "__c")
    shape_r, shape_c = F.col("__r"), F.col("__c")
    left = F.col("gap") - F.least(F.lit(0.5), F.col("gap"))
    corrected = left * left * F.col("n") * shape_r["inv"] * shape_c["inv"]
    two = (shape_r["k"] == 2) & (shape_c["k"] == 2)
    out = stat.select(
        F.when(two, corrected).otherwise(F.col("s") - F.col("n")).alias("chi2"),
        ((shape_r["k"] - 1) * (shape_c["k"] - 1)).alias("dof"), F.col("n").cast("long").alias("n"),
    )
    return out.withColumn("p", chi2_upper(F.col("chi2"), F.col("dof")))


def anova_oneway(df: DataFrame, value: str, group: str) -> DataFrame:
    """``(f, df_between, df_within, p)`` from the moments of every group."""
    per = df.filter(F.col(value).isNotNull() & F.col(group).isNotNull()).groupBy(group).agg(
        F.count(value).alias("n"), F.avg(value).alias("m"), F.var_pop(value).alias("v")
    )
    mean = per.agg(F.sum(F.col("n") * F.col("m")) / F.sum("n")).scalar()
    out = per.agg(
        F.sum(F.col("n") * F.pow(F.col("m") - mean, 2)).alias("between"), F.sum(F.col("n") * F.col("v")).alias("within"),
        (F.count("*") - 1).alias("df_between"), (F.sum("n") - F.count("*")).alias("df_within"),
    )
    f = safe_ratio(F.col("between") / F.col("df_between"), F.col("within") / F.col("df_within"))
    out = out.select(f.alias("f"), "df_between", "df_within")
    return out.withColumn("p", f_upper(F.col("f"), F.col("df_between"), F.col("df_within")))


def normality_test(df: DataFrame, value: str) -> DataFrame:
    """D'Agostino-Pearson K² from skewness and kurtosis: ``(n, z_skew, z_kurtosis, k2, p)``."""
    m = df.agg(
        F.count(value).cast("double").alias("n"), F.skewness(value).alias("g1"), (F.kurtosis(value) + 3).alias("b2")
    )
    n = F.col("n")
    y = F.col("g1") * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta2 = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (beta2 - 1)) - 1
    z1 = F.asinh(y / F.sqrt(2 / (w2 - 1))) / F.sqrt(0.5 * F.log(w2))
    centre = 3 * (n - 1) / (n + 1)
    var = 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (F.col("b2") - centre) / F.sqrt(var)
    root_b1 = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / root_b1 * (2 / root_b1 + F.sqrt(1 + 4 / (root_b1 * root_b1)))
    den = 1 + x * F.sqrt(2 / (a - 4))
    z2 = (1 - 2 / (9 * a) - F.signum(den) * F.cbrt((1 - 2 / a) / F.abs(den))) / F.sqrt(2 / (9 * a))
    out = m.select(n.cast("long").alias("n"), z1.alias("z_skew"), z2.alias("z_kurtosis"))
    out = out.withColumn("k2", F.col("z_skew") * F.col("z_skew") + F.col("z_kurtosis") * F.col("z_kurtosis"))
    return out.withColumn("p", F.exp(-F.col("k2") / 2))


def average_ranks(df: DataFrame, c: str) -> DataFrame:
    """``(c, rank)`` per distinct value, ties share the mean rank. Values are ordered in independent ranges."""
    counts = df.groupBy(c).agg(F.count("*").alias("__n"))
    ahead = running_totals(value_ranges(counts, c), [F.asc(c)], F.col("__range"), {"__before": F.col("__n")})
    return ahead.select(c, (F.col("__before") + (F.col("__n") + 1) / 2).alias("rank"))


def pearson_spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """``(n, pearson, pearson_p, spearman, spearman_p)`` over rows where both are present."""
    d = df.select(F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b")).na.drop()
    cells = d.groupBy("a", "b").agg(F.count("*").alias("n"))
    ra, rb = average_ranks(d.select("a"), "a").withColumnRenamed("rank", "ra"), average_ranks(d.select("b"), "b").withColumnRenamed("rank", "rb")
    n, x, y = F.col("n"), F.col("ra") - F.col("__mid"), F.col("rb") - F.col("__mid")
    ranks = with_stats(cells.join(ra, "a").join(rb, "b"), d.agg((F.count("*") + 1) / 2), "__mid").agg(
        (F.sum(n * x * y) / F.sqrt(F.sum(n * x * x) * F.sum(n * y * y))).alias("spearman")
    )
    out = d.agg(F.count("*").alias("n"), F.corr("a", "b").alias("pearson")).withColumn("spearman", ranks.scalar())
    dof = F.col("n") - 2

    def p(r: Column) -> Column:
        return F.when(F.abs(r) < 1, t_two_sided(r * F.sqrt(dof / (1 - r * r)), dof)).when(F.abs(r) >= 1, F.lit(0.0))

    return out.withColumns({"pearson_p": p(F.col("pearson")), "spearman_p": p(F.col("spearman"))})


def kendall_tau(df: DataFrame, x: str, y: str) -> DataFrame:
    """Kendall's τ-b of two ordered columns: ``(n, concordant, discordant, tau, p)``.

    Pairs are counted by bits of the rank of y: two different ranks first differ in one bit, so a pair is ordered by that
    bit among the cells that share the bits above it. Per bit and shared prefix, counts per x are summed over all smaller x
    by split running totals. The work is the number of (x, y) cells times the bits of the number of levels; pairs
    are never formed.
    """
    cells = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(F.col(x).alias("x"), F.col(y).alias("y")).agg(F.count("*").cast("double").alias("n"))
    cells = measured(cells)
    xs, ys = measured(dense_ranks(cells, "x", "rx")), measured(dense_ranks(cells, "y", "ry"))
    size = {"x": xs.count(), "y": ys.count()}
    bits = max(1, (size["y"] - 1).bit_length())
    ranked = cells.join(xs, "x").join(ys, "y").select("rx", "ry", "n", F.explode(F.sequence(F.lit(0), F.lit(bits - 1))).alias("bit"))
    one = F.expr("shiftright(ry, bit) & 1") == 1
    sums = ranked.groupBy("bit", F.expr("shiftright(ry, bit + 1)").alias("prefix"), "rx").agg(
        F.coalesce(F.sum(F.when(~one, F.col("n"))), F.lit(0.0)).alias("n0"), F.coalesce(F.sum(F.when(one, F.col("n"))), F.lit(0.0)).alias("n1")
    )
    spot = F.floor(F.col("rx") * range_count(cells.count()) / max(size["x"], 1))
    ahead = running_totals(sums, [F.asc("rx")], spot, {"b0": F.col("n0"), "b1": F.col("n1")}, ["bit", "prefix"])
    zero = F.lit(0.0)
    pairs = ahead.agg(
        F.struct(F.coalesce(F.sum(F.col("n1") * F.col("b0")), zero).alias("concordant"), F.coalesce(F.sum(F.col("n0") * F.col("b1")), zero).alias("discordant"))
    )
    out = with_stats(cells.agg(F.sum("n").alias("n")), pairs, "pairs").select("n", "pairs.concordant", "pairs.discordant")

    def ties(c: str) -> DataFrame:
        t = F.col("t")
        per = cells.groupBy(c).agg(F.sum("n").alias("t"))
        return per.agg(
            F.struct(
                F.sum(t * (t - 1) / 2).alias("pairs"), F.sum(t * (t - 1) * (t - 2)).alias("triples"),
                F.sum(t * (t - 1) * (2 * t + 5)).alias("spread"),
            )
        )

    out = with_stats(with_stats(out, ties("x"), "tx"), ties("y"), "ty")
    tx, ty, n = F.col("tx"), F.col("ty"), F.col("n")
    all_pairs, m = n * (n - 1) / 2, n * (n - 1)
    s = F.col("concordant") - F.col("discordant")
    tau = safe_ratio(s, F.sqrt((all_pairs - tx["pairs"]) * (all_pairs - ty["pairs"])))
    var = (m * (2 * n + 5) - tx["spread"] - ty["spread"]) / 18 + 2 * tx["pairs"] * ty["pairs"] / m + tx["triples"] * ty["triples"] / (
        9 * m * (n - 2)
    )
    return out.select(
        n.cast("long").alias("n"), F.col("concordant").cast("long").alias("concordant"), F.col("discordant").cast("long").alias("discordant"),
        tau.alias("tau"), normal_two_sided(s / F.sqrt(var)).alias("p"),
    )


def odds_risk_ratio(df: DataFrame, exposed: Column, outcome: Column) -> DataFrame:
    """2×2 counts (a: exposed with outcome, b: exposed without, c, d: unexposed) and both ratios."""
    out = df.agg(
        F.count_if(exposed & outcome).alias("a"), F.count_if(exposed & ~outcome).alias("b"),
        F.count_if(~exposed & outcome).alias("c"), F.count_if(~exposed & ~outcome).alias("d"),
    )
    a, b, c, d = (F.col(x).cast("double") for x in "abcd")
    return out.withColumns({"odds_ratio": F.try_divide(a * d, b * c), "risk_ratio": F.try_divide(a * (c + d), c * (a + b))})


def ab_test(df: DataFrame, value: str, group: str, a, b, alpha: float = 0.05) -> DataFrame:
    """``(t, p, significant, effect_size)`` of group ``a`` against ``b``."""
    m = _two_groups(df, value, group, a, b)
    se = F.sqrt(F.col("pooled_var") * (1 / F.col("n_a") + 1 / F.col("n_b")))
    m = m.withColumns(
        {"t": safe_ratio(F.col("difference"), se), "effect_size": safe_ratio(F.col("difference"), F.sqrt("pooled_var"))}
    )
    m = m.withColumn("p", t_two_sided(F.col("t"), F.col("dof")))
    return m.select("n_a", "n_b", "mean_a", "mean_b", "t", "dof", "p", (F.col("p") < alpha).alias("significant"), "effect_size")


def _digest(key: str) -> Column:
    return F.md5(F.col(key).cast("string"))


def simple_random_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """``n`` rows in md5 order of the key: repeatable, uniform, a top-n without a full sort."""
    return df.orderBy(_digest(key), key).limit(n)


def stratified_sample(df: DataFrame, key: str, strata: Sequence[str], n: int) -> DataFrame:
    """``n`` rows per stratum; the per-stratum limit also runs before the shuffle."""
    w = Window.partitionBy(*strata).orderBy(_digest(key), key)
    return df.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= n).drop("__r")


def cluster_sample(df: DataFrame, cluster: str, n: int) -> DataFrame:
    """All rows of ``n`` clusters."""
    chosen = df.select(cluster).distinct().orderBy(_digest(cluster), cluster).limit(n)
    return df.join(F.broadcast(chosen), cluster, "left_semi")  # exactly n keys


def systematic_sample(df: DataFrame, key: str, step: int) -> DataFrame:
    """Every ``step``-th row in key order, by a row number that is computed in independent key ranges."""
    numbered = split_row_number(value_ranges(df, key), [F.asc(key)], F.col("__range"), (), "__r")
    return numbered.filter((F.col("__r") - 1) % step == 0).drop("__r", "__range")
