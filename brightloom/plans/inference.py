"""Inferential statistics. p-values have unit tests of their own; the rest is compared with DuckDB."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightloom.functions.numeric import rounded
from brightloom.operators import inference as st
from brightloom.plans.common import table
from brightloom.registry import query


def _r(df, *cols, digits=6):
    return df.withColumns({c: rounded(c, digits) for c in cols})


_TWO = """m AS (SELECT count(*) FILTER (g = 'F') AS n_a, count(*) FILTER (g = 'O') AS n_b, avg(x) FILTER (g = 'F') AS mean_a,
  avg(x) FILTER (g = 'O') AS mean_b, var_samp(x) FILTER (g = 'F') AS va, var_samp(x) FILTER (g = 'O') AS vb
  FROM (SELECT o_orderstatus AS g, o_totalprice AS x FROM orders)),
 q AS (SELECT *, ((n_a - 1) * va + (n_b - 1) * vb) / (n_a + n_b - 2) AS pv FROM m)"""


@query(
    "ttest_independent",
    f"""WITH {_TWO} SELECT n_a, n_b, round(mean_a, 4) AS mean_a, round(mean_b, 4) AS mean_b,
        round((mean_a - mean_b) / sqrt(pv * (1 / n_a + 1 / n_b)), 6) AS t, n_a + n_b - 2 AS dof FROM q""",
)
def ttest_independent(spark, sf):
    out = st.ttest_independent(table(spark, sf, "orders"), "o_totalprice", "o_orderstatus", "F", "O").drop("p")
    return _r(_r(out, "t"), "mean_a", "mean_b", digits=4)


@query(
    "ttest_paired",
    """SELECT count(*) AS n, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS std, round(avg(x) / (stddev_samp(x) / sqrt(count(*))), 6) AS t,
       count(*) - 1 AS dof FROM (SELECT l_extendedprice - l_extendedprice * (1 - l_discount) AS x FROM lineitem)""",
)
def ttest_paired(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return _r(_r(st.ttest_paired(li, "l_extendedprice", "net").drop("p"), "t"), "mean", "std", digits=4)


@query(
    "ttest_one_sample",
    """SELECT count(*) AS n, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS std,
       round((avg(l_quantity) - 25) / (stddev_samp(l_quantity) / sqrt(count(*))), 6) AS t, count(*) - 1 AS dof FROM lineitem""",
)
def ttest_one_sample(spark, sf):
    return _r(st.ttest_one_sample(table(spark, sf, "lineitem"), "l_quantity", 25.0).drop("p"), "mean", "std", "t")


_CHI = """c AS (SELECT l_returnflag AS a, l_linestatus AS b, count(*) AS o FROM lineitem GROUP BY ALL),
 e AS (SELECT *, (sum(o) OVER (PARTITION BY a))::DOUBLE * (sum(o) OVER (PARTITION BY b)) / (sum(o) OVER ()) AS e FROM c)"""


@query(
    "chi_square_independence",
    f"""WITH {_CHI} SELECT round(sum((o - e) * (o - e) / e), 6) AS chi2, CAST((count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS BIGINT) AS dof,
        CAST(sum(o) AS BIGINT) AS n, round(exp(-sum((o - e) * (o - e) / e) / 2), 6) AS p FROM e""",  # two degrees of freedom
)
def chi_square_independence(spark, sf):
    return _r(st.chi_square_independence(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus"), "chi2", "p")


@query("chi_square_expected", f"WITH {_CHI} SELECT a AS l_returnflag, b AS l_linestatus, o AS n, round(e, 6) AS expected FROM e")
def chi_square_expected(spark, sf):
    return _r(st.contingency_expected(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus"), "expected")


@query(
    "anova_oneway",
    """WITH g AS (SELECT o_orderpriority, count(*) AS n, avg(o_totalprice) AS m, var_pop(o_totalprice) AS v FROM orders GROUP BY 1),
       s AS (SELECT sum(n * pow(m - (SELECT avg(o_totalprice) FROM orders), 2)) AS b, sum(n * v) AS w, count(*) - 1 AS df_between,
             CAST(sum(n) - count(*) AS BIGINT) AS df_within FROM g)
       SELECT round((b / df_between) / (w / df_within), 6) AS f, df_between, df_within FROM s""",
)
def anova_oneway(spark, sf):
    return _r(st.anova_oneway(table(spark, sf, "orders"), "o_totalprice", "o_orderpriority").drop("p"), "f")


@query(
    "normality_test",
    """WITH m AS (SELECT count(*)::DOUBLE AS n, skewness(l_extendedprice) * (count(*) - 2) / sqrt(count(*)::DOUBLE * (count(*) - 1)) AS g1,
           kurtosis_pop(l_extendedprice) + 3 AS b2 FROM lineitem),
       a AS (SELECT *, g1 * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y,
           sqrt(2 * (3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) - 1)) - 1 AS w2,
           (b2 - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))) AS x,
           6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS rb FROM m),
       b AS (SELECT *, asinh(y / sqrt(2 / (w2 - 1))) / sqrt(0.5 * ln(w2)) AS z1, 6 + 8 / rb * (2 / rb + sqrt(1 + 4 / (rb * rb))) AS a FROM a),
       c AS (SELECT *, 1 + x * sqrt(2 / (a - 4)) AS den FROM b),
       d AS (SELECT *, (1 - 2 / (9 * a) - sign(den) * cbrt((1 - 2 / a) / abs(den))) / sqrt(2 / (9 * a)) AS z2 FROM c)
       SELECT CAST(n AS BIGINT) AS n, round(z1, 6) AS z_skew, round(z2, 6) AS z_kurtosis, round(z1 * z1 + z2 * z2, 4) AS k2,
              round(exp(-(z1 * z1 + z2 * z2) / 2), 8) AS p FROM d""",
)
def normality_test(spark, sf):
    out = _r(st.normality_test(table(spark, sf, "lineitem"), "l_extendedprice"), "z_skew", "z_kurtosis")
    return out.withColumns({"k2": rounded("k2", 4), "p": rounded("p", 8)})


@query(
    "pearson_spearman",
    """WITH r AS (SELECT l_quantity AS a, l_extendedprice AS b, rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2 AS ra,
           rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2 AS rb FROM lineitem)
       SELECT count(*) AS n, round(corr(a, b), 6) AS pearson, round(corr(ra, rb), 6) AS spearman FROM r""",
)
def pearson_spearman(spark, sf):
    out = st.pearson_spearman(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return _r(out.drop("pearson_p", "spearman_p"), "pearson", "spearman")


@query(
    "kendall_tau",
    """WITH c AS (SELECT p_size AS x, CAST(floor(p_retailprice / 10) AS INTEGER) AS y, count(*) AS n FROM part GROUP BY ALL),
       s AS (SELECT sum(a.n * b.n) FILTER (a.y < b.y) AS c, sum(a.n * b.n) FILTER (a.y > b.y) AS d FROM c a JOIN c b ON a.x < b.x),
       tx AS (SELECT sum(t * (t - 1) / 2) AS p FROM (SELECT sum(n) AS t FROM c GROUP BY x)),
       ty AS (SELECT sum(t * (t - 1) / 2) AS p FROM (SELECT sum(n) AS t FROM c GROUP BY y)), k AS (SELECT sum(n) AS n FROM c)
       SELECT CAST(k.n AS BIGINT) AS n, CAST(c AS BIGINT) AS concordant, CAST(d AS BIGINT) AS discordant,
              round((c - d) / sqrt((k.n * (k.n - 1) / 2 - tx.p) * (k.n * (k.n - 1) / 2 - ty.p)), 6) AS tau FROM s, tx, ty, k""",
)
def kendall_tau(spark, sf):
    p = table(spark, sf, "part").select("p_size", F.floor(F.col("p_retailprice") / 10).cast("int").alias("bin"))
    return _r(st.kendall_tau(p, "p_size", "bin").drop("p"), "tau")


@query("cohens_d", f"WITH {_TWO} SELECT round((mean_a - mean_b) / sqrt(pv), 6) AS d FROM q")
def cohens_d(spark, sf):
    return _r(st.cohens_d(table(spark, sf, "orders"), "o_totalprice", "o_orderstatus", "F", "O"), "d")


@query(
    "odds_risk_ratio",
    """WITH c AS (SELECT count(*) FILTER (e AND o) AS a, count(*) FILTER (e AND NOT o) AS b, count(*) FILTER (NOT e AND o) AS c,
           count(*) FILTER (NOT e AND NOT o) AS d FROM (SELECT l_discount > 0.05 AS e, l_returnflag = 'R' AS o FROM lineitem))
       SELECT a, b, c, d, round(a::DOUBLE * d / (b::DOUBLE * c), 6) AS odds_ratio, round((a / (a + b)) / (c / (c + d)), 6) AS risk_ratio FROM c""",
)
def odds_risk_ratio(spark, sf):
    out = st.odds_risk_ratio(table(spark, sf, "lineitem"), F.col("l_discount") > 0.05, F.col("l_returnflag") == "R")
    return _r(out, "odds_ratio", "risk_ratio")


@query(
    "ab_test",
    """WITH u AS (SELECT user_id, sum(value) AS x, md5(CAST(user_id AS VARCHAR)) < '8' AS a FROM events GROUP BY user_id),
       m AS (SELECT count(*) FILTER (a) AS n_a, count(*) FILTER (NOT a) AS n_b, avg(x) FILTER (a) AS ma, avg(x) FILTER (NOT a) AS mb,
             var_samp(x) FILTER (a) AS va, var_samp(x) FILTER (NOT a) AS vb FROM u),
       q AS (SELECT *, ((n_a - 1) * va + (n_b - 1) * vb) / (n_a + n_b - 2) AS pv FROM m)
       SELECT n_a, n_b, round(ma, 4) AS mean_a, round(mb, 4) AS mean_b, round((ma - mb) / sqrt(pv * (1 / n_a + 1 / n_b)), 6) AS t,
              n_a + n_b - 2 AS dof, round((ma - mb) / sqrt(pv), 6) AS effect_size FROM q""",
)
def ab_test(spark, sf):
    users = table(spark, sf, "events").groupBy("user_id").agg(F.sum("value").alias("x"))
    arm = F.when(F.md5(F.col("user_id").cast("string")) < "8", "a").otherwise("b")
    out = st.ab_test(users.withColumn("arm", arm), "x", "arm", "a", "b").drop("p", "significant")
    return _r(_r(out, "t", "effect_size"), "mean_a", "mean_b", digits=4)


@query(
    "sampling_methods",
    """WITH c AS (SELECT c_custkey, c_mktsegment, c_nationkey, md5(CAST(c_custkey AS VARCHAR)) AS h, row_number() OVER (ORDER BY c_custkey) AS i FROM customer),
       k AS (SELECT c_nationkey FROM customer GROUP BY 1 ORDER BY md5(CAST(c_nationkey AS VARCHAR)), 1 LIMIT 3)
       SELECT * FROM (SELECT 'simple' AS method, c_custkey FROM c ORDER BY h, c_custkey LIMIT 100)
       UNION ALL SELECT 'stratified', c_custkey FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY h, c_custkey) AS r FROM c) WHERE r <= 20
       UNION ALL SELECT 'cluster', c_custkey FROM c WHERE c_nationkey IN (SELECT c_nationkey FROM k)
       UNION ALL SELECT 'systematic', c_custkey FROM c WHERE (i - 1) % 10 = 0""",
)
def sampling_methods(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    parts = {
        "simple": st.simple_random_sample(c, "c_custkey", 100), "stratified": st.stratified_sample(c, "c_custkey", ["c_mktsegment"], 20),
        "cluster": st.cluster_sample(c, "c_nationkey", 3), "systematic": st.systematic_sample(c, "c_custkey", 10),
    }
    out = None
    for name, df in parts.items():
        df = df.select(F.lit(name).alias("method"), "c_custkey")
        out = df if out is None else out.unionByName(df)
    return out
