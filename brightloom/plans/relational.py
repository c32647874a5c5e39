"""Projections, filters, joins, aggregations, sorts, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightloom.functions.numeric import rounded, string_columns
from brightloom.operators import profile, ranking, relational
from brightloom.plans.common import doubled, null_every, table
from brightloom.registry import query

L3 = ("l_quantity", "l_extendedprice", "l_discount")


@query("select_distinct", "SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def select_distinct(spark, sf):
    return table(spark, sf, "customer").select("c_mktsegment", "c_nationkey").distinct()


@query(
    "filter_predicates",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice FROM lineitem
       WHERE l_quantity > 45 AND l_returnflag IN ('A', 'R') AND l_discount >= 0.05""",
)
def filter_predicates(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.filter(
        (F.col("l_quantity") > 45) & F.col("l_returnflag").isin("A", "R") & (F.col("l_discount") >= 0.05)
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")


@query(
    "derive_rename_columns",
    """SELECT l_orderkey AS order_id, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net,
              round(l_discount + l_tax, 4) AS rates, upper(l_returnflag) AS flag, 2 * l_quantity AS doubled FROM lineitem""",
)
def derive_rename_columns(spark, sf):
    li = table(spark, sf, "lineitem")
    return (
        li.withColumnRenamed("l_orderkey", "order_id")
        .withColumns(
            {
                "net": rounded(F.col("l_extendedprice") * (1 - F.col("l_discount"))),
                "rates": rounded(F.col("l_discount") + F.col("l_tax")),
                "flag": F.upper("l_returnflag"),
                "doubled": 2 * F.col("l_quantity"),
            }
        )
        .select("order_id", "l_linenumber", "net", "rates", "flag", "doubled")
    )


@query(
    "numeric_transforms",
    """SELECT c_custkey, round(ln(1 + greatest(c_acctbal, 0)), 6) AS c_acctbal_log,
              round(sqrt(greatest(c_acctbal, 0)), 6) AS c_acctbal_sqrt, round(c_acctbal * c_acctbal, 2) AS c_acctbal_squared
       FROM customer""",
)
def numeric_transforms(spark, sf):
    out = relational.numeric_transforms(table(spark, sf, "customer"), ["c_acctbal"])
    return out.select(
        "c_custkey", rounded("c_acctbal_log", 6).alias("c_acctbal_log"),
        rounded("c_acctbal_sqrt", 6).alias("c_acctbal_sqrt"), rounded("c_acctbal_squared", 2).alias("c_acctbal_squared"),
    )


@query(
    "numeric_interactions",
    """SELECT p_partkey, round(p_size + p_retailprice, 4) AS p_size_plus_p_retailprice,
              round(p_size - p_retailprice, 4) AS p_size_minus_p_retailprice,
              round(p_size * p_retailprice, 4) AS p_size_times_p_retailprice,
              round(p_size / (p_retailprice + 1e-6::DOUBLE), 6) AS p_size_div_p_retailprice FROM part""",
)
def numeric_interactions(spark, sf):
    out = relational.numeric_interactions(table(spark, sf, "part"), ["p_size", "p_retailprice"])
    n = "p_size_{}_p_retailprice"
    return out.select(
        "p_partkey", *[rounded(n.format(o), 4).alias(n.format(o)) for o in ("plus", "minus", "times")],
        rounded(n.format("div"), 6).alias(n.format("div")),
    )


@query(
    "categorical_interactions",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              CASE WHEN l_orderkey % 10 <> 0 THEN l_returnflag END || '_' || l_linestatus AS flag_x_l_linestatus
       FROM lineitem""",
)
def categorical_interactions(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("flag", null_every("l_orderkey", "l_returnflag"))
    out = relational.categorical_interactions(li, ["flag", "l_linestatus"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "flag_x_l_linestatus")


@query(
    "text_normalize",
    """SELECT doc_id, lower(trim(text)) AS lowered, regexp_replace(lower(text), '[^a-zA-Z\\s]', '', 'g') AS letters
       FROM documents""",
)
def text_normalize(spark, sf):
    d = table(spark, sf, "documents")
    return d.select(
        "doc_id", F.lower(F.trim("text")).alias("lowered"),
        F.regexp_replace(F.lower("text"), r"[^a-zA-Z\s]", "").alias("letters"),
    )


@query("text_truncate", "SELECT doc_id, substring(text, 1, 512) AS head_512, length(text) AS full_length FROM documents")
def text_truncate(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.substring("text", 1, 512).alias("head_512"), F.length("text").cast("long").alias("full_length"))


@query("text_length_stats", "SELECT lang, count(*) AS n, round(avg(length(text)), 4) AS avg_length FROM documents GROUP BY lang")
def text_length_stats(spark, sf):
    d = table(spark, sf, "documents")
    return d.groupBy("lang").agg(F.count("*").alias("n"), rounded(F.avg(F.length("text"))).alias("avg_length"))


@query(
    "join_inner",
    """SELECT o_orderkey, o_totalprice, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def join_inner(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "o_totalprice", "c_name", "c_mktsegment")


@query(
    "join_left",
    """SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer
       LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > 400000) ON o_custkey = c_custkey""",
)
def join_left(spark, sf):
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders").filter("o_totalprice > 400000")
    return c.join(o, o.o_custkey == c.c_custkey, "left").select("c_custkey", "c_name", "o_orderkey", "o_totalprice")


@query(
    "join_multi_left",
    """SELECT l_orderkey, l_linenumber, l_partkey, o_orderdate, c_name FROM lineitem
       LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey""",
)
def join_multi_left(spark, sf):
    li, o, c = (table(spark, sf, t) for t in ("lineitem", "orders", "customer"))
    return (
        li.join(o, li.l_orderkey == o.o_orderkey, "left")
        .join(c, o.o_custkey == c.c_custkey, "left")
        .select("l_orderkey", "l_linenumber", "l_partkey", "o_orderdate", "c_name")
    )


@query(
    "semi_join_in_subquery",
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)""",
)
def semi_join_in_subquery(spark, sf):
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders").filter("o_totalprice > 450000")
    return c.join(o, c.c_custkey == o.o_custkey, "left_semi").select("c_custkey", "c_name")


@query(
    "derived_table_filter",
    """SELECT o_custkey, avg_order FROM (SELECT o_custkey, round(avg(o_totalprice), 6) AS avg_order FROM orders
       GROUP BY o_custkey) WHERE avg_order > 250000""",
)
def derived_table_filter(spark, sf):
    per = table(spark, sf, "orders").groupBy("o_custkey").agg(rounded(F.avg("o_totalprice"), 6).alias("avg_order"))
    return per.filter("avg_order > 250000")


@query(
    "cte_filter",
    """WITH totals AS (SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS spend FROM orders GROUP BY o_custkey)
       SELECT * FROM totals WHERE n >= 10 AND spend > 1000000""",
)
def cte_filter(spark, sf):
    return spark.sql(
        """WITH totals AS (SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS spend
                           FROM {orders} GROUP BY o_custkey)
           SELECT * FROM totals WHERE n >= 10 AND spend > 1000000""",
        orders=table(spark, sf, "orders"),
    )


@query(
    "map_values",
    """WITH m AS (SELECT p_brand, concat(p_brand, '-', max(p_type)) AS new FROM part WHERE p_size > 49 GROUP BY p_brand)
       SELECT p_partkey, coalesce(m.new, part.p_brand) AS p_brand FROM part LEFT JOIN m ON m.p_brand = part.p_brand""",
)
def map_values(spark, sf):
    p = table(spark, sf, "part")
    mapping = (
        p.filter("p_size > 49").groupBy(F.col("p_brand").alias("old"))
        .agg(F.concat(F.first("p_brand"), F.lit("-"), F.max("p_type")).alias("new"))
    )
    return relational.map_values(p, "p_brand", mapping).select("p_partkey", "p_brand")


@query(
    "global_aggregates",
    """SELECT count(*) AS n, round(sum(l_extendedprice), 2) AS total, round(avg(l_extendedprice), 4) AS mean,
              min(l_extendedprice) AS lowest, max(l_extendedprice) AS highest FROM lineitem""",
)
def global_aggregates(spark, sf):
    x = "l_extendedprice"
    return table(spark, sf, "lineitem").agg(
        F.count("*").alias("n"), rounded(F.sum(x), 2).alias("total"), rounded(F.avg(x)).alias("mean"),
        F.min(x).alias("lowest"), F.max(x).alias("highest"),
    )


@query(
    "group_aggregate",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS sum_qty,
              round(avg(l_extendedprice), 4) AS avg_price, max(l_discount) AS max_discount,
              round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem GROUP BY ALL""",
)
def group_aggregate(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), rounded(F.sum("l_quantity"), 2).alias("sum_qty"),
        rounded(F.avg("l_extendedprice")).alias("avg_price"), F.max("l_discount").alias("max_discount"),
        rounded(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"),
    )


@query("group_having", "SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey HAVING count(*) > 60")
def group_having(spark, sf):
    return table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n")).filter("n > 60")


@query(
    "value_counts",
    """WITH c AS (SELECT event_type, count(*) AS n FROM (SELECT CASE WHEN event_id % 10 = 0 THEN NULL ELSE event_type END
                  AS event_type FROM events) WHERE event_type IS NOT NULL GROUP BY event_type)
       SELECT event_type, n, round(n / sum(n) OVER (), 6) AS share FROM c""",
)
def value_counts(spark, sf):
    e = table(spark, sf, "events").select(null_every("event_id", "event_type").alias("event_type"))
    out = profile.value_counts(e, "event_type")
    return out.select("event_type", "n", rounded("share", 6).alias("share"))


@query(
    "count_distinct",
    """SELECT unnest(['o_custkey', 'o_orderdate', 'o_orderpriority', 'o_orderstatus']) AS "column", unnest([count(DISTINCT o_custkey),
       count(DISTINCT o_orderdate), count(DISTINCT o_orderpriority), count(DISTINCT o_orderstatus)]) AS n_unique FROM orders""",
)
def count_distinct(spark, sf):
    return profile.count_distinct(
        table(spark, sf, "orders"), ["o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]
    )


@query(
    "missing_counts",
    """SELECT unnest(['c_custkey', 'bal', 'seg']) AS "column", unnest([CAST(count(*) - count(c_custkey) AS BIGINT),
       count(*) - count(CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_acctbal END),
       count(*) - count(CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END)]) AS n_missing FROM customer""",
)
def missing_counts(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey", null_every("c_custkey", "c_acctbal").alias("bal"), null_every("c_custkey", "c_mktsegment", 7).alias("seg")
    )
    return profile.missing_counts(c)


_DESCRIBE = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
        min({c}) AS lowest, round(quantile_cont({c}, 0.25), 4) AS q1, round(quantile_cont({c}, 0.5), 4) AS median,
        round(quantile_cont({c}, 0.75), 4) AS q3, max({c}) AS highest FROM lineitem"""
    for c in L3
)


@query("describe_numeric", _DESCRIBE)
def describe_numeric(spark, sf):
    out = profile.describe_numeric(table(spark, sf, "lineitem"), list(L3))
    return out.select("column", "n", *[rounded(c).alias(c) for c in ("mean", "std", "lowest", "q1", "median", "q3", "highest")])


@query(
    "mode_value",
    """SELECT * FROM (SELECT 'p_type' AS "column", p_type AS mode, count(*) AS n FROM part GROUP BY p_type
         ORDER BY n DESC, mode LIMIT 1)
       UNION ALL SELECT * FROM (SELECT 'p_brand', p_brand AS mode, count(*) AS n FROM part GROUP BY p_brand
         ORDER BY n DESC, mode LIMIT 1)""",
)
def mode_value(spark, sf):
    return profile.modes(table(spark, sf, "part"), ["p_type", "p_brand"])


@query(
    "median_quantiles",
    """SELECT round(quantile_cont(o_totalprice, 0.05), 4) AS p05, round(median(o_totalprice), 4) AS median,
              round(quantile_cont(o_totalprice, 0.95), 4) AS p95, round(quantile_cont(o_totalprice, 0.99), 4) AS p99 FROM orders""",
)
def median_quantiles(spark, sf):
    q = ranking.exact_quantiles(
        table(spark, sf, "orders"), ["o_totalprice"], {"p05": 0.05, "median": 0.5, "p95": 0.95, "p99": 0.99}
    )
    return q.select(*[rounded(c).alias(c) for c in ("p05", "median", "p95", "p99")])


@query(
    "spread_stats",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(var_pop({c}), 4) AS variance, round(stddev_pop({c}), 4) AS std,
            round(max({c}) - min({c}), 4) AS "range", round(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 4) AS iqr
            FROM lineitem"""
        for c in ("l_quantity", "l_discount")
    ),
)
def spread_stats(spark, sf):
    out = profile.spread_stats(table(spark, sf, "lineitem"), ["l_quantity", "l_discount"])
    return out.select("column", *[rounded(c).alias(c) for c in ("variance", "std", "range", "iqr")])


@query(
    "skew_kurtosis",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(skewness({c}), 6) AS skew, round(kurtosis({c}), 6) AS kurtosis FROM lineitem"""
        for c in L3
    ),
)
def skew_kurtosis(spark, sf):
    out = profile.moments(table(spark, sf, "lineitem"), list(L3))
    return out.select("column", rounded("skew", 6).alias("skew"), rounded("kurtosis", 6).alias("kurtosis"))


@query(
    "grouped_mean_median",
    """SELECT o_orderstatus, count(o_totalprice) AS n, round(avg(o_totalprice), 4) AS mean,
              round(median(o_totalprice), 4) AS median FROM orders GROUP BY o_orderstatus""",
)
def grouped_mean_median(spark, sf):
    out = profile.grouped_mean_median(table(spark, sf, "orders"), ["o_orderstatus"], ["o_totalprice"])
    return out.select("o_orderstatus", "n", rounded("mean").alias("mean"), rounded("median").alias("median"))


@query(
    "pivot_table",
    """SELECT l_returnflag, round(avg(l_extendedprice) FILTER (l_linestatus = 'F'), 4) AS F,
              round(avg(l_extendedprice) FILTER (l_linestatus = 'O'), 4) AS O FROM lineitem GROUP BY l_returnflag""",
)
def pivot_table(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).agg(rounded(F.avg("l_extendedprice")))


@query(
    "customer_purchase_patterns",
    """SELECT c_custkey, c_name, count(o_orderkey) AS n_orders, round(sum(o_totalprice), 2) AS spend,
              round(avg(o_totalprice), 6) AS avg_value FROM customer JOIN orders ON o_custkey = c_custkey
       GROUP BY c_custkey, c_name ORDER BY spend DESC""",
)
def customer_purchase_patterns(spark, sf):
    c = table(spark, sf, "customer")
    per = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("n_orders"), rounded(F.sum("o_totalprice"), 2).alias("spend"),
        rounded(F.avg("o_totalprice"), 6).alias("avg_value"),
    )
    return (
        c.join(per, c.c_custkey == per.o_custkey)
        .select("c_custkey", "c_name", "n_orders", "spend", "avg_value")
        .orderBy(F.desc("spend"), "c_custkey")
    )


@query(
    "monthly_trends",
    """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n_orders,
              round(sum(o_totalprice), 2) AS revenue FROM orders GROUP BY 1 ORDER BY 1""",
)
def monthly_trends(spark, sf):
    o = table(spark, sf, "orders")
    return (
        o.groupBy(F.trunc("o_orderdate", "month").alias("month"))
        .agg(F.count("*").alias("n_orders"), rounded(F.sum("o_totalprice"), 2).alias("revenue"))
        .orderBy("month")
    )


@query(
    "cohort_sizes",
    """SELECT cohort, count(*) AS n_customers FROM (SELECT o_custkey, CAST(date_trunc('month', min(o_orderdate)) AS DATE)
       AS cohort FROM orders GROUP BY o_custkey) GROUP BY cohort ORDER BY cohort""",
)
def cohort_sizes(spark, sf):
    first = table(spark, sf, "orders").groupBy("o_custkey").agg(F.trunc(F.min("o_orderdate"), "month").alias("cohort"))
    return first.groupBy("cohort").agg(F.count("*").alias("n_customers")).orderBy("cohort")


@query("sort_multi", "SELECT p_partkey, p_brand, p_size, p_retailprice FROM part ORDER BY p_brand, p_size DESC, p_partkey")
def sort_multi(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    return p.orderBy("p_brand", F.desc("p_size"), "p_partkey")


@query("head_rows", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def head_rows(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice").orderBy("o_orderkey").limit(10)


_TOP = " UNION ALL ".join(
    f"""SELECT * FROM (SELECT '{c}' AS "column", {c} AS value, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, {c})
        AS rank FROM part GROUP BY {c}) WHERE rank <= 5"""
    for c in ("p_name", "p_brand", "p_type")
)


@query("top_k_values", _TOP)
def top_k_values(spark, sf):
    p = table(spark, sf, "part")
    return profile.top_values(p, string_columns(p), 5).withColumn("rank", F.col("rank").cast("long"))


@query("nlargest_features", """SELECT * FROM (
       SELECT 'l_quantity' AS feature, round(abs(corr(l_quantity, l_extendedprice)), 6) AS score FROM lineitem UNION ALL
       SELECT 'l_discount', round(abs(corr(l_discount, l_extendedprice)), 6) FROM lineitem UNION ALL
       SELECT 'l_tax', round(abs(corr(l_tax, l_extendedprice)), 6) FROM lineitem) ORDER BY score DESC LIMIT 2""")
def nlargest_features(spark, sf):
    li = table(spark, sf, "lineitem")
    scores = li.agg(
        *[F.abs(F.corr(c, "l_extendedprice")).alias(c) for c in ("l_quantity", "l_discount", "l_tax")]
    ).unpivot([], ["l_quantity", "l_discount", "l_tax"], "feature", "score")
    return scores.select("feature", rounded("score", 6).alias("score")).orderBy(F.desc("score"), "feature").limit(2)


@query("tail_recent", "SELECT event_id, ts, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 10")
def tail_recent(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    return relational.tail_recent(e, "ts", "event_id", 10)


@query(
    "concat_rows",
    """SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, NULL::VARCHAR AS segment FROM supplier
       UNION ALL SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer""",
)
def concat_rows(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    return s.unionByName(c, allowMissingColumns=True)


@query(
    "concat_columns",
    """SELECT c_custkey, round(ln(1 + greatest(c_acctbal, 0)), 6) AS log_balance, c_mktsegment || '_' || c_nationkey AS segment_nation,
              count(o_orderkey) AS n_orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey
       GROUP BY c_custkey, c_acctbal, c_mktsegment, c_nationkey""",
)
def concat_columns(spark, sf):
    c = table(spark, sf, "customer")
    base = c.select(
        "c_custkey", rounded(F.log1p(F.greatest("c_acctbal", F.lit(0.0))), 6).alias("log_balance"),
        F.concat("c_mktsegment", F.lit("_"), F.col("c_nationkey").cast("string")).alias("segment_nation"),
    )
    block = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return base.join(block, "c_custkey", "left").withColumn("n_orders", F.coalesce("n", F.lit(0))).drop("n")


@query(
    "melt_unpivot",
    "UNPIVOT (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_tax FROM lineitem) "
    "ON l_quantity, l_discount, l_tax INTO NAME measure VALUE value",
)
def melt_unpivot(spark, sf):
    m = ["l_quantity", "l_discount", "l_tax"]
    return table(spark, sf, "lineitem").unpivot(["l_orderkey", "l_linenumber", "l_partkey"], m, "measure", "value")


@query("drop_duplicates", "SELECT * FROM customer")
def drop_duplicates(spark, sf):
    return doubled(table(spark, sf, "customer"), "c_custkey").dropDuplicates()


@query(
    "count_duplicates",
    """WITH d AS (SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_custkey % 20 = 0)
       SELECT count(*) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM d)) AS n_unique,
              count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM d)) AS n_duplicates FROM d""",
)
def count_duplicates(spark, sf):
    return profile.count_duplicates(doubled(table(spark, sf, "customer"), "c_custkey"))


@query(
    "row_number_by_group",
    """SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC,
       o_orderkey) AS rn FROM orders""",
)
def row_number_by_group(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    o = ranking.value_ranges(o, "o_totalprice", descending=True, tie="o_orderkey")
    return ranking.split_row_number(o, [F.desc("o_totalprice"), F.asc("o_orderkey")], F.col("__range"), ["o_custkey"]).drop("__range")
