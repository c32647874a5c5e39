"""Customer segmentation over customers with their order totals."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightloom.functions.numeric import rounded
from brightloom.operators import segments as sg
from brightloom.plans.common import null_every, table
from brightloom.registry import query
from brightloom.session import fresh_path, measured
from brightloom.sources import readers

NUM, CAT = ["c_acctbal", "n_orders", "spend"], ["c_mktsegment"]

_BASE = """b AS (SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal END AS c_acctbal,
   CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS c_mktsegment, count(o_orderkey) AS n_orders, coalesce(sum(o_totalprice), 0) AS spend
   FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL)"""


def customers(spark, sf):
    per = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("s"))
    c = table(spark, sf, "customer").join(per, "c_custkey", "left")
    return c.select(
        "c_custkey", "c_nationkey", null_every("c_custkey", "c_acctbal").alias("c_acctbal"), null_every("c_custkey", "c_mktsegment", 7).alias("c_mktsegment"),
        F.coalesce("n", F.lit(0)).alias("n_orders"), F.coalesce("s", F.lit(0.0)).alias("spend"),
    )


def prepared(spark, sf):
    return measured(sg.segment_preprocess(customers(spark, sf), NUM, CAT))


def vectors(spark, sf):
    return sg.assemble(prepared(spark, sf), [f"{c}_z" for c in (*NUM, "c_mktsegment_code")])


_Z = ("c_acctbal", "n_orders", "spend", "code")


@query(
    "segment_preprocess",
    f"""WITH {_BASE}, i AS (SELECT c_custkey, coalesce(c_acctbal, (SELECT avg(c_acctbal) FROM b)) AS c_acctbal, n_orders, spend,
          coalesce(c_mktsegment, (SELECT c_mktsegment FROM b WHERE c_mktsegment IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS seg FROM b),
        l AS (SELECT *, dense_rank() OVER (ORDER BY seg) - 1 AS code FROM i)
        SELECT c_custkey, {", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) + 0::DOUBLE AS {'c_mktsegment_code' if c == 'code' else c}_z" for c in _Z)} FROM l""",
)
def segment_preprocess(spark, sf):
    out = sg.segment_preprocess(customers(spark, sf), NUM, CAT)
    return out.select("c_custkey", *[rounded(f"{c}_z", 6).alias(f"{c}_z") for c in (*NUM, "c_mktsegment_code")])


@query("optimal_clusters")
def optimal_clusters(spark, sf):
    return sg.optimal_clusters(vectors(spark, sf)).withColumn("silhouette", rounded("silhouette"))


@query("kmeans_segments")
def kmeans_segments(spark, sf):
    a = sg.kmeans_segments(vectors(spark, sf), 4).select(F.lit("customer").alias("source"), F.col("c_custkey").alias("id"), "segment")
    e = sg.vectors_from_array(table(spark, sf, "embeddings"), "embedding")
    b = sg.kmeans_segments(e, 10).select(F.lit("embeddings").alias("source"), F.col("vec_id").alias("id"), "segment")
    return a.unionByName(b)


@query("pca_2d")
def pca_2d(spark, sf):
    return sg.pca_2d(vectors(spark, sf)).select("c_custkey", rounded(F.abs("pc1"), 4).alias("abs_pc1"), rounded(F.abs("pc2"), 4).alias("abs_pc2"))


def regions(spark, sf):
    n = table(spark, sf, "nation")
    c = customers(spark, sf)
    return c.join(n, c.c_nationkey == n.n_nationkey).withColumnRenamed("n_regionkey", "segment")


@query(
    "segment_profiles",
    f"""WITH {_BASE}, r AS (SELECT b.*, n_regionkey AS segment FROM b JOIN nation ON n_nationkey = c_nationkey),
        m AS (SELECT segment, c_mktsegment, row_number() OVER (PARTITION BY segment ORDER BY count(*) DESC, c_mktsegment) AS k FROM r WHERE c_mktsegment IS NOT NULL GROUP BY segment, c_mktsegment)
        SELECT r.segment, count(*) AS size, round(count(*) * 100 / any_value(k.n), 4) AS pct, round(avg(c_acctbal), 6) AS mean_c_acctbal,
               round(avg(n_orders), 6) AS mean_n_orders, round(avg(spend), 6) AS mean_spend, any_value(m.c_mktsegment) AS mode_c_mktsegment
        FROM r JOIN m ON m.segment = r.segment AND m.k = 1, (SELECT count(*) AS n FROM r) k GROUP BY r.segment""",
)
def segment_profiles(spark, sf):
    out = sg.segment_profiles(regions(spark, sf), "segment", NUM, CAT)
    return out.select(
        "segment", "size", rounded("pct").alias("pct"), rounded("mean_c_acctbal", 6).alias("mean_c_acctbal"), rounded("mean_n_orders", 6).alias("mean_n_orders"),
        rounded("mean_spend", 6).alias("mean_spend"), "mode_c_mktsegment",
    )


@query(
    "segment_feature_importance",
    f"""WITH {_BASE}, r AS (SELECT b.*, n_regionkey AS segment FROM b JOIN nation ON n_nationkey = c_nationkey)
        {" UNION ALL ".join(f"SELECT '{c}' AS feature, round(abs(corr({c}, segment)), 6) AS importance FROM r" for c in NUM)}""",
)
def segment_feature_importance(spark, sf):
    return sg.segment_feature_importance(regions(spark, sf), "segment", NUM).withColumn("importance", rounded("importance", 6))


@query(
    "save_segments",
    """SELECT count(*) AS n_rows, count(*) AS profile_rows, count(*) AS n_components, CAST(4 AS BIGINT) AS n_segments, CAST(100.0 AS DOUBLE) AS pct FROM customer""",
)
def save_segments(spark, sf):
    rows = measured(sg.pca_2d(sg.kmeans_segments(vectors(spark, sf), 4)).drop("features"))
    keep = rows.select("c_custkey", *NUM, *CAT, F.col("segment").alias("Segment"))
    comps = rows.select("c_custkey", "pc1", "pc2")
    paths = sg.save_segments(keep, comps, sg.segment_profiles(rows, "segment", NUM, CAT), fresh_path(spark, "segments"))
    # what was written, read back: every row once, every segment with its profile
    prof = readers.scan_json(spark, paths["profiles"]).select(F.col("segment").alias("Segment"), F.col("size").alias("profile_size"), F.col("pct").cast("double").alias("pct"))
    pcs = readers.scan_csv(spark, paths["components"], comps.schema)
    out = readers.scan_csv(spark, paths["rows"], keep.schema).join(pcs, "c_custkey").groupBy("Segment").agg(F.count("*").alias("n_rows"), F.count("pc1").alias("n_pc"))
    return out.join(prof, "Segment").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("profile_size").cast("long").alias("profile_rows"), F.sum("n_pc").alias("n_components"),
        F.count("*").alias("n_segments"), rounded(F.sum("pct"), 6).alias("pct"),
    )
