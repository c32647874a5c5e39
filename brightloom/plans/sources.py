"""Scans, sinks, SQL over registered tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightloom.plans.common import table
from brightloom.registry import query
from brightloom.session import fresh_path
from brightloom.sources import readers, sinks


@query("scan_csv", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def scan_csv(spark, sf):
    path = fresh_path(spark, "csv")
    sinks.sink_csv(table(spark, sf, "supplier"), path)
    return readers.scan_csv(spark, path, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double")


@query("scan_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def scan_json(spark, sf):
    path = fresh_path(spark, "json")
    e = table(spark, sf, "events")
    sinks.sink_json(e.select("event_id", F.from_json("props", "k long").alias("props")), path)
    return readers.scan_json(spark, path, "event_id long, props struct<k: long>").select("event_id", "props.k")


@query(
    "scan_parquet_recent",
    "SELECT event_id, ts, user_id, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000",
)
def scan_parquet_recent(spark, sf):
    recent = readers.scan_parquet_recent(spark, f"{sf}/events.parquet", "ts", "event_id", 1000)
    return recent.select("event_id", "ts", "user_id", "event_type", "value")


@query("scan_documents", "SELECT lang, CAST(sum(length(text) + 1) AS BIGINT) AS n_chars FROM documents GROUP BY lang")
def scan_documents(spark, sf):
    """Documents written as text files below a folder per language, scanned back as whole files."""
    path = fresh_path(spark, "docs")
    docs = table(spark, sf, "documents").select("lang", "text")
    docs.write.partitionBy("lang").option("maxRecordsPerFile", 25).text(path)  # each document ends with a line feed
    files = readers.scan_documents(spark, path)
    lang = F.regexp_extract("path", "lang=([a-z]+)", 1).alias("lang")
    return files.groupBy(lang).agg(F.sum(F.length("content")).alias("n_chars"))


@query("register_table", "SELECT p_brand, count(*) AS n_parts FROM part GROUP BY p_brand")
def register_table(spark, sf):
    readers.register_table(spark, table(spark, sf, "part"), "bl_part")
    return spark.table("bl_part").groupBy("p_brand").agg(F.count("*").alias("n_parts"))


_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
    "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def _catalog_sql() -> str:
    rows = []
    for name, columns in _COLUMNS.items():
        for i, (c, t) in enumerate(x.split(" ") for x in columns.split(", ")):
            values = "nullif(list(0::VARCHAR), list(0::VARCHAR))" if t.startswith("array") else f"list(CAST(k.{c} AS VARCHAR))"
            rows.append(
                f"""SELECT '{name}' AS "table", '{c}' AS "column", {i} AS position, '{t}' AS type, {values} AS sample_values FROM (SELECT * FROM {name} ORDER BY ALL LIMIT 3) k"""
            )
    return " UNION ALL ".join(rows)


@query("table_catalog", _catalog_sql())
def table_catalog(spark, sf):
    """All tables; vectors are listed without their sample, as engines print floats differently."""
    out = readers.table_catalog({n: table(spark, sf, n) for n in _COLUMNS})
    return out.withColumn("sample_values", F.when(~F.startswith("type", F.lit("array")), F.col("sample_values")))


@query(
    "run_sql",
    """SELECT c_mktsegment, count(*) AS n_orders, round(avg(o_totalprice), 4) AS avg_order
       FROM orders JOIN customer ON o_custkey = c_custkey
       WHERE o_totalprice > 1000 GROUP BY c_mktsegment""",
)
def run_sql(spark, sf):
    readers.register_table(spark, table(spark, sf, "orders"), "bl_orders")
    readers.register_table(spark, table(spark, sf, "customer"), "bl_customer")
    return readers.run_sql(
        spark,
        """SELECT c_mktsegment, count(*) AS n_orders, round(avg(o_totalprice), 4) AS avg_order
           FROM bl_orders JOIN bl_customer ON o_custkey = c_custkey
           WHERE o_totalprice > :floor GROUP BY c_mktsegment""",
        {"floor": 1000},
    )


@query(
    "sql_history_audit",
    """WITH h AS (SELECT conv_id, turn, upper(CASE WHEN turn % 3 = 0 THEN concat('update t set ', text) ELSE text END) AS q
                  FROM conversations)
       SELECT conv_id, turn, concat_ws(',', CASE WHEN contains(q, 'DROP') THEN 'DROP' END,
              CASE WHEN contains(q, 'DELETE') THEN 'DELETE' END, CASE WHEN contains(q, 'TRUNCATE') THEN 'TRUNCATE' END,
              CASE WHEN contains(q, 'UPDATE') THEN 'UPDATE' END, CASE WHEN contains(q, 'INSERT') THEN 'INSERT' END) AS matched,
              contains(q, 'DROP') OR contains(q, 'DELETE') OR contains(q, 'TRUNCATE') OR contains(q, 'UPDATE')
              OR contains(q, 'INSERT') AS unsafe
       FROM h""",
)
def sql_history_audit(spark, sf):
    c = table(spark, sf, "conversations")
    text = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("update t set "), "text")).otherwise(F.col("text"))
    return readers.sql_history_audit(c.select("conv_id", "turn", text.alias("query"))).drop("query")


@query("sink_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def sink_csv(spark, sf):
    path = fresh_path(spark, "csv")
    c = table(spark, sf, "customer")
    sinks.sink_csv(c, path)
    return readers.scan_csv(spark, path, c.schema)


@query("sink_json", "SELECT n_nationkey, n_name, n_regionkey, count(c_custkey) AS n_customers FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL")
def sink_json(spark, sf):
    path = fresh_path(spark, "json")
    n, c = table(spark, sf, "nation"), table(spark, sf, "customer")
    per = c.groupBy("c_nationkey").agg(F.count("*").alias("k"))
    out = n.join(per, n.n_nationkey == per.c_nationkey, "left").select(
        "n_nationkey", "n_name", "n_regionkey", F.coalesce("k", F.lit(0)).alias("n_customers")
    )
    sinks.sink_json(out, path)
    return readers.scan_json(spark, path, out.schema)


@query("parse_timestamps", "SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE ts END AS ts FROM events")
def parse_timestamps(spark, sf):
    e = table(spark, sf, "events")
    text = F.when(F.col("event_id") % 10 == 0, F.lit("not a time")).otherwise(F.col("ts").cast("string"))
    return readers.parse_timestamps(e.select("event_id", text.alias("ts")), "ts")
