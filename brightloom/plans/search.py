"""Document search over documents, embeddings and an event-based query log."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightloom.functions.numeric import rounded
from brightloom.operators import relational, search
from brightloom.plans.common import table
from brightloom.registry import query
from brightloom.session import fresh_path
from brightloom.sources import readers, sinks


@query(
    "chunk_documents",
    """WITH d AS (SELECT doc_id, text, CAST(greatest(ceil((length(text) - 200) / 800), 1) AS INTEGER) AS total_chunks FROM documents),
            e AS (SELECT *, CAST(unnest(range(total_chunks)) AS INTEGER) AS chunk_id FROM d)
       SELECT doc_id AS source, chunk_id, total_chunks, substring(text, chunk_id * 800 + 1, 1000) AS chunk FROM e""",
)
def chunk_documents(spark, sf):
    return search.chunk_stride(table(spark, sf, "documents"), "doc_id", "text")


@query(
    "chunk_documents_boundary",
    """SELECT doc_id AS source, length(text) AS n_chars, md5(text) AS text_md5, true AS bounded, true AS complete FROM documents""",
)
def chunk_documents_boundary(spark, sf):
    """The chunks of every document put together again without their overlaps, with their bounds."""
    chunks = search.chunk_boundary(table(spark, sf, "documents"), "doc_id", "text")
    own = F.when(F.col("chunk_id") == 0, F.col("chunk")).otherwise(F.substring("chunk", search.OVERLAP + 1, search.CHUNK))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_id", own.alias("own")))), lambda c: c["own"]), "")
    back = chunks.groupBy("source").agg(
        whole.alias("t"), (F.max(F.length("chunk")) <= search.CHUNK).alias("bounded"), (F.count("*") == F.max("total_chunks")).alias("complete")
    )
    return back.select("source", F.length("t").cast("long").alias("n_chars"), F.md5("t").alias("text_md5"), "bounded", "complete")


@query("embed_text")
def embed_text(spark, sf):
    d = search.embed_text(table(spark, sf, "documents").select("doc_id", "text"), "text")
    return d.select("doc_id", F.transform("embedding", lambda v: F.round(v, 5)).alias("embedding"))


_NEAR = """d AS (SELECT q.vec_id AS qid, e.vec_id, list_sum(list_transform(range(1, len(q.embedding) + 1), lambda i: (q.embedding[i]::DOUBLE - e.embedding[i]::DOUBLE) * (q.embedding[i]::DOUBLE - e.embedding[i]::DOUBLE)))
       AS distance FROM embeddings q, embeddings e WHERE q.vec_id % 100 = 0),
 near AS (SELECT qid, CAST(row_number() OVER (PARTITION BY qid ORDER BY distance, vec_id) AS INTEGER) AS rank, vec_id AS neighbor, round(distance, 6) AS distance
          FROM d QUALIFY rank <= 5)"""


def stated_queries(e):
    """The rows whose id is divisible by 100 are the queries."""
    return e.filter("vec_id % 100 = 0").withColumnRenamed("vec_id", "qid")


@query("knn_search", f"WITH {_NEAR} SELECT * FROM near")
def knn_search(spark, sf):
    """Every row whose id is divisible by 100 against the whole index."""
    e = table(spark, sf, "embeddings")
    out = search.knn_search(stated_queries(e), e, "qid", "vec_id", n=5)
    return out.withColumn("distance", rounded("distance", 6))


@query(
    "knn_search_lsh",
    """SELECT count(*) AS n_queries, true AS recall_reached, true AS ranks_complete FROM embeddings WHERE vec_id % 100 = 0""",
)
def knn_search_lsh(spark, sf):
    """Every row whose id is divisible by 100 against the whole index; recall against the exact search."""
    e = table(spark, sf, "embeddings")
    q = stated_queries(e)
    exact = search.knn_search(q, e, "qid", "vec_id", n=5)
    found = search.knn_search_lsh(q, e, "qid", "vec_id", n=5, width=2.0, tables=12)
    return lsh_summary(q, exact, found)


def lsh_summary(q, exact, found, n=5):
    """Queries, whether the mean recall against ``exact`` reaches 0.9, and whether ``found`` has all ``n`` ranks of every query."""
    pairs = exact.select("qid", "neighbor", F.lit(1).alias("wanted")).join(found.select("qid", "neighbor", "rank"), ["qid", "neighbor"], "full")
    recall = F.count(F.when(F.col("rank").isNotNull(), F.col("wanted"))) / F.count("wanted")
    both = q.select("qid").join(pairs.groupBy("qid").agg(recall.alias("recall"), F.count("rank").alias("n")), "qid", "left")
    return both.agg(F.count("*").alias("n_queries"), (F.avg(F.coalesce("recall", F.lit(0.0))) >= 0.9).alias("recall_reached"), F.every(F.coalesce("n", F.lit(0)) == n).alias("ranks_complete"))


@query(
    "reindex_overwrite",
    """SELECT lang, CAST(sum(greatest(ceil((length(text) - 200) / 800), 1)) AS BIGINT) AS n_chunks, count(*) AS n_sources FROM documents GROUP BY lang""",
)
def reindex_overwrite(spark, sf):
    d = table(spark, sf, "documents")
    chunks = search.chunk_stride(d, "doc_id", "text").join(d.select(F.col("doc_id").alias("source"), "lang"), "source")
    path = fresh_path(spark, "index")
    search.reindex_overwrite(chunks.filter("chunk_id = 0"), path, ["lang"])
    index = search.reindex_overwrite(chunks, path, ["lang"])
    return index.groupBy("lang").agg(F.count("*").alias("n_chunks"), F.count_distinct("source").alias("n_sources"))


def query_log(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", F.col("ts").alias("timestamp"), F.col("event_type").alias("query"), F.floor("value").cast("int").alias("num_results"))


@query(
    "search_history",
    """WITH h AS (SELECT event_id, ts, event_type, CAST(floor(value) AS INTEGER) AS k FROM events)
       SELECT 'activity' AS part, CAST(CAST(ts AS DATE) AS VARCHAR) AS item, count(*) AS searches, round(avg(k), 6) AS results FROM h GROUP BY 2
       UNION ALL SELECT * FROM (SELECT 'recent', CAST(event_id AS VARCHAR), 1, CAST(k AS DOUBLE) FROM h ORDER BY ts DESC, event_id DESC LIMIT 10)""",
)
def search_history(spark, sf):
    path = fresh_path(spark, "history")
    log = query_log(spark, sf)
    search.record_search(spark, path, log.filter("event_id % 2 = 0"))
    search.record_search(spark, path, log.filter("event_id % 2 = 1"))
    history = spark.read.parquet(path)
    act = search.search_activity(history).select(
        F.lit("activity").alias("part"), F.col("date").cast("string").alias("item"), "searches", rounded("mean_results", 6).alias("results")
    )
    last = relational.tail_recent(history, "timestamp", "event_id", 10).select(
        F.lit("recent").alias("part"), F.col("event_id").cast("string").alias("item"), F.lit(1).cast("long").alias("searches"),
        F.col("num_results").cast("double").alias("results"),
    )
    return act.unionByName(last)


@query(
    "export_results",
    f"""WITH {_NEAR} SELECT concat('vector ', neighbor) AS content, CAST(qid AS VARCHAR) AS source, rank AS chunk_id, distance, format
        FROM near, (VALUES ('csv'), ('json')) f(format)""",
)
def export_results(spark, sf):
    """Nearest neighbours of every row whose id is divisible by 100, exported as CSV and JSON and read back."""
    e = table(spark, sf, "embeddings")
    found = search.knn_search(stated_queries(e), e, "qid", "vec_id", n=5)
    results = found.select(
        F.concat(F.lit("vector "), F.col("neighbor").cast("string")).alias("content"),
        F.struct(F.col("qid").cast("string").alias("source"), F.col("rank").alias("chunk_id"), F.lit(5).alias("total_chunks")).alias("metadata"),
        rounded("distance", 6).alias("distance"),
    )
    flat = search.export_rows(results)
    csv, js = fresh_path(spark, "export"), fresh_path(spark, "export")
    sinks.sink_csv(flat, csv)
    sinks.sink_json(flat, js)
    a = readers.scan_csv(spark, csv, flat.schema).withColumn("format", F.lit("csv"))
    return a.unionByName(readers.scan_json(spark, js, flat.schema).withColumn("format", F.lit("json")))
