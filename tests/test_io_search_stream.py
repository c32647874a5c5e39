"""Readers, document search, streaming."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from brightloom.operators import search, udfs
from brightloom.plans.search import lsh_summary
from brightloom.sources import readers
from brightloom.streaming import monitor as mon


def test_csv_quotes_and_empty_fields(spark, tmp_path):
    p = tmp_path / "reviews.csv"
    p.write_text('text,date,rating,who\n"Good, but it\'s ""small""",2024-01-02,4,c1\nplain,2024-01-03,,c2\n')
    rows = readers.scan_csv(spark, str(p)).collect()
    assert rows[0]["text"] == 'Good, but it\'s "small"' and rows[0]["date"] == dt.date(2024, 1, 2) and rows[1]["rating"] is None


def test_json_array_file(spark, tmp_path):
    p = tmp_path / "h.json"
    p.write_text('[{"query": "a", "num_results": 3},\n {"query": "b", "num_results": 0}]')
    assert readers.scan_json(spark, str(p), multi_line=True).agg(F.sum("num_results")).first()[0] == 3


def test_documents_skip_bad_utf8(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_text("one\ntwo", encoding="utf-8")
    (tmp_path / "sub" / "b.md").write_text("ünï", encoding="utf-8")
    (tmp_path / "bad.txt").write_bytes(b"\xff\xfe\xfa")
    (tmp_path / "c.csv").write_text("no")
    out = readers.scan_documents(spark, str(tmp_path)).collect()
    assert {(r["path"].rsplit("/", 1)[1], r["content"]) for r in out} == {("a.txt", "one\ntwo"), ("b.md", "ünï")}


def test_sql_audit_is_substring_based(spark):
    df = spark.createDataFrame([("select updated_at from t",), ("select 1",), ("drop table t; delete from x",)], "query string")
    out = [(r["unsafe"], r["matched"]) for r in readers.sql_history_audit(df).collect()]
    assert out == [(True, "UPDATE"), (False, ""), (True, "DROP,DELETE")]


def test_catalog_lists_columns_in_order(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    out = readers.table_catalog({"t": df}).orderBy("position").collect()
    assert [(r["column"], r["type"]) for r in out] == [("a", "int"), ("b", "string")]


def test_boundary_chunks_reassemble(spark):
    rng = np.random.default_rng(0)
    words = ["".join(rng.choice(list("abcdef"), rng.integers(1, 12))) for _ in range(1500)]
    long = "".join(w + rng.choice([" ", " ", " ", "\n", "\n\n"]) for w in words)
    texts = {1: long, 2: "short", 3: "x" * 2500, 4: ""}
    df = spark.createDataFrame(list(texts.items()), "id int, t string")
    rows = search.chunk_boundary(df, "id", "t").toPandas()
    for i, t in texts.items():
        parts = rows[rows["source"] == i].sort_values("chunk_id")["chunk"].tolist()
        assert all(len(p) <= 1000 for p in parts)
        whole = parts[0]
        for a, b in zip(parts, parts[1:]):
            assert b.startswith(a[-200:])
            whole += b[200:]
        assert whole == t


def test_knn_matches_brute_force_over_blocks(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 3, (300, 4)).astype(float)  # many ties
    index = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id int, embedding array<double>").repartition(7)
    queries = index.filter("id < 25").withColumnRenamed("id", "q")
    for block in (2000, 6):
        got = search.knn_search(queries, index, "q", "id", n=4, block=block).toPandas()
        for q in range(25):
            d = ((x - x[q]) ** 2).sum(axis=1)
            want = sorted(range(300), key=lambda j: (d[j], j))[:4]
            assert got[got["q"] == q].sort_values("rank")["neighbor"].tolist() == want


def test_knn_keeps_the_smallest_keys_of_many_copies(spark):
    rng = np.random.default_rng(2)
    x = np.vstack([np.tile(rng.normal(size=8), (1000, 1)), rng.normal(size=(200, 8)) + 9])
    x[1000:1040] = x[0] + 1e-9 * rng.normal(size=(40, 8))  # nearer to each other than the matrix form can tell
    keys = rng.permutation(len(x))
    index = spark.createDataFrame([(int(k), [float(v) for v in r]) for k, r in zip(keys, x)], "id int, embedding array<double>").repartition(5)
    asked = [0, 1000, 1020, 1100]
    queries = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in asked], "q int, embedding array<double>")
    got = search.knn_search(queries, index, "q", "id", n=5).toPandas()
    for q in asked:
        d = ((x - x[q]) ** 2).sum(axis=1)
        want = sorted(range(len(x)), key=lambda j: (d[j], keys[j]))[:5]
        assert got[got["q"] == q].sort_values("rank")["neighbor"].tolist() == [keys[j] for j in want]


def test_knn_over_cells_with_a_hot_one(spark):
    """A third of the rows are copies, clusters lie apart, some vectors are null: equal to brute force, few rows compared."""
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(12, 6)) * 50
    x = np.vstack([middles[rng.integers(0, 12, 800)] + rng.normal(size=(800, 6)), np.tile(middles[0], (400, 1))])
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(5000, None)]
    index = spark.createDataFrame(rows, "id long, embedding array<float>").repartition(6)
    stored = np.array([r["embedding"] for r in index.filter("id < 5000").orderBy("id").collect()], float)
    queries = index.filter("id % 20 = 0").withColumnRenamed("id", "q")
    for cells, block in ((None, 20_000), (5, 50), (1, 100)):
        got = search.knn_search(queries, index, "q", "id", n=7, cells=cells, block=block, widen=2).collect()
        found = {}
        for r in sorted(got, key=lambda r: (r["q"], r["rank"])):
            found.setdefault(r["q"], []).append((r["neighbor"], r["distance"]))
        for q in range(0, 1200, 20):
            d = ((stored - stored[q]) ** 2).sum(axis=1)
            want = sorted(range(1200), key=lambda j: (d[j], j))[:7]
            assert [k for k, _ in found[q]] == want
            assert [v for _, v in found[q]] == [d[j] for j in want]
        assert set(found) == set(range(0, 1200, 20))


def test_knn_empty_sides(spark):
    some = spark.createDataFrame([(1, [0.0, 1.0]), (2, [0.5, 1.0])], "id int, embedding array<double>")
    none = some.filter("id > 9")
    assert search.knn_search(none.withColumnRenamed("id", "q"), some, "q", "id").count() == 0
    assert search.knn_search(some.withColumnRenamed("id", "q"), none, "q", "id").count() == 0
    few = search.knn_search(some.withColumnRenamed("id", "q"), some, "q", "id", n=5).collect()
    assert sorted((r["q"], r["rank"], r["neighbor"]) for r in few) == [(1, 1, 1), (1, 2, 2), (2, 1, 2), (2, 2, 1)]


def test_lsh_summary_counts_the_ranks_found(spark):
    q = spark.createDataFrame([(i,) for i in range(20)], "qid int")
    exact = q.crossJoin(spark.range(1, 6).select(F.col("id").cast("int").alias("rank"), F.col("id").alias("neighbor")))
    assert tuple(lsh_summary(q, exact, exact).first()) == (20, True, True)
    assert tuple(lsh_summary(q, exact, exact.filter("qid > 0")).first()) == (20, True, False)
    assert tuple(lsh_summary(q, exact, exact.filter("qid > 0 OR rank < 5")).first()) == (20, True, False)


def test_lsh_in_blocks_finds_the_nearest_of_hot_buckets(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    rows = [(i if i else None, [float(v) for v in x[i]]) for i in range(300)] + [(7, [float(v) for v in x[7]]), (400, None)]
    index = spark.createDataFrame(rows, "k long, embedding array<float>")
    queries = index.filter("k % 20 = 0").withColumnRenamed("k", "qk")
    got = search.knn_search_lsh(queries, index, "qk", "k", n=4, width=100.0, tables=3, block=32).collect()  # every pair meets
    found = {(r["qk"], r["rank"]): (r["neighbor"], r["distance"]) for r in got}
    asked = range(20, 300, 20)
    assert len(got) == len(found) == 4 * len(asked)
    for i in asked:
        d = ((x.astype(float) - x[i].astype(float)) ** 2).sum(axis=1)
        for rank, j in enumerate(np.argsort(d, kind="stable")[:4], 1):
            assert found[i, rank][0] == (j or None) and abs(found[i, rank][1] - d[j]) < 1e-9


def test_boundary_chunks_leave_the_task_in_small_batches(spark):
    texts = ["word " * n + "\n\n" + "ü" * n for n in range(0, 500, 50)] + [None, ""]
    df = spark.createDataFrame([(i if i != 3 else None, t) for i, t in enumerate(texts)], "id long, t string")
    got = search.chunk_boundary(df, "id", "t", 100, 20, texts=2).collect()
    want = [(i if i != 3 else None, j, len(c), x) for i, t in enumerate(texts) if t is not None for c in [search._cuts(t, 100, 20)] for j, x in enumerate(c)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_reindex_replaces(spark, tmp_path):
    df = spark.createDataFrame([("a", "x" * 1500), ("b", "y")], "id string, t string")
    search.reindex_overwrite(search.chunk_stride(df, "id", "t"), str(tmp_path / "i"))
    again = search.reindex_overwrite(search.chunk_stride(df.filter("id = 'b'"), "id", "t"), str(tmp_path / "i"))
    assert [r["id"] for r in again.collect()] == ["b_0"]


def events(spark, n=600):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(seconds=20 * i), "view" if i % 3 else "error", float(i % 17)) for i in range(n)]
    return spark.createDataFrame(rows, "id int, ts timestamp_ntz, kind string, v double")


def test_stream_equals_batch_for_closed_windows(spark, tmp_path):
    df = events(spark)
    src = str(tmp_path / "in")
    for i in range(5):  # files arrive in time order
        df.filter(F.floor(F.col("id") / 120) == i).coalesce(1).write.mode("append").parquet(src)
    stream = mon.read_stream(spark, src, df.schema, files_per_batch=1)
    mon.append_to_table(mon.window_metrics(stream, "ts", "v", ["kind"], "5 minutes", "10 minutes"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).toPandas()
    batch = mon.window_metrics(df, "ts", "v", ["kind"]).toPandas()
    closed = batch[batch["window_end"] <= df.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=10)]
    key = ["window_start", "kind"]
    a, b = got.sort_values(key).reset_index(drop=True), closed.sort_values(key).reset_index(drop=True)
    assert len(a) > 10
    pd.testing.assert_frame_equal(a[b.columns], b)


def test_late_rows_are_dropped_and_restart_continues(spark, tmp_path):
    df = events(spark)
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))

    def run():
        s = mon.read_stream(spark, src, df.schema)
        mon.append_to_table(mon.window_metrics(s, "ts", "v", ["kind"], "5 minutes", "10 minutes"), out, cp).awaitTermination()
        return spark.read.parquet(out).agg(F.sum("n")).first()[0]

    df.filter("id < 500").write.parquet(src)
    first = run()
    late = df.filter("id < 3")
    late.unionAll(df.filter("id >= 500")).write.mode("append").parquet(src)
    second = run()
    end = df.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=10)
    batch = mon.window_metrics(df, "ts", "v", ["kind"]).filter(F.col("window_end") <= F.lit(end).cast("timestamp_ntz")).agg(F.sum("n")).first()[0]
    assert first < second == batch


def test_deviation_stream_over_shuffled_files(spark, tmp_path):
    m = mon.window_metrics(events(spark), "ts", "v", ["kind"]).select("kind", "window_start", "mean")
    end = m.agg(F.max("window_start")).first()[0] - dt.timedelta(minutes=10)
    key = ["kind", "window_start"]
    want = mon.history_deviation(m, "window_start", "mean", ["kind"], None).filter(F.col("window_start") < F.lit(end).cast("timestamp_ntz"))
    want = want.toPandas().sort_values(key)["z"].to_numpy(float)
    # in time order over many batches, then in no order in one batch
    for name, frame, per_batch in (("a", m.repartitionByRange(1, "window_start").sortWithinPartitions("window_start"), 1), ("b", m.repartition(3), None)):
        src = str(tmp_path / f"in_{name}")
        frame.write.option("maxRecordsPerFile", 20).parquet(src)
        s = mon.history_deviation_stream(mon.read_stream(spark, src, m.schema, files_per_batch=per_batch), "window_start", "mean", "kind", "10 minutes")
        mon.append_to_table(s, str(tmp_path / f"out_{name}"), str(tmp_path / f"cp_{name}")).awaitTermination()
        got = spark.read.parquet(str(tmp_path / f"out_{name}")).toPandas().sort_values(key)["z"].to_numpy(float)
        assert len(got) > 20
        np.testing.assert_allclose(got, want, rtol=1e-9, atol=1e-9)


def test_alerts_default_limits(spark):
    rows = [(1, 900.0, 0.005, 0.99), (2, 2500.0, 0.016, 0.9)]
    df = spark.createDataFrame(rows, "id int, latency_ms double, error_rate double, data_quality_score double")
    out = {(r["id"], r["metric"]): r["severity"] for r in mon.threshold_alerts(df).collect()}
    assert out == {(2, "latency_ms"): "critical", (2, "error_rate"): "high", (2, "data_quality_score"): "medium"}


def test_group_function_on_hot_group(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string").substr(1, 1)).alias("g"), F.col("id").alias("x")).repartition(9)
    out = udfs.group_function_apply(
        df, ["g"], lambda p: {"n": len(p), "hi": p["x"].max()}, lambda s: {"n": int(s["n"].sum()), "hi": s["hi"].max()}, lambda s: s,
        "n long, hi long", "n long, hi long",
    )
    want = df.groupBy("g").agg(F.count("*").alias("n"), F.max("x").alias("hi"))
    assert sorted(out.collect()) == sorted(want.collect())
