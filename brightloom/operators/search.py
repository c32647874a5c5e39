"""Document search: chunks, hashed embeddings, nearest neighbours, index, history, exports."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, BucketedRandomProjectionLSH, HashingTF, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brightloom.functions.text import STOP_WORDS, tokens
from brightloom.operators.ranking import join_null_safe
from brightloom.session import measured
from brightloom.sources.sinks import sink_parquet

CHUNK, OVERLAP = 1000, 200  # fixed values: characters per chunk and shared with the next


def chunk_stride(df: DataFrame, key: str, text: str, size: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Fixed-stride chunks of the whole text: ``(source, chunk_id, total_chunks, chunk)``. Column expressions only."""
    step = size - overlap
    total = F.greatest(F.ceil((F.length(text) - overlap) / step), F.lit(1)).cast("int")
    d = df.select(F.col(key).alias("source"), F.col(text).alias("__t"), total.alias("total_chunks"))
    d = d.withColumn("chunk_id", F.explode(F.sequence(F.lit(0), F.col("total_chunks") - 1)))
    return d.select("source", "chunk_id", "total_chunks", F.expr(f"substring(__t, chunk_id * {step} + 1, {size})").alias("chunk"))


def _cuts(text: str, size: int, overlap: int) -> list[str]:
    """Chunks of at most ``size`` characters that end at a paragraph, line or word break where one exists."""
    out, start = [], 0
    while len(text) - start > size:
        window = text[start : start + size]
        end = size
        for sep in ("\n\n", "\n", " "):
            at = window.rfind(sep, overlap + 1)
            if at > 0:
                end = at + len(sep)
                break
        out.append(window[:end])
        start += end - overlap
    out.append(text[start:])
    return out


def chunk_boundary(df: DataFrame, key: str, text: str, size: int = CHUNK, overlap: int = OVERLAP, texts: int = 100) -> DataFrame:
    """Boundary-aware chunks; each repeats the last ``overlap`` characters of the one before.

    Only ``texts`` texts of a batch and their chunks are held as Python strings at a time.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (b.slice(i, texts) for b in batches for i in range(0, b.num_rows, texts)):
            chunks = [_cuts(t, size, overlap) if t is not None else [] for t in part.column(1).to_pylist()]
            counts = [len(c) for c in chunks]
            source = part.column(0).take(pa.array(np.repeat(np.arange(len(chunks)), counts)))
            ids, totals = [i for n in counts for i in range(n)], [n for n in counts for _ in range(n)]
            yield pa.RecordBatch.from_arrays([source, pa.array(ids, pa.int32()), pa.array(totals, pa.int32()), pa.array([c for own in chunks for c in own], pa.string())], ["source", "chunk_id", "total_chunks", "chunk"])

    d = df.select(F.col(key).alias("source"), F.col(text))
    return d.mapInArrow(cut, f"source {d.schema['source'].dataType.simpleString()}, chunk_id int, total_chunks int, chunk string")


def embed_text(df: DataFrame, text: str, features: int = 256) -> DataFrame:
    """Add ``embedding``: L2-normalised hashed TF-IDF as ``array<float>``."""
    d = df.withColumn("__toks", tokens(text, STOP_WORDS, 2))
    stages = [
        HashingTF(inputCol="__toks", outputCol="__tf", numFeatures=features), IDF(inputCol="__tf", outputCol="__idf"),
        Normalizer(inputCol="__idf", outputCol="__v"),
    ]
    out = Pipeline(stages=stages).fit(d).transform(d)
    return out.withColumn("embedding", vector_to_array("__v", "float32")).drop("__toks", "__tf", "__idf", "__v")


def _near_pairs(m: np.ndarray, x: np.ndarray, n: int, reach: np.ndarray, cells: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of pairs (row of ``m``, row of ``x``) that hold, for every row of ``m``, all rows of ``x`` that can be among its ``n`` nearest.

    Distances in matrix form are off by at most ``off``; a pair is left out only if even its least possible distance is more than
    ``n`` others have at most, here or by ``reach`` (a bound per row of ``m``), so equally near rows all stay.
    """
    squares_m, squares_x = (m * m).sum(axis=1), (x * x).sum(axis=1)
    slack = 4 * (x.shape[1] + 4) * np.finfo(float).eps
    step, most = max(1, cells // len(x)), max(1, cells // x.shape[1])
    for a in range(0, len(m), step):
        mine = slice(a, a + step)
        sums = squares_m[mine, None] + squares_x[None, :]
        rough = np.maximum(sums - 2 * (m[mine] @ x.T), 0)
        off = 2 * slack * sums
        bound = reach[mine]
        if len(x) >= n:
            bound = np.fmin(bound, np.partition(rough + off, n - 1, axis=1)[:, n - 1])
        at, of = np.nonzero(~(rough - off > bound[:, None]))  # what cannot be compared stays
        for i in range(0, len(at), most):
            yield at[i : i + most] + a, of[i : i + most]


def nearest_in_block(m: np.ndarray, reach: np.ndarray, x: np.ndarray, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row of m, key, squared distance)``: the ``n`` nearest rows of ``x`` for every row of ``m``, ties by key; none beyond ``reach``."""
    best = (np.zeros(0, np.int64), keys[:0], np.zeros(0))
    for at, of in _near_pairs(m, x, n, reach):
        d = ((x[of] - m[at]) ** 2).sum(axis=1)
        at, k, d = (np.concatenate(c) for c in zip(best, (at, keys[of], d)))
        order = np.lexsort((k, d, at))
        order = order[np.arange(len(order)) - np.searchsorted(at[order], at[order]) < n]
        best = at[order], k[order], d[order]
    return best


def _stacked(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float)


def _to_centres(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Distances of the rows of ``x`` to all centres."""
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (centres * centres).sum(1)[None, :] - 2 * x @ centres.T, 0))


def fit_centres(rows: DataFrame, vector: str, cells: int, sample: int = 20_000, rounds: int = 5) -> np.ndarray:
    """At most ``cells`` centres by k-means on about ``sample`` of the distinct vectors, drawn by their hash, in one task."""
    drawn = rows.select(F.col(vector).cast("array<double>").alias("v")).distinct().withColumn("h", F.xxhash64("v")).orderBy("h", "v").limit(sample)

    def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [f for f in frames if len(f)]
        if not got:
            return
        x = _stacked(pd.concat(got)["v"])
        centres = x[:cells].copy()  # in hash order, so they are drawn at random
        for _ in range(rounds):
            own = _to_centres(x, centres).argmin(axis=1)
            size = np.bincount(own, minlength=len(centres))
            sums = np.zeros_like(centres)
            np.add.at(sums, own, x)
            centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
        yield pd.DataFrame({"c": list(centres)})

    found = drawn.select("v").coalesce(1).mapInPandas(fit, "c array<double>").collect()  # at most `cells` rows
    return np.array([r["c"] for r in found])


def knn_search(
    queries: DataFrame, index: DataFrame, query_key: str, key: str, vector: str = "embedding", n: int = 5, cells: int | None = None, block: int = 20_000, widen: int = 8
) -> DataFrame:
    """Exact ``n`` nearest index rows per query by squared L2: ``(query key, rank, key, distance)``.

    Index rows are kept by cell, the nearest of about sqrt(rows) coarse k-means centres, with their distance to it. A query
    first visits the nearest cells that together hold ``n`` rows, then up to ``widen`` more and then all others that the triangle inequality does
    not rule out: a cell whose rows are ``low`` to ``high`` away from its centre has none nearer than the query's distance to the centre
    less ``high``, or ``low`` less that distance. Rows of a visited cell are ruled out in the same way by their own distance to
    the centre. Each round is a join of queries and rows by cell; cells and the queries that visit them are cut into blocks of about
    ``block`` rows, so a hot cell is many tasks, and a query whose cells are all visited or ruled out takes no part in later rounds. Centres and
    cell statistics are all that the driver holds. Ties go to the smaller key; rows without a vector are left out; query
    keys must be unique.
    """
    rows = index.select(F.col(key).alias("k"), F.col(vector).alias("v")).filter("v IS NOT NULL")
    q = measured(queries.select(F.col(query_key).alias("qk"), F.col(vector).cast("array<double>").alias("v")).filter("v IS NOT NULL"))
    k_type, q_type, v_type = (t.dataType.simpleString() for t in (rows.schema["k"], q.schema["qk"], rows.schema["v"]))
    result = f"qk {q_type}, k {k_type}, distance double"
    centres = fit_centres(rows, "v", cells or int(min(max(rows.count() ** 0.5, 8), 1024)))
    if not len(centres):
        return q.sparkSession.createDataFrame([], result).select(F.col("qk").alias(query_key), F.lit(1).alias("rank"), F.col("k").alias("neighbor"), "distance")

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in filter(len, frames):
            d = _to_centres(_stacked(f["v"]), centres)
            own = d.argmin(axis=1)
            yield f.assign(cell=own.astype(np.int32), r=d[np.arange(len(d)), own])

    placed = measured(rows.mapInPandas(place, f"k {k_type}, v {v_type}, cell int, r double"))
    facts = {r["cell"]: r for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("r").alias("low"), F.max("r").alias("high")).collect()}
    size, low, high = (np.array([facts[c][name] if c in facts else 0.0 for c in range(len(centres))]) for name in ("n", "low", "high"))
    scale = 1 + float(np.sqrt((centres * centres).sum(axis=1)).max()) + float(high.max())

    def slack(m: np.ndarray) -> np.ndarray:
        """More than rounding can change a distance of each row of ``m``."""
        return 1e-6 * (scale + np.sqrt((m * m).sum(axis=1)))

    def visits(first: int, last: int | None):
        """Rows ``(cell, qk, v, tau)`` of the cells that a query has at places ``first`` to ``last`` of its order and cannot rule out."""

        def plan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in filter(len, frames):
                m = _stacked(f["v"])
                d = _to_centres(m, centres)
                tau = f["tau"].to_numpy(float)
                order = np.argsort(np.where(size > 0, d, np.inf), axis=1, kind="stable")
                held = np.cumsum(size[order], axis=1)
                start = (held < n).sum(axis=1) + 1  # cells of the first round
                nearest = np.maximum(np.maximum(d - high, low - d), 0)
                needed = (size > 0) & (np.maximum(nearest - slack(m)[:, None], 0) ** 2 <= tau[:, None])
                at = np.empty_like(order)
                np.put_along_axis(at, order, np.arange(d.shape[1])[None, :], axis=1)
                begin = 0 if first == 0 else start + (0 if first == 1 else widen)
                end = start if last == 0 else start + widen if last == 1 else np.full(len(f), d.shape[1])
                which, cell = np.nonzero(needed & (at >= np.reshape(begin, (-1, 1))) & (at < end[:, None]))
                for i in range(0, len(which), 4096):
                    w = which[i : i + 4096]
                    yield f.iloc[w][["qk", "v", "tau"]].assign(cell=cell[i : i + 4096].astype(np.int32))

        return plan

    def search(theirs: pd.DataFrame, mine: pd.DataFrame) -> pd.DataFrame:
        if not len(theirs) or not len(mine):
            return pd.DataFrame({"qk": theirs["qk"][:0], "k": mine["k"][:0], "distance": []})
        m, tau = _stacked(theirs["v"]), theirs["tau"].to_numpy(float)
        x, keys, r = _stacked(mine["v"]), mine["k"].to_numpy(), mine["r"].to_numpy(float)
        to_centre = _to_centres(m, centres[[int(theirs["cell"].iloc[0])]])[:, 0]
        far = np.sqrt(tau) + slack(m)
        near = (r >= (to_centre - far).min()) & (r <= (to_centre + far).max())
        if not near.any():
            near[0] = True
        at, k, d = nearest_in_block(m, tau, x[near], keys[near], n)
        return pd.DataFrame({"qk": theirs["qk"].to_numpy()[at], "k": k, "distance": d})

    def visit(asked: DataFrame, first: int, last: int | None) -> DataFrame | None:
        """Candidates of one round, or None if no query is open."""
        planned = measured(asked.mapInPandas(visits(first, last), f"qk {q_type}, v array<double>, tau double, cell int"))
        wanted = {r["cell"]: r["count"] for r in planned.groupBy("cell").count().collect()}  # at most one row per cell
        if not wanted:
            return None

        def blocks(counts: dict) -> Column:
            return F.get(F.array(*[F.lit(max(1, -(-int(counts.get(c, 0)) // block))) for c in range(len(centres))]), F.col("cell"))

        row_blocks, query_blocks = blocks({c: f["n"] for c, f in facts.items()}), blocks(wanted)
        of_rows = lambda key: F.pmod(F.xxhash64(key), row_blocks).cast("int")
        left = planned.select("cell", F.pmod(F.xxhash64("qk"), query_blocks).cast("int").alias("qb"), F.explode(F.sequence(F.lit(0), row_blocks - 1)).alias("rb"), "qk", "v", "tau")
        right = placed.filter(F.col("cell").isin(list(wanted))).select("cell", F.explode(F.sequence(F.lit(0), query_blocks - 1)).alias("qb"), of_rows("k").alias("rb"), "k", "v", "r")
        by = ["cell", "qb", "rb"]
        tasks = min(10_000, max(q.sparkSession.sparkContext.defaultParallelism, 2 * sum(-(-int(f["n"]) // block) for c, f in facts.items() if c in wanted)))
        left, right = left.repartition(tasks, *by), right.repartition(tasks, *by)
        return measured(left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(search, result))

    w = Window.partitionBy("qk").orderBy("distance", "k")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)

    found = visit(q.withColumn("tau", F.lit(float("inf"))), 0, 0)
    for first, last in ((1, 1), (2, None)) if found is not None else ():
        reached = best(found).groupBy("qk").agg(F.max(F.when(F.col("rank") == n, F.col("distance"))).alias("tau"))
        asked = join_null_safe(q, measured(reached), ["qk"], "left").withColumn("tau", F.coalesce("tau", F.lit(float("inf"))))
        more = visit(asked, first, last)
        found = found if more is None else found.unionByName(more)
    found = found if found is not None else q.sparkSession.createDataFrame([], result)
    return best(found).select(F.col("qk").alias(query_key), "rank", F.col("k").alias("neighbor"), "distance")


def knn_search_lsh(
    queries: DataFrame, index: DataFrame, query_key: str, key: str, vector: str = "embedding", n: int = 5, width: float = 1.0, tables: int = 8,
    seed: int = 42, max_distance: float = float("inf"), block: int = 20_000,
) -> DataFrame:
    """Approximate ``n`` nearest index rows for any number of queries: same columns as ``knn_search``.

    Queries and index rows meet in the buckets of ``tables`` random projections of bucket ``width`` (an equi-join, no side
    is collected or broadcast by force); distances of the pairs that meet are exact. A bucket is cut into blocks of about ``block``
    queries and rows, and a block returns only the ``n`` nearest rows of each of its queries, so pairs that meet are never written.
    Rows in buckets without queries are not moved. Equal rows count once.
    """

    def hashed(df: DataFrame, k: str, name: str) -> DataFrame:
        return df.filter(F.col(vector).isNotNull()).select(F.col(k).alias(name), F.col(vector).alias("a")).distinct().withColumn("v", array_to_vector(F.col("a").cast("array<double>")))

    q, rows = hashed(queries, query_key, "qk"), hashed(index, key, "k")
    model = BucketedRandomProjectionLSH(inputCol="v", outputCol="h", bucketLength=width, numHashTables=tables, seed=seed).fit(rows)
    buckets = F.array(*[vector_to_array(F.get("h", F.lit(i)))[0] for i in range(tables)])
    q, rows = (measured(model.transform(d).select(c, "a", F.xxhash64("a").alias(f"{c}h"), buckets.alias("b"))) for d, c in ((q, "qk"), (rows, "k")))

    def counts(d: DataFrame, name: str) -> DataFrame:
        return d.select(F.posexplode("b").alias("t", "b")).groupBy("t", "b").agg(F.ceil(F.count("*") / block).cast("int").alias(name))

    shared = measured(counts(q, "qbs").join(counts(rows, "rbs"), ["t", "b"]))  # buckets with queries and rows
    by = ["t", "b", "qb", "rb"]

    def blocks(d: DataFrame, c: str, own: str, other: str) -> DataFrame:
        met = d.select(c, f"{c}h", "a", F.posexplode("b").alias("t", "b")).join(shared, ["t", "b"])
        met = met.withColumn(own, F.pmod(F.xxhash64(c, f"{c}h"), F.col(f"{own}s")).cast("int"))
        return met.select(*by[:2], own, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)).alias(other), c, f"{c}h", "a")

    k_type, q_type = rows.schema["k"].dataType.simpleString(), q.schema["qk"].dataType.simpleString()

    def search(theirs: pd.DataFrame, mine: pd.DataFrame) -> pd.DataFrame:
        if not len(theirs) or not len(mine):
            return pd.DataFrame({"qk": theirs["qk"][:0], "qkh": theirs["qkh"][:0], "k": mine["k"][:0], "kh": mine["kh"][:0], "distance": []})
        mine = mine.sort_values("k", na_position="first", kind="stable")
        at, of, d = nearest_in_block(_stacked(theirs["a"]), np.full(len(theirs), np.inf), _stacked(mine["a"]), np.arange(len(mine)), n)
        theirs, mine = theirs.iloc[at].reset_index(drop=True), mine.iloc[of].reset_index(drop=True)
        return pd.DataFrame({"qk": theirs["qk"], "qkh": theirs["qkh"], "k": mine["k"], "kh": mine["kh"], "distance": d})

    groups = shared.agg(F.sum(F.col("qbs").cast("long") * F.col("rbs"))).first()[0] or 0
    tasks = min(10_000, max(q.sparkSession.sparkContext.defaultParallelism, 2 * groups))
    left, right = (d.repartition(tasks, *by).groupBy(*by) for d in (blocks(q, "qk", "qb", "rb"), blocks(rows, "k", "rb", "qb")))
    met = left.cogroup(right).applyInPandas(search, f"qk {q_type}, qkh long, k {k_type}, kh long, distance double")
    met = met.filter(F.sqrt("distance") < max_distance).dropDuplicates(["qk", "qkh", "k", "kh"])
    w = Window.partitionBy("qk").orderBy("distance", "k")
    ranked = met.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
    return ranked.select(F.col("qk").alias(query_key), "rank", F.col("k").alias("neighbor"), "distance")


def reindex_overwrite(chunks: DataFrame, path: str, partitions: Sequence[str] = ()) -> DataFrame:
    """Replace the whole index below ``path``; chunk ids are ``<source>_<chunk_id>``."""
    keyed = chunks.withColumn("id", F.concat(F.col("source").cast("string"), F.lit("_"), F.col("chunk_id").cast("string")))
    sink_parquet(keyed, path, partitions)
    return chunks.sparkSession.read.parquet(path)


def record_search(spark: SparkSession, path: str, entries: DataFrame) -> None:
    """Append ``(timestamp, query, num_results)`` rows to the history table."""
    entries.write.mode("append").parquet(path)


def search_activity(history: DataFrame, ts: str = "timestamp", results: str = "num_results") -> DataFrame:
    """Searches and mean result count per day."""
    return history.groupBy(F.to_date(ts).alias("date")).agg(F.count("*").alias("searches"), F.avg(results).alias("mean_results"))


def export_rows(results: DataFrame) -> DataFrame:
    """Flatten ``content, metadata{source, chunk_id, total_chunks}, distance`` for CSV or JSON export."""
    return results.select("content", "metadata.source", "metadata.chunk_id", "distance")
