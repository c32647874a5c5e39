"""Customer segmentation."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.operators.anomaly import zscore_scale
from brightloom.operators.features import label_encode
from brightloom.operators.quality import impute_mean_mode
from brightloom.session import measured, spread, stages
from brightloom.sources.sinks import sink_csv, sink_json


def segment_preprocess(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Impute, replace categories by alphabetical codes, scale every listed column to ``<c>_z``."""
    out = impute_mean_mode(df, numeric, categorical)
    for c in categorical:
        out = label_encode(out, c)
    return zscore_scale(out, [*numeric, *[f"{c}_code" for c in categorical]])


def assemble(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(df)


def vectors_from_array(df: DataFrame, c: str) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(c).cast("array<double>")))


Fit = tuple[int, np.ndarray]  # k and the centres


def _starts(data: DataFrame, ks: Sequence[int], restarts: int, seed: int, parallelism: int) -> list[Fit]:
    """Where k-means begins per k and restart (k-means||); a fit without rounds ends there. ``parallelism`` at a time."""
    plain = data.select(F.col("features").alias("features"))  # not the stored table itself: vectors are then unpacked once per fit

    def start(task: tuple[int, int]) -> Fit:
        k, i = task
        return k, np.array(KMeans(k=k, seed=seed + i, maxIter=0, featuresCol="features", predictionCol="segment").fit(plain).clusterCenters())

    with ThreadPool(parallelism) as pool:
        return pool.map(start, [(int(k), i) for k in ks for i in range(restarts)])


def _rows(batch: pa.RecordBatch, middle: np.ndarray, run: int = 4096) -> Iterator[np.ndarray]:
    """The vectors of a batch less ``middle``, a few at a time, so that distances to all centres stay small."""
    x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
    for i in range(0, len(x), run):
        yield x[i : i + run] - middle


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per fit of ``centres`` (fits, k, components) the number of every row's nearest centre (ties: the first), and the squared distance."""
    fits, k, d = centres.shape
    far = (centres * centres).sum(axis=2)[:, :, None] - 2 * (centres.reshape(fits * k, d) @ x.T).reshape(fits, k, len(x))
    at, least = np.zeros((fits, len(x)), np.int32), far[:, 0].copy()
    for j in range(1, k):
        nearer = far[:, j] < least
        np.copyto(at, j, where=nearer)
        np.copyto(least, far[:, j], where=nearer)
    return at, np.maximum(least + (x * x).sum(axis=1), 0)


def _round(points: DataFrame, centres: list[np.ndarray], middle: np.ndarray) -> list[np.ndarray]:
    """For every fit in one pass, per centre ``(rows, distance, sums of the components)``. Tasks return sums of a fixed size."""
    sizes = sorted({len(c) for c in centres})
    of = {k: [f for f, c in enumerate(centres) if len(c) == k] for k in sizes}
    shared = points.sparkSession.sparkContext.broadcast(({k: np.stack([centres[f] for f in of[k]]) - middle for k in sizes}, middle))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stacks, origin = shared.value
        total = {k: np.zeros((*c.shape[:2], c.shape[2] + 2)) for k, c in stacks.items()}
        for x in (x for batch in batches if len(batch) for x in _rows(batch, origin)):
            facts = np.c_[np.ones(len(x)), x]
            for k, c in stacks.items():
                at, far = _nearest(x, c)
                for j in range(k):
                    own = (at == j).astype(float)
                    total[k][:, j, [0, *range(2, facts.shape[1] + 1)]] += own @ facts
                    total[k][:, j, 1] += (own * far).sum(axis=1)
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([t.ravel() for t in total.values()]).tobytes()], pa.binary())], ["sums"])

    parts = points.mapInArrow(partial, "sums binary").collect()  # one small row per task
    shared.destroy()
    total = sum(np.frombuffer(r["sums"]) for r in parts)
    out: list[np.ndarray] = [np.zeros(0)] * len(centres)
    for k in sizes:
        size = len(of[k]) * k * (len(middle) + 2)
        for f, own in zip(of[k], total[:size].reshape(len(of[k]), k, -1)):
            out[f] = own
        total = total[size:]
    return out


def _fits(data: DataFrame, ks: Sequence[int], restarts: int, seed: int, parallelism: int, rounds: int = 20, tol: float = 1e-4) -> dict[int, np.ndarray]:
    """The centres with the lowest cost of ``restarts`` per k.

    All fits move on together: a pass assigns every row in each of those that have not settled, up to ``rounds`` passes. A fit has
    settled when no centre moves farther than ``tol``; its cost is that of its last pass.
    """
    fits = _starts(data, ks, restarts, seed, parallelism)
    centres, costs = [c for _, c in fits], [np.inf] * len(fits)
    middle = np.mean([c.mean(axis=0) for c in centres], axis=0)
    moving = list(range(len(fits)))
    with stages(data.sparkSession):
        points = measured(spread(data.select(vector_to_array("features").alias("x"))))
        for _ in range(rounds):
            if not moving:
                break
            for f, sums in zip(list(moving), _round(points, [centres[f] for f in moving], middle)):
                rows = sums[:, :1]
                moved = np.where(rows > 0, sums[:, 2:] / np.maximum(rows, 1) + middle, centres[f])
                if (((moved - centres[f]) ** 2).sum(axis=1) <= tol * tol).all():
                    moving.remove(f)
                centres[f], costs[f] = moved, sums[:, 1].sum()
    best: dict[int, int] = {}
    for f, (k, _) in enumerate(fits):
        if k not in best or costs[f] < costs[best[k]]:
            best[k] = f
    return {k: centres[f] for k, f in best.items()}


def _assign(df: DataFrame, centres: Sequence[np.ndarray], names: Sequence[str]) -> DataFrame:
    """Add the number of the nearest centre per fit."""
    middle = np.mean([c.mean(axis=0) for c in centres], axis=0)
    shared = df.sparkSession.sparkContext.broadcast([c - middle for c in centres])

    @F.pandas_udf("array<int>")
    def place(x: pd.Series) -> pd.Series:
        rows = np.stack(x.to_numpy()) - middle if len(x) else np.zeros((0, len(middle)))
        runs = [np.stack([_nearest(rows[i : i + 4096], c[None])[0][0] for c in shared.value], axis=1) for i in range(0, len(rows), 4096)]
        return pd.Series([list(r) for run in runs for r in run.tolist()], dtype=object)

    out = df.withColumn("__at", place(vector_to_array("features")))
    return out.withColumns({n: F.col("__at")[i] for i, n in enumerate(names)}).drop("__at")


def optimal_clusters(df: DataFrame, ks: Sequence[int] = range(2, 11), restarts: int = 10, seed: int = 42, parallelism: int = 4) -> DataFrame:
    """``(k, silhouette, best)``: squared-Euclidean silhouette of the k-means fit per k over all rows; the first
    maximum is best."""
    data = df.select("features").persist()
    try:
        fits = _fits(data, ks, restarts, seed, parallelism)
        names = {k: f"segment_{k}" for k in fits}
        with stages(df.sparkSession):
            placed = measured(_assign(data, list(fits.values()), list(names.values())))

            def judge(k: int) -> float:
                return float(ClusteringEvaluator(predictionCol=names[k], featuresCol="features").evaluate(placed.select("features", names[k])))

            with ThreadPool(parallelism) as pool:
                scores = list(zip(fits, pool.map(judge, fits)))
    finally:
        data.unpersist()
    top = max(s for _, s in scores)
    best = next(k for k, s in scores if s == top)
    return df.sparkSession.createDataFrame([(k, s, k == best) for k, s in scores], "k int, silhouette double, best boolean")


def kmeans_segments(df: DataFrame, k: int, restarts: int = 10, seed: int = 42, parallelism: int = 4) -> DataFrame:
    """Add ``segment`` of the restart with the lowest cost."""
    data = df.select("features").persist()
    try:
        centres = _fits(data, [k], restarts, seed, parallelism)[k]
    finally:
        data.unpersist()
    return _assign(df, [centres], ["segment"])


def pca_2d(df: DataFrame) -> DataFrame:
    """Add ``pc1`` and ``pc2`` of centred ``features``; signs are arbitrary."""
    out = PCA(k=2, inputCol="features", outputCol="__pc").fit(df).transform(df)
    a = vector_to_array("__pc")
    return out.withColumns({"pc1": a[0], "pc2": a[1]}).drop("__pc")


def segment_profiles(df: DataFrame, segment: str, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Per segment: size, share of rows in %, ``mean_<c>`` per numeric and ``mode_<c>`` per categorical column."""
    base = df.groupBy(segment).agg(F.count("*").alias("size"), *[F.avg(c).alias(f"mean_{c}") for c in numeric])
    base = base.withColumn("pct", F.col("size") * 100 / df.agg(F.count("*")).scalar())
    if not categorical:
        return base
    long = df.select(segment, *categorical).unpivot([segment], list(categorical), "column", "value").filter("value IS NOT NULL")
    counts = long.groupBy(segment, "column", "value").agg(F.count("*").alias("n"))
    first = F.min(F.struct((-F.col("n")).alias("neg"), "value"))["value"]
    modes = counts.groupBy(segment).pivot("column", list(categorical)).agg(first)
    modes = modes.withColumnsRenamed({c: f"mode_{c}" for c in categorical})
    return base.join(modes, segment, "left")


def segment_feature_importance(df: DataFrame, segment: str, columns: Sequence[str]) -> DataFrame:
    """``(feature, importance)``: absolute Pearson correlation of every column with the segment label."""
    row = df.agg(*[F.abs(F.corr(c, segment)).alias(c) for c in columns])
    return row.unpivot([], list(columns), "feature", "importance").orderBy(F.desc("importance"), "feature")


def save_segments(rows: DataFrame, components: DataFrame, profiles: DataFrame, path: str) -> dict[str, str]:
    """Write the segmented rows and components as CSV and the profiles as JSON; returns the folders."""
    out = {"rows": f"{path}/rows", "components": f"{path}/components", "profiles": f"{path}/profiles"}
    sink_csv(rows, out["rows"])
    sink_csv(components, out["components"])
    sink_json(profiles, out["profiles"])
    return out
