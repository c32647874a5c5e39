"""Anomaly detectors. Statistics enter as one-row scalar subqueries, so a flag is a column expression."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from brightloom.operators.profile import QUARTILES
from brightloom.operators.ranking import exact_quantiles, framed, with_stats
from brightloom.session import measured


def zscore_scale(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None, suffix: str = "_z") -> DataFrame:
    """Add ``(x - mean) / population std`` per column; a constant column gives 0."""
    src = df if fit_on is None else fit_on
    stats = src.agg(F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("sd")).alias(c) for c in columns]))
    s = F.col("__s")
    out = with_stats(df, stats).withColumns(
        {
            f"{c}{suffix}": F.when(s[c]["sd"] > 0, (F.col(c) - s[c]["m"]) / s[c]["sd"]).when(F.col(c).isNotNull(), F.lit(0.0))
            for c in columns
        }
    )
    return out.drop("__s")


def zscore_flag(df: DataFrame, c: str, limit: float = 3.0, name: str = "z_anomaly") -> DataFrame:
    """Add the flag |z| > limit; null stays null."""
    return zscore_scale(df, [c], suffix="__z").withColumn(name, F.abs(f"{c}__z") > limit).drop(f"{c}__z")


def iqr_flag(df: DataFrame, c: str, k: float = 1.5, name: str = "iqr_anomaly") -> DataFrame:
    """Add the flag x < q1 - k·IQR or x > q3 + k·IQR with exact quartiles."""
    width = (F.col("q3") - F.col("q1")) * k
    fences = exact_quantiles(df, [c], QUARTILES).select(F.struct((F.col("q1") - width).alias("lo"), (F.col("q3") + width).alias("hi")))
    s = F.col("__s")
    return with_stats(df, fences).withColumn(name, (F.col(c) < s["lo"]) | (F.col(c) > s["hi"])).drop("__s")


def anomaly_ensemble(df: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    """Add ``methods`` (names of the detectors that fired) and ``is_anomaly``."""
    fired = F.filter(F.array(*[F.when(flag, F.lit(n)) for n, flag in flags.items()]), lambda x: x.isNotNull())
    return df.withColumn("methods", fired).withColumn("is_anomaly", F.size("methods") > 0)


def anomaly_summary(df: DataFrame, flags: Sequence[str], ts: str, value: str) -> DataFrame:
    """One row: rows, count per flag, any flag, time range, value range."""
    hit = F.lit(False)
    for f in flags:
        hit = hit | F.coalesce(F.col(f), F.lit(False))
    return df.agg(
        F.count("*").alias("n_rows"), *[F.count_if(F.col(f)).alias(f"n_{f}") for f in flags], F.count_if(hit).alias("n_any"),
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.min(value).alias("lowest"), F.max(value).alias("highest"),
    )


def _average_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search in a binary tree of n points."""
    n = np.asarray(n, dtype=float)
    out = np.where(n == 2, 1.0, 0.0)
    big = n > 2
    out[big] = 2 * (np.log(n[big] - 1) + np.euler_gamma) - 2 * (n[big] - 1) / n[big]
    return out


def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """Random splits of one sample: nodes ``(feature, cut, left, right, path)``; leaves have feature -1."""
    nodes: list[tuple] = []
    todo = [(np.arange(len(x)), 0, -1, False)]
    while todo:
        idx, depth, parent, is_right = todo.pop()
        me = len(nodes)
        if parent >= 0:
            f, cut, lo, hi, path = nodes[parent]
            nodes[parent] = (f, cut, lo, me, path) if is_right else (f, cut, me, hi, path)
        part = x[idx]
        spread = np.flatnonzero(part.max(axis=0) > part.min(axis=0)) if len(idx) > 1 else np.array([], dtype=int)
        if depth >= max_depth or len(spread) == 0:
            nodes.append((-1, 0.0, -1, -1, depth + float(_average_path(np.array([len(idx)]))[0])))
            continue
        f = int(rng.choice(spread))
        cut = float(rng.uniform(part[:, f].min(), part[:, f].max()))
        nodes.append((f, cut, -1, -1, 0.0))
        goes = part[:, f] < cut
        todo += [(idx[~goes], depth + 1, me, True), (idx[goes], depth + 1, me, False)]
    return nodes


def fit_isolation_forest(
    df: DataFrame, columns: Sequence[str], key: str, trees: int = 100, sample: int = 256, seed: int = 42
) -> list[list[tuple]]:
    """Grow ``trees`` isolation trees in parallel, each from ``sample`` rows drawn by key hash.

    The first ``trees * sample`` rows in hash order form a fixed-size pool (a top-n, no full sort); tree t
    takes its own slice of it, wrapping around when the table is smaller. The model returned to the driver
    is bounded by ``trees * 2 * sample`` nodes.
    """
    cols = list(columns)
    size = trees * sample
    pool = (
        df.na.drop(subset=cols)
        .select(F.xxhash64(F.lit(seed), F.col(key).cast("string")).alias("h"), *[F.col(c).cast("double").alias(c) for c in cols])
        .orderBy("h", *cols).limit(size)
    )
    pool = pool.withColumn("j", F.row_number().over(Window.orderBy("h", *cols)) - 1)  # at most `size` rows
    n = pool.agg(F.count("*")).scalar()
    slots = df.sparkSession.range(size).select(
        (F.col("id") / sample).cast("int").alias("tree"), (F.col("id") % sample).alias("i"), F.pmod(F.col("id"), n).cast("int").alias("j")
    ).filter(F.col("i") < n)
    rows = slots.join(pool, "j")

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = pdf.sort_values("i")[cols].to_numpy(float)
        nodes = _grow(x, np.random.default_rng([seed, tree]), int(np.ceil(np.log2(max(len(x), 2)))))
        out = pd.DataFrame(nodes, columns=["feature", "cut", "lo", "hi", "path"])
        out.insert(0, "tree", tree)
        out.insert(1, "node", range(len(out)))
        out["n"] = len(x)
        return out

    schema = "tree int, node int, feature int, cut double, lo int, hi int, path double, n int"
    grown = rows.groupBy("tree").applyInPandas(grow, schema).toPandas()
    return [g.sort_values("node") for _, g in grown.groupby("tree")]


def isolation_forest(
    df: DataFrame, columns: Sequence[str], key: str, contamination: float = 0.1, trees: int = 100, sample: int = 256, seed: int = 42
) -> DataFrame:
    """Add ``if_score`` (near 1 = anomalous) and ``if_anomaly`` for the top ``contamination`` share of scores.

    The scored rows are written once, because the threshold and the result both need them.
    """
    cols = list(columns)
    grown = fit_isolation_forest(df, cols, key, trees, sample, seed)
    starts = np.cumsum([0] + [len(g) for g in grown[:-1]])
    nodes = {c: np.concatenate([g[c].to_numpy() for g in grown]) for c in ("feature", "cut", "lo", "hi", "path")}
    shift = np.repeat(starts, [len(g) for g in grown])
    leaf = nodes["feature"] < 0
    for side in ("lo", "hi"):  # leaves point at themselves, so walking on changes nothing
        nodes[side] = np.where(leaf, np.arange(len(leaf)), nodes[side] + shift)
    model = (np.maximum(nodes["feature"], 0), nodes["cut"], nodes["lo"], nodes["hi"], nodes["path"], starts)
    depth = int(np.ceil(np.log2(max(sample, 2))))
    used = min(sample, df.select(*cols).na.drop().limit(sample).count())
    shared = df.sparkSession.sparkContext.broadcast((model, float(_average_path(np.array([max(used, 2)]))[0])))

    @F.pandas_udf("double")
    def score(block: pd.DataFrame) -> pd.Series:
        forest, norm = shared.value
        x = block.to_numpy(float)
        ok = ~np.isnan(x).any(axis=1)
        feature, cut, lo, hi, path, roots = forest
        mean_path = np.empty(len(x))
        for s in range(0, len(x), 2048):
            block_x = x[s : s + 2048]
            rows = np.arange(len(block_x))[:, None]
            at = np.broadcast_to(roots, (len(block_x), len(roots)))
            for _ in range(depth):
                at = np.where(block_x[rows, feature[at]] < cut[at], lo[at], hi[at])
            mean_path[s : s + 2048] = path[at].mean(axis=1)
        out = np.power(2.0, -mean_path / norm)
        return pd.Series(np.where(ok, out, np.nan))

    scored = measured(df.withColumn("if_score", F.nanvl(score(F.struct(*[F.col(c).cast("double").alias(c) for c in cols])), F.lit(None))))
    cut = exact_quantiles(scored.select("if_score"), ["if_score"], {"cut": 1.0 - contamination}).select("cut").scalar()
    return scored.withColumn("if_anomaly", F.col("if_score") > cut)


def lag_vectors(df: DataFrame, order: str, value: str, lags: int = 7) -> DataFrame:
    """Add ``window_values``: the value and its predecessors, for rows with a full history (one row per period)."""

    def columns(w: WindowSpec) -> dict[str, Column]:
        return {"window_values": F.array(*[F.lag(value, i).over(w).cast("double") for i in range(lags - 1, -1, -1)])}

    return framed(df, order, columns, before=lags - 1).filter(F.forall("window_values", lambda v: v.isNotNull()))


def reconstruction_error(df: DataFrame, vector: str, k: int, quantile: float = 0.95) -> DataFrame:
    """Add ``recon_error`` (mean absolute error after projection on ``k`` principal components) and
    ``recon_anomaly`` (above the given quantile of the errors). ``vector`` is an array column."""
    as_double = F.col(vector).cast("array<double>")
    mapped = df.select(array_to_vector(as_double).alias("v"))
    pc = PCA(k=k, inputCol="v", outputCol="p").fit(mapped).pc.toArray()  # d × k, bounded by the vector length
    d = pc.shape[0]
    centre = np.array(df.agg(F.array(*[F.avg(as_double[i]) for i in range(d)])).first()[0])
    shared = df.sparkSession.sparkContext.broadcast((pc, centre))

    @F.pandas_udf("double")
    def error(v: pd.Series) -> pd.Series:
        basis, mean = shared.value
        x = np.stack(v.to_numpy()) - mean
        return pd.Series(np.abs(x - (x @ basis) @ basis.T).mean(axis=1))

    scored = measured(df.withColumn("recon_error", error(as_double)))
    cut = exact_quantiles(scored.select("recon_error"), ["recon_error"], {"cut": quantile}).select("cut").scalar()
    return scored.withColumn("recon_anomaly", F.col("recon_error") > cut)


