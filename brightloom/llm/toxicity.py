"""Toxicity: cumulative-link (proportional odds) regression on sparse text features.

All grades share one weight vector; each threshold between neighbouring grades has its own intercept. Features are
hashed words and word beginnings, counted once per text, so a few abusive words weigh the same in a long text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.llm.common import free_name, hash_share, lbfgs, small_batches
from brightloom.session import measured

_EDGE = b".,;:!?\"'()[]{}<>|*#$%&-_"


@dataclass(frozen=True)
class SeverityModel:
    weights: np.ndarray  # one per hash bucket
    thresholds: np.ndarray  # ascending, one per step between observed grades
    grades: np.ndarray  # the observed grades, ascending


def text_features(text: str, buckets: int) -> np.ndarray:
    """Distinct feature numbers of a whole text: its lower-case words and their first 3, 4 and 5 letters."""
    found = set()
    for w in {w.strip(_EDGE) for w in text.lower().encode("utf-8", "replace").split()}:
        if w:
            s = w.decode("utf-8", "ignore")
            found.add(s)
            found.update("^" + s[:n] for n in (3, 4, 5) if len(s) >= n)
    ids = np.fromiter(map(xxhash.xxh32_intdigest, found), np.int64, len(found)) & (buckets - 1)
    return np.unique(ids)


def _fit(rows: list[np.ndarray], grade: np.ndarray, size: int, ridge: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of maximum likelihood: P(grade <= j) = logistic(threshold_j - weights . x)."""
    k = int(grade.max())
    col = np.concatenate([*rows, np.zeros(0, np.int64)])
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    share = np.array([(grade <= j).mean() for j in range(k)])
    start = np.log(share / (1 - share))
    # thresholds are a first value and positive gaps, so they stay in order
    x0 = np.r_[np.zeros(size), start[0], np.log(np.maximum(np.diff(start), 1e-2))]

    def cuts(x: np.ndarray) -> np.ndarray:
        return x[size] + np.r_[0.0, np.cumsum(np.exp(np.minimum(x[size + 1 :], 50)))]

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        theta = cuts(x)
        margin = np.bincount(row, x[col], len(rows))
        bounds = np.r_[-np.inf, theta, np.inf]
        with np.errstate(over="ignore"):
            hi = 1 / (1 + np.exp(margin - bounds[grade + 1]))
            lo = 1 / (1 + np.exp(margin - bounds[grade]))
        p = np.maximum(hi - lo, 1e-12)
        dhi, dlo = hi * (1 - hi), lo * (1 - lo)
        g_margin = (dhi - dlo) / p
        g_theta = np.zeros(k + 2)
        np.add.at(g_theta, grade + 1, -dhi / p)
        np.add.at(g_theta, grade, dlo / p)
        g_theta = g_theta[1:-1]
        gaps = np.exp(np.minimum(x[size + 1 :], 50))
        later = np.cumsum(g_theta[::-1])[::-1]
        g = np.r_[np.bincount(col, g_margin[row], size), later[0], later[1:] * gaps]
        w = x[:size]
        g /= len(rows)
        g[:size] += 2 * ridge * w
        return float(-np.log(p).mean() + ridge * (w @ w)), g

    x = lbfgs(loss, x0, steps=200, tol=1e-7)
    return x[:size], cuts(x)


def train(docs: DataFrame, graded: DataFrame, grade: str = "grade", sample: int = 20_000, features: int | None = None, min_texts: int = 4, min_gain: float = 3.0, buckets: int = 1 << 18, ridge: float = 1e-6, text: str = "text", key: str = "doc_id") -> SeverityModel | None:
    """Fit on a sample of about ``sample`` graded texts (hash of the key; all where fewer).

    Of the hashed features that occur in at least ``min_texts`` texts, those are used whose count in texts above the
    lowest grade is ``min_gain`` standard deviations or more above the expected one (with ``features``, that many of the strongest);
    harmless words are no evidence against harm, so long or common texts don't hide it. The number of ``buckets`` bounds what the driver fits. Where the labels know only two grades, texts of the upper one
    with more features that hardly ever occur below it than their median form a third grade. None where fewer than two grades or no
    such feature are there.
    """
    keyed = graded.select(F.col(key).alias("k"), F.col(grade).cast("int").alias("g")).filter("k IS NOT NULL AND g IS NOT NULL").groupBy("k").agg(F.max("g").alias("g"))
    total = keyed.count()
    drawn = keyed.filter(hash_share(29, "k") < min(1.0, sample / max(total, 1)))
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).filter("text IS NOT NULL").join(F.broadcast(drawn), "k")

    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in filter(len, frames):
            yield pd.DataFrame({"k": f["k"], "g": f["g"], "x": [text_features(t, buckets) for t in f["text"]]})

    found = measured(small_batches(rows).select("k", "text", "g").mapInPandas(extract, "k long, g int, x array<long>"))
    sizes = {r["g"]: r["n"] for r in found.groupBy("g").agg(F.expr("count(1) AS n")).collect()}
    if len(sizes) < 2:
        return None
    lowest, n = min(sizes), sum(sizes.values())
    n_low = sizes[lowest]
    cell = found.select("g", F.explode("x").alias("x")).groupBy("x").agg(F.expr(f"count_if(g > {lowest})").alias("a"), F.expr("count(1)").alias("df"))
    expected = F.col("df") * ((n - n_low) / n)
    gain = (F.col("a") - expected) / F.sqrt(expected + 1)
    best = cell.withColumn("gain", gain).filter((F.col("df") >= min_texts) & (F.col("gain") >= min_gain))
    best = best if features is None else best.orderBy(F.desc("gain"), "x").limit(features)
    best = best.select("x", (F.col("a") >= 0.9 * F.col("df")).alias("pure")).toPandas().sort_values("x")
    chosen, pure = best["x"].to_numpy(), best["pure"].to_numpy()
    if not len(chosen):
        return None
    keep = found.sparkSession.sparkContext.broadcast(chosen)

    def restrict(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in filter(len, frames):
            yield f.assign(x=[np.searchsorted(keep.value, v[np.isin(v, keep.value)]) for v in map(np.asarray, f["x"])])

    got = found.mapInPandas(restrict, "k long, g int, x array<long>").toPandas().sort_values(["k", "g"], kind="stable")
    grades = np.array(sorted(sizes))
    y = np.searchsorted(grades, got["g"].to_numpy())
    x = [np.asarray(v, np.int64) for v in got["x"]]
    if len(grades) == 2:
        count = np.array([pure[v].sum() for v in x])
        severe = (y == 1) & (count > np.median(count[y == 1]))
        if severe.any():
            y, grades = y + severe, np.r_[grades, grades[1] + 1]
    # features of harm only add to it: those with a negative weight are left out and the rest is fitted again
    use = np.ones(len(chosen), bool)
    while True:
        number = np.cumsum(use) - 1
        w, theta = _fit([number[v[use[v]]] for v in x], y, int(use.sum()), ridge)
        if (w >= 0).all():
            break
        use[np.flatnonzero(use)[w < 0]] = False
    w = np.bincount(np.flatnonzero(use), w, len(chosen))
    weights = np.zeros(buckets)
    weights[chosen] = w
    return SeverityModel(weights, theta, grades)


def severity_of(df: DataFrame, model: SeverityModel | None, text: str = "text") -> Column:
    """Struct column ``(severity, p_harm)``: expected grade and probability of more than the lowest grade.

    Null and empty texts, and every text where there is no model, have 0 and 0.
    """
    parts = None if model is None else (model.weights, model.thresholds, model.grades.astype(float))
    held = small_batches(df).sparkSession.sparkContext.broadcast(parts)

    @F.pandas_udf("struct<severity:double,p_harm:double>")
    def grade(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            if held.value is None:
                yield pd.DataFrame({"severity": np.zeros(len(s)), "p_harm": np.zeros(len(s))})
                continue
            weights, thresholds, grades = held.value
            some = np.array([isinstance(t, str) and bool(t.strip()) for t in s], bool)
            margin = np.array([weights[text_features(t, len(weights))].sum() if ok else 0.0 for t, ok in zip(s, some)])
            above = 1 / (1 + np.exp(np.clip(thresholds[None, :] - margin[:, None], -500, 500)))  # P(grade > j)
            yield pd.DataFrame({"severity": np.where(some, grades[0] + above @ np.diff(grades), 0.0), "p_harm": np.where(some, above[:, 0], 0.0)})

    return grade.asNondeterministic()(F.col(text))


def severity_grades(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Grades of labelled documents: 0 not toxic, 1 toxic (``train`` splits the toxic ones by how much is associated)."""
    return labels.filter("toxic IN (0, 1)").select(key, F.col("toxic").alias("grade"))


def score_severity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **params) -> DataFrame:
    """``(doc_id, severity, p_harm, rejected)`` of every row; ``rejected`` where ``p_harm`` reaches ``threshold``.

    Repeated rows are scored alike; an empty table gives no rows; other columns of ``docs`` are not looked at.
    """
    model = train(docs, severity_grades(labels), **params)
    out = docs.select("doc_id", severity_of(docs, model).alias("s")).select("doc_id", "s.*")
    return out.withColumn("rejected", F.col("p_harm") >= threshold)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, text: str = "text", **params) -> DataFrame:
    """Rows of ``docs`` that are not rejected; columns unchanged."""
    model = train(docs, severity_grades(labels), text=text, **params)
    cols, name = [F.col(f"`{c}`") for c in docs.columns], free_name(docs, "__toxicity")
    return docs.select(*cols, severity_of(docs, model, text).alias(name)).filter(F.col(name)["p_harm"] < threshold).drop(name)
