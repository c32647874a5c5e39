"""Boosted trees over counted cells of rows, and the search of their settings.

Trees that split between bins cannot tell rows apart that agree in their bins, so a fit works on such cells with their numbers of rows per class.
Cells are few enough for one task to hold them, so many fits run side by side, one per task, and no fit needs a pass per tree level.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from math import comb, erf, sqrt

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MOST_VALUES = 1 << 22  # bins and counts that a task and the driver hold
_LAMBDA = 1.0  # added to the weight of a leaf


@dataclass(frozen=True)
class Cells:
    """Cells of rows with equal bins and their rows per fold and class (0, 1)."""

    x: np.ndarray  # cells x features
    rows: np.ndarray  # cells x folds x 2


@dataclass(frozen=True)
class Boosted:
    """Trees as arrays by node, the root first; ``child`` is the first of two neighbouring children, 0 in leaves."""

    start: float
    trees: list[tuple[np.ndarray, ...]]  # (feature, upto, child, value)
    importances: np.ndarray  # mean gain per split, as shares

    @property
    def featureImportances(self) -> DenseVector:  # as of Spark's own models
        return DenseVector(self.importances)

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log odds of class 1 for rows of bins."""
        cells, back = np.unique(x, axis=0, return_inverse=True)
        out, at = np.full(len(cells), self.start), np.arange(len(cells))
        for feature, upto, child, value in self.trees:
            node = np.zeros(len(cells), np.int64)
            while True:
                inner = child[node] > 0
                if not inner.any():
                    break
                node = np.where(inner, child[node] + (cells[at, feature[node]] > upto[node]), node)
            out += value[node]
        return out[back.reshape(-1)]

    def transform(self, df: DataFrame, names: Sequence[str]) -> DataFrame:
        """Add ``rawPrediction``, ``probability`` and ``prediction`` for rows with their bins in ``names``."""
        shared = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def margin(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            model = shared.value
            for bins in batches:
                yield pd.Series(model.margins(np.stack([b.to_numpy(np.int64) for b in bins], axis=1)))

        out = df.withColumn("__m", margin(*names))
        one = 1 / (1 + F.exp(-F.col("__m")))
        return out.withColumns(
            {
                "rawPrediction": array_to_vector(F.array(-F.col("__m"), F.col("__m"))), "probability": array_to_vector(F.array(1 - one, one)),
                "prediction": (F.col("__m") > 0).cast("double"),
            }
        ).drop("__m")


def _sampler(rows: np.ndarray, share: float, most: int = 32) -> Callable[[np.random.Generator], np.ndarray]:
    """Draws how many rows of every cell are among a share of all: binomial, from one uniform number where a cell has at most ``most`` rows."""
    order = np.argsort(-rows, kind="stable")
    n = rows[order].astype(int)
    large, some = int((n > most).sum()), int((n > 0).sum())
    steps = []  # per number k of rows: the chance of at most k of the cell's n
    for k in range(most if share < 1 else 0):
        upto = int((n > k).sum())
        if upto <= large:
            break
        chance = np.array([sum(comb(m, i) * share**i * (1 - share) ** (m - i) for i in range(k + 1)) for m in range(most + 1)])
        steps.append((upto, chance[n[large:upto]]))

    def draw(rng: np.random.Generator) -> np.ndarray:
        if share >= 1:
            return rows.astype(float)
        taken = np.zeros(len(n))
        taken[:large] = rng.binomial(n[:large], share)
        u = rng.random(some - large)
        for upto, chance in steps:
            taken[large:upto] += u[: upto - large] > chance
        out = np.empty(len(n))
        out[order] = taken
        return out

    return draw


def fit(x: np.ndarray, neg: np.ndarray, pos: np.ndarray, setting: Mapping, seed: int, keep: bool = True) -> tuple[Boosted | None, np.ndarray]:
    """``(model, log odds per cell)`` of trees fitted to the cells' rows by class, by Newton steps of the logistic loss.

    Settings have the names of Spark's trees. Every tree draws its share of rows and of features; the least weight of a leaf is the
    sum of ``p (1 - p)`` over its rows. Cells without rows are only predicted; ``keep`` is whether a model is wanted.
    """
    rng = np.random.default_rng(seed)
    cells, features = x.shape
    bins = int(x.max(initial=0)) + 1
    columns, flat = [np.ascontiguousarray(x[:, j], np.int64) for j in range(features)], np.ascontiguousarray(x, np.int16).ravel()
    tried, rate, least = max(1, int(float(setting["featureSubsetStrategy"]) * features)), setting["stepSize"], setting["minInstancesPerNode"]
    start = float(np.log((pos.sum() + 0.5) / (neg.sum() + 0.5)))
    score, trees, gained = np.full(cells, start), [], np.zeros((2, features))
    draws = [_sampler(c, setting["subsamplingRate"]) for c in (neg, pos)]
    for _ in range(setting["maxIter"]):
        drawn = [draw(rng) for draw in draws]
        chosen = np.sort(rng.permutation(features)[:tried])
        p = 1 / (1 + np.exp(-score))
        n = drawn[0] + drawn[1]
        g, h = n * p - drawn[1], n * p * (1 - p)
        rows, node, per_row = np.arange(cells), np.zeros(cells, np.int64), columns
        nodes = [(np.full(1, -1), np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1))] if keep else []
        total, weight = np.array([g.sum()]), np.array([h.sum()])
        for level in range(setting["maxDepth"] + 1):
            value = -rate * total / (weight + _LAMBDA)
            if level == setting["maxDepth"] or not len(rows):
                ok = np.zeros(len(total), bool)
            else:
                base, size = node * bins, len(total) * bins
                sums = np.empty((2, len(chosen), len(total), bins))
                for j, c in enumerate(chosen):
                    key = base + per_row[c]
                    sums[0, j], sums[1, j] = (np.bincount(key, w, size).reshape(-1, bins) for w in (g, h))
                left = sums[..., :-1].cumsum(axis=-1)
                gl, hl = left
                gr, hr = total[:, None] - gl, weight[:, None] - hl
                gain = gl * gl / (hl + _LAMBDA) + gr * gr / (hr + _LAMBDA)
                gain[(hl < least) | (hr < least)] = -np.inf
                gain = gain.transpose(1, 0, 2).reshape(len(total), -1)
                at = gain.argmax(axis=1) if gain.shape[1] else np.zeros(len(total), np.int64)
                best = (gain[np.arange(len(total)), at] if gain.shape[1] else np.full(len(total), -np.inf)) - total**2 / (weight + _LAMBDA)
                ok = best > 1e-6
            leaf = ~ok[node]
            if leaf.any():
                score[rows[leaf]] += value[node[leaf]]
            if keep:
                nodes[-1][3][~ok] = value[~ok]
            if not ok.any():
                break
            place, upto = np.divmod(at, bins - 1)
            feature = chosen[place]
            gained += np.bincount(feature[ok], best[ok], features), np.bincount(feature[ok], minlength=features)
            child = np.where(ok, 2 * np.cumsum(ok) - 2, 0)
            pick = np.flatnonzero(ok)
            gl, hl = (s[place[pick], pick, upto[pick]] for s in left)
            total, weight = (np.stack([a, b[pick] - a], axis=1).ravel() for a, b in ((gl, total), (hl, weight)))
            if keep:
                nodes[-1][0][ok], nodes[-1][1][ok], nodes[-1][2][ok] = feature[ok], upto[ok], child[ok] + 1
                nodes.append((np.full(len(total), -1), np.zeros(len(total), np.int64), np.zeros(len(total), np.int64), np.zeros(len(total))))
            if leaf.any():
                stay = np.flatnonzero(~leaf)
                rows, node, g, h = rows[stay], node[stay], g[stay], h[stay]
                per_row = {c: per_row[c][stay] for c in chosen}
            node = child[node] + (flat[rows * features + feature[node]] > upto[node])
        if keep:
            first = np.cumsum([0, *[len(v) for *_, v in nodes]])
            feature, upto, child, value = (np.concatenate(c) for c in zip(*nodes))
            ahead = np.repeat(first[1:], np.diff(first))
            trees.append((feature.astype(np.int16), upto.astype(np.int16), np.where(child > 0, child - 1 + ahead, 0).astype(np.int32), value))
    per_split = gained[0] / np.maximum(gained[1], 1)
    return (Boosted(start, trees, per_split / max(per_split.sum(), 1e-300)) if keep else None), score


def auc(score: np.ndarray, neg: np.ndarray, pos: np.ndarray) -> float:
    """Area under the ROC curve of cells with rows by class; equal scores count half. Not a number where a class is missing."""
    values, at = np.unique(score, return_inverse=True)
    n, p = (np.bincount(at, c, len(values)) for c in (neg, pos))
    pairs = n.sum() * p.sum()
    return float((p * (n.cumsum() - n / 2)).sum() / pairs) if pairs else float("nan")


#: (low, high, whole numbers only) of the settings
SPACE = {
    "maxIter": (100, 1000, True), "maxDepth": (3, 10, True), "stepSize": (0.01, 0.1, False), "minInstancesPerNode": (1, 7, True),
    "subsamplingRate": (0.6, 1.0, False), "featureSubsetStrategy": (0.6, 1.0, False),
}
_RANDOM_FIRST, _CANDIDATES = 10, 24


def _normal_cdf(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.vectorize(erf, otypes=[float])(z / sqrt(2)))


@dataclass(frozen=True)
class _Parzen:
    """Mixture of a normal per value seen and one over the whole range, cut to the range; a whole number has the mass around it."""

    low: float
    high: float
    whole: bool
    mu: np.ndarray
    sigma: np.ndarray
    weight: np.ndarray

    @classmethod
    def of(cls, seen: Sequence[float], low: float, high: float, whole: bool) -> _Parzen:
        """Widths are the larger distance to a neighbour; of more than 25 values the oldest weigh less."""
        if whole:
            low, high = low - 0.5, high + 0.5
        n, span = len(seen), high - low
        mu = np.array([*seen, (low + high) / 2], float)
        order = np.argsort(mu, kind="stable")
        ends = np.array([low, *mu[order], high])
        wide = np.maximum(ends[1:-1] - ends[:-2], ends[2:] - ends[1:-1])
        if n:  # the ends of the range are no neighbours
            wide[0], wide[-1] = ends[2] - ends[1], ends[-2] - ends[-3]
        sigma = np.empty(n + 1)
        sigma[order] = np.clip(wide, span / min(100, 2 + n), span)
        sigma[-1] = span
        weight = np.ones(n + 1)
        if n > 25:
            weight[: n - 25] = np.linspace(1 / n, 1, n - 25)
        return cls(low, high, whole, mu, sigma, weight / weight.sum())

    def draw(self, rng: np.random.Generator, n: int) -> np.ndarray:
        out = np.empty(n)
        for i, k in enumerate(rng.choice(len(self.mu), n, p=self.weight)):
            v = np.inf
            while not self.low <= v <= self.high:
                v = rng.normal(self.mu[k], self.sigma[k])
            out[i] = v
        return np.clip(np.rint(out), self.low + 0.5, self.high - 0.5) if self.whole else out

    def log_density(self, v: np.ndarray) -> np.ndarray:
        z = lambda at: (np.asarray(at)[..., None] - self.mu) / self.sigma
        inside = _normal_cdf(z(self.high)) - _normal_cdf(z(self.low))
        if self.whole:
            per = _normal_cdf(z(v + 0.5)) - _normal_cdf(z(v - 0.5))
        else:
            per = np.exp(-0.5 * z(v) ** 2) / (self.sigma * sqrt(2 * np.pi))
        return np.log(np.maximum((self.weight * per / inside).sum(axis=1), 1e-300))


def propose(trials: Sequence[tuple[Mapping, float]], space: Mapping[str, tuple[float, float, bool]], rng: np.random.Generator) -> dict:
    """The next setting after ``trials`` of settings and scores (higher is better), by tree-structured Parzen estimators.

    The best tenth of the trials and the others get a density each, setting by setting; of 24 draws from the first density the one
    with the largest ratio of the two is tried. The first ten settings are random.
    """
    good = set(sorted(range(len(trials)), key=lambda i: -trials[i][1])[: min(25, -(-len(trials) // 10))])
    out = {}
    for name, (low, high, whole) in space.items():
        if len(trials) < _RANDOM_FIRST:
            v = rng.integers(low, high + 1) if whole else rng.uniform(low, high)
        else:
            best, rest = (_Parzen.of([s[name] for i, (s, _) in enumerate(trials) if (i in good) == g], low, high, whole) for g in (True, False))
            drawn = best.draw(rng, _CANDIDATES)
            v = drawn[np.argmax(best.log_density(drawn) - rest.log_density(drawn))]
        out[name] = int(v) if whole else float(v)
    return out


def search(scores: Callable[[Sequence[Mapping]], Sequence[float]], space: Mapping[str, tuple[float, float, bool]], budget: int, seed: int) -> list[tuple[dict, float]]:
    """``budget`` settings with their ``scores``: the first ten, which are random, at once, then one after the other, each from all before it."""
    rng = np.random.default_rng(seed)
    first = [propose([], space, rng) for _ in range(min(budget, _RANDOM_FIRST))]
    trials = list(zip(first, scores(first)))
    while len(trials) < budget:
        setting = propose(trials, space, rng)
        trials.append((setting, scores([setting])[0]))
    return trials


def cross_validated(spark: SparkSession, cells: Cells, seed: int) -> Callable[[Sequence[Mapping]], list[float]]:
    """A function of settings to their mean areas under the ROC curve over the folds, one fit per task; folds without one of the classes have none."""
    shared, folds = spark.sparkContext.broadcast(cells), cells.rows.shape[1]

    def scores(settings: Sequence[Mapping]) -> list[float]:
        settings = list(settings)

        def fitted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            rows = shared.value.rows
            for f in frames:
                for i in f["id"]:
                    held = rows[:, i % folds]
                    neg, pos = (rows.sum(axis=1) - held).T
                    _, score = fit(shared.value.x, neg, pos, settings[i // folds], seed, keep=False)
                    yield pd.DataFrame({"id": [i], "auc": [auc(score, *held.T)]})

        n = len(settings) * folds
        found = {r["id"]: r["auc"] for r in spark.range(0, n, 1, n).mapInPandas(fitted, "id long, auc double").collect()}
        means = [[a for fold in range(folds) if not np.isnan(a := found[s * folds + fold])] for s in range(len(settings))]
        return [float(np.mean(m)) if m else 0.5 for m in means]

    return scores


def fitted_to_all(spark: SparkSession, cells: Cells, setting: Mapping, seed: int) -> Boosted:
    """The model of all rows, fitted in a task."""
    shared = spark.sparkContext.broadcast(cells)

    def whole(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _ in frames:
            model, _ = fit(shared.value.x, *shared.value.rows.sum(axis=1).T, setting, seed)
            yield pd.DataFrame({"model": [pickle.dumps(model)]})

    return pickle.loads(spark.range(0, 1, 1, 1).mapInPandas(whole, "model binary").first()[0])
