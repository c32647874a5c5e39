"""Reconstruction by a small neural network, trained on all rows at once.

Each step of the training broadcasts the weights, sums loss and gradient inside the tasks, then over groups of tasks, and takes
the next step from a handful of sums. The order of the rows and their partitions do not matter but for rounding.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.functions.optimise import lbfgs
from brightloom.operators.ranking import exact_quantiles
from brightloom.session import measured

# Units of the layers between input and output.
LAYERS = (32, 16, 8, 16, 32)


class Network:
    """Fully connected layers, tanh between them, linear output. Weights are one flat vector."""

    def __init__(self, sizes: Sequence[int]):
        self.shapes = list(zip(sizes[:-1], sizes[1:]))
        self.size = sum((a + 1) * b for a, b in self.shapes)

    def start(self, seed: int) -> np.ndarray:
        rng = np.random.default_rng(seed)
        return np.concatenate([np.concatenate([(rng.normal(size=(a, b)) / math.sqrt(a)).ravel(), np.zeros(b)]) for a, b in self.shapes])

    def layers(self, w: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        out, at = [], 0
        for a, b in self.shapes:
            out.append((w[at : at + a * b].reshape(a, b), w[at + a * b : at + (a + 1) * b]))
            at += (a + 1) * b
        return out

    def forward(self, w: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
        """Input and the outputs of all layers."""
        out = [x]
        layers = self.layers(w)
        for i, (m, b) in enumerate(layers):
            z = out[-1] @ m + b
            out.append(z if i == len(layers) - 1 else np.tanh(z))
        return out

    def loss(self, w: np.ndarray, x: np.ndarray) -> tuple[float, np.ndarray]:
        """Half the squared errors of the reconstruction, summed over the rows, and the gradient."""
        out = self.forward(w, x)
        back = out[-1] - x
        total = 0.5 * float((back * back).sum())
        grads = []
        for i in range(len(self.shapes) - 1, -1, -1):
            m, _ = self.layers(w)[i]
            grads += [back.sum(axis=0), (out[i].T @ back).ravel()]
            if i:
                back = (back @ m.T) * (1 - out[i] * out[i])
        return total, np.concatenate(grads[::-1])


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float)


def fit_autoencoder(vectors: DataFrame, column: str, network: Network, centre: np.ndarray, scale: np.ndarray, n: int, epochs: int, ridge: float, seed: int) -> np.ndarray:
    """Weights after ``epochs`` steps over all rows; every evaluation is one pass that returns one row per group of tasks."""
    spark = vectors.sparkSession
    groups = max(1, math.isqrt(vectors.select(F.spark_partition_id().alias("p")).distinct().count()))

    def evaluate(w: np.ndarray) -> tuple[float, np.ndarray]:
        shared = spark.sparkContext.broadcast(w)

        def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(network.size + 1)
            for f in filter(len, frames):
                loss, grad = network.loss(shared.value, (_stack(f[column]) - centre) / scale)
                total += np.r_[loss, grad]
            yield pd.DataFrame({"sums": [total]})

        def merge(f: pd.DataFrame) -> pd.DataFrame:
            ordered = f.sort_values("p")["sums"]
            return pd.DataFrame({"sums": [np.sum(np.stack(ordered.to_numpy()), axis=0)]})

        parts = vectors.select(column).mapInPandas(partial, "sums array<double>").withColumn("p", F.spark_partition_id())
        rows = parts.groupBy((F.col("p") % groups).alias("g")).applyInPandas(merge, "sums array<double>").collect()
        shared.destroy()
        total = np.sum(np.array(sorted(r["sums"] for r in rows)), axis=0)
        return total[0] / n + ridge * float(w @ w), total[1:] / n + 2 * ridge * w

    return lbfgs(evaluate, network.start(seed), steps=epochs)


def autoencoder_error(
    df: DataFrame, vector: str, layers: Sequence[int] = LAYERS, epochs: int = 50, quantile: float = 0.95, ridge: float = 1e-5, seed: int = 42
) -> DataFrame:
    """Add ``recon_error``, the mean absolute error of the reconstruction of a row in standard units, and ``recon_anomaly``
    (above the given quantile of the errors).

    ``vector`` is an array of equal length in all rows; rows with a null vector or element, or one that is not finite, have a null
    error and take no part in the training. Components are standardised; constant ones count as 0. An empty table stays empty.
    """
    values = F.col(vector).cast("array<double>")
    usable = F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    known = measured(df.filter(usable).select(values.alias("__v")))
    first = known.agg(F.count("*").alias("n"), F.max(F.size("__v")).alias("d")).first()
    if not first["n"]:
        return df.withColumns({"recon_error": F.lit(None).cast("double"), "recon_anomaly": F.lit(None).cast("boolean")})
    d = first["d"]
    stats = known.agg(F.array(*[F.avg(F.col("__v")[i]) for i in range(d)]).alias("m"), F.array(*[F.stddev_pop(F.col("__v")[i]) for i in range(d)]).alias("s")).first()
    centre, scale = np.array(stats["m"]), np.array([s or 1.0 for s in stats["s"]])
    network = Network([d, *layers, d])
    weights = fit_autoencoder(known, "__v", network, centre, scale, first["n"], epochs, ridge, seed)
    shared = df.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def error(v: pd.Series) -> pd.Series:
        out = pd.Series(np.nan, index=v.index)
        some = v.notna()
        if some.any():
            x = (_stack(v[some]) - centre) / scale
            out[some] = np.abs(network.forward(shared.value, x)[-1] - x).mean(axis=1)
        return out

    scored = measured(df.withColumn("recon_error", F.nanvl(error(F.when(usable, values)), F.lit(None))))
    cut = exact_quantiles(scored.select("recon_error"), ["recon_error"], {"cut": quantile}).select("cut").scalar()
    return scored.withColumn("recon_anomaly", F.col("recon_error") > cut)
