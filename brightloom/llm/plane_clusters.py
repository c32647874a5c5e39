"""k-means over integer vectors whose products are exact: bit planes and population counts.

A vector of 64 integers becomes one 64-bit word per bit: word ``b`` holds bit ``b`` of all components, the last one their signs
(two's complement). The product of two vectors is then a sum of population counts of ANDed words, weighted by powers of two,
and squared distances follow from products alone. Sums of a cluster come from its planes too: how often a bit is set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.session import measured

DIMS = 64
LARGEST = 1 << 27  # of a component's size: squared distances of 64 such components still fit 64 bits
_ROWS = 1 << 14


def weights(n_planes: int) -> np.ndarray:
    """What a set bit of each plane is worth."""
    w = np.left_shift(np.int64(1), np.arange(n_planes, dtype=np.int64))
    w[-1] = -w[-1]
    return w


def to_planes(x: np.ndarray, n_planes: int) -> np.ndarray:
    """``(rows, n_planes)`` words of integer rows of 64 components; component 0 is the lowest bit."""
    bits = ((x[:, None, :] >> np.arange(n_planes)[None, :, None]) & 1).astype(np.uint8)
    return np.packbits(bits, axis=2, bitorder="little").view("<u8")[:, :, 0]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of every row of ``a`` with every row of ``b``, both as planes."""
    out = np.zeros((len(a), len(b)), np.int64)
    for i, wa in enumerate(weights(a.shape[1])):
        for j, wb in enumerate(weights(b.shape[1])):
            out += np.bitwise_count(a[:, i, None] & b[None, :, j]).astype(np.int64) * (wa * wb)
    return out


def squares(a: np.ndarray) -> np.ndarray:
    """Exact squared length of every row."""
    w = weights(a.shape[1])
    out = np.zeros(len(a), np.int64)
    for i in range(len(w)):
        for j in range(len(w)):
            out += np.bitwise_count(a[:, i] & a[:, j]).astype(np.int64) * (w[i] * w[j])
    return out


def nearest(a: np.ndarray, a_squares: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (ties: the smaller number) and squared distance of every row."""
    d = a_squares[:, None] + squares(centroids)[None, :] - 2 * products(a, centroids)
    best = d.argmin(axis=1)
    return best.astype(np.int32), d[np.arange(len(d)), best]


def plane_sums(a: np.ndarray) -> np.ndarray:
    """Componentwise sum of the rows: set bits of each plane, counted down the rows."""
    bits = np.unpackbits(np.ascontiguousarray(a, "<u8").view(np.uint8).reshape(len(a), a.shape[1], 8), axis=2, bitorder="little")
    return weights(a.shape[1]) @ bits.sum(axis=0, dtype=np.int64)


def integer_vectors(df: DataFrame, key: str, vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """``(key, x array<long>)``: ``floor(scale * component)`` of vectors with 64 components, none null, NaN or infinite.

    Other vectors are left out. A component of more than 2^27 after scaling raises an error, as distances would not fit.
    """
    v = F.col(f"`{vector}`").cast("array<double>")

    def unusable(c: Column) -> Column:
        return c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))

    kept = df.select(F.col(f"`{key}`").alias("key"), v.alias("v")).filter((F.size("v") == DIMS) & ~F.exists("v", unusable))
    small = F.when(F.forall("v", lambda c: F.abs(c * scale) <= LARGEST), F.col("v")).otherwise(F.raise_error(F.lit("a component is too large for exact distances")))
    return kept.select("key", F.transform(small, lambda c: F.floor(c * scale)).alias("x"))


def plane_vectors(vectors: DataFrame, n_planes: int) -> DataFrame:
    """``(key, planes array<long>, squares)`` of ``(key, x)``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, _ROWS) for i in range(0, batch.num_rows, _ROWS)):
                planes = to_planes(part.column(1).flatten().to_numpy().reshape(-1, DIMS), n_planes)
                ends = pa.array(np.arange(0, planes.size + 1, n_planes, dtype=np.int32))
                lists = pa.ListArray.from_arrays(ends, pa.array(planes.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array(squares(planes))], ["key", "planes", "squares"])

    return vectors.mapInArrow(pack, f"key {vectors.schema['key'].dataType.simpleString()}, planes array<long>, squares long")


def _arrays(frame: pd.DataFrame) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    for i in range(0, len(frame), _ROWS):
        part = slice(i, i + _ROWS)
        yield part, np.stack(frame["planes"].to_numpy()[part]).view(np.uint64), frame["squares"].to_numpy()[part]


def cluster_sums(packed: DataFrame, centroids: np.ndarray) -> list:
    """One row ``(cluster, n, inertia, sums)`` per cluster that has vectors: what tasks have summed, summed up by Spark."""
    k, n_planes = len(centroids), centroids.shape[1]

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, inertia, sums = np.zeros(k, np.int64), [0] * k, np.zeros((k, DIMS), np.int64)
        for frame in frames:
            for _, a, sq in _arrays(frame):
                best, d = nearest(a, sq, centroids)
                for c in np.unique(best):
                    mine = best == c
                    n[c] += mine.sum()
                    inertia[c] += sum(map(int, d[mine]))
                    sums[c] += plane_sums(a[mine])
        some = np.flatnonzero(n)
        if len(some):
            yield pd.DataFrame({"cluster": some, "n": n[some], "inertia": [str(inertia[c]) for c in some], "sums": list(sums[some])})

    parts = packed.mapInPandas(partial, "cluster int, n long, inertia string, sums array<long>")
    totals = F.array(*[F.sum(F.col("sums")[i].cast("decimal(38,0)")) for i in range(DIMS)]).alias("sums")
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum(F.col("inertia").cast("decimal(38,0)")).alias("inertia"), totals).collect()  # at most k rows


def cluster_vectors(df: DataFrame, key: str, vector: str = "embedding", k: int = 8, rounds: int = 10, scale: int = 1024, seed: int = 3) -> DataFrame:
    """Exact integer k-means: ``(key, cluster, distance, cluster_inertia, inertia, centroid_sha256)``, one row per usable vector.

    Centroids start as the ``k`` vectors whose sha256 of ``<seed>:<key>`` is smallest (null keys last; equal keys by their
    components). Every round assigns all vectors and replaces each centroid that has any by the floor of their mean; after the last
    one vectors are assigned once more. Fewer vectors than ``k`` give as many centroids; an empty table gives no rows; repeated rows all
    count. Vectors that ``integer_vectors`` leaves out have no row. The driver holds ``k`` centroids and their sums only; packed
    vectors are written once, so that every round reads 8 bytes per plane and a lost executor repeats one round's tasks.
    """
    ints = integer_vectors(df, key, vector, scale)
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256)
    starts = ints.orderBy(hashed.asc_nulls_last(), "x").limit(k).select("x").collect()
    spread = ints.select(F.array_max("x").alias("hi"), F.array_min("x").alias("lo")).agg(F.max("hi").alias("hi"), F.min("lo").alias("lo")).first()
    n_planes = 1 + max(int(spread["hi"] or 0).bit_length(), (-(spread["lo"] or 0) - 1).bit_length(), 1)
    packed = measured(plane_vectors(ints, n_planes))
    centroids = [list(r["x"]) for r in starts]

    def planes() -> np.ndarray:
        return to_planes(np.array(centroids, np.int64).reshape(-1, DIMS), n_planes)

    for _ in range(rounds if centroids else 0):
        for r in cluster_sums(packed, planes()):
            centroids[r["cluster"]] = [int(s) // r["n"] for s in r["sums"]]
    final = planes()
    inertia = [0] * max(1, len(centroids))
    for r in cluster_sums(packed, final) if centroids else ():
        inertia[r["cluster"]] = int(r["inertia"])

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part, a, sq in _arrays(frame):
                best, d = nearest(a, sq, final)
                yield pd.DataFrame({"key": frame["key"][part], "cluster": best, "distance": d})

    found = packed.mapInPandas(assign, f"key {packed.schema['key'].dataType.simpleString()}, cluster int, distance long")
    digests = F.array(*[F.sha2(F.lit(",".join(map(str, c))), 256) for c in centroids or [[]]])
    return found.select(
        F.col("key").alias(key if key.lower() not in ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256") else f"{key}_"),
        "cluster", "distance",
        F.get(F.array(*[F.lit(i).cast("long") for i in inertia]), F.col("cluster")).alias("cluster_inertia"),
        F.lit(sum(inertia)).cast("long").alias("inertia"),
        F.get(digests, F.col("cluster")).alias("centroid_sha256"),
    )
