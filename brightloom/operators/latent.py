"""Latent semantic embeddings: a randomised singular value decomposition of the hashed TF-IDF matrix.

Texts never leave their rows: a pass multiplies the rows of a task with the current basis (``buckets`` x ``dims``) and returns the
product with their transpose, which is summed over groups of tasks and then on the driver. The basis is all that is broadcast,
and its size is fixed by the two arguments. A few such passes from a Gaussian sketch give the leading right singular vectors;
a new text is folded in by one product.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.functions.text import STOP_WORDS, tokens
from brightloom.session import measured, spread


@dataclass(frozen=True)
class LatentModel:
    basis: np.ndarray  # (buckets, dims)
    idf: np.ndarray  # (buckets,)


def _hashes(text: str) -> Column:
    """A number per term of a text, repeats included."""
    return F.coalesce(F.transform(tokens(text, STOP_WORDS, 2), lambda t: F.xxhash64(t)), F.array().cast("array<bigint>"))


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, value)`` of all entries."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), sizes), lists.flatten().to_numpy(zero_copy_only=False)


def _lists(row: np.ndarray, n: int, *values: pa.Array) -> list[pa.Array]:
    """One list per row of entries that are ordered by row."""
    ends = pa.array(np.r_[0, np.cumsum(np.bincount(row, minlength=n))].astype(np.int32))
    return [pa.ListArray.from_arrays(ends, v) for v in values]


def _runs(lists: pa.ListArray, entries: int, rows: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """``(start, length)`` of runs of rows with about ``entries`` entries, at most ``rows`` rows."""
    ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(lists):
        before = ends[at - 1] if at else 0
        to = min(max(at + 1, int(np.searchsorted(ends, before + entries, side="right"))), at + rows, len(lists))
        yield at, to - at
        at = to


def _term_counts(hashes: pa.ListArray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, bucket, tf)`` of the distinct terms of every row."""
    row, h = _flat(hashes)
    h = h[np.lexsort((h, row))]
    starts = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])][: len(h)])
    return row[starts], np.mod(h[starts], buckets), np.diff(np.r_[starts, len(h)]).astype(float)


def _cells(text: str, buckets: int) -> Column:
    """``array<struct<bucket, tf>>`` of the distinct terms of a text."""

    @F.arrow_udf("array<struct<bucket: int, tf: double>>")
    def counted(hashes: pa.Array) -> pa.Array:
        out = []
        for at, n in _runs(hashes, 1_000_000):
            row, bucket, tf = _term_counts(hashes.slice(at, n), buckets)
            out += _lists(row, n, pa.StructArray.from_arrays([pa.array(bucket, pa.int32()), pa.array(tf)], ["bucket", "tf"]))
        return pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.struct([("bucket", pa.int32()), ("tf", pa.float64())])))

    return counted(_hashes(text))


def _unit(row: np.ndarray, col: np.ndarray, tf: np.ndarray, n: int, idf: np.ndarray) -> np.ndarray:
    """TF-IDF values of ``n`` rows of unit length; zeros where a row has no known term."""
    value = tf * idf[col]
    norm = np.sqrt(np.bincount(row, value * value, n))
    return value / np.where(norm > 0, norm, 1)[row]


def _sparse(bucket: pd.Series, tf: pd.Series, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, bucket, value)`` of unit-length TF-IDF rows."""
    row, col = _flat(pa.array(bucket, pa.list_(pa.int32())))
    return row, col, _unit(row, col, _flat(pa.array(tf, pa.list_(pa.float64())))[1], len(bucket), idf)


_FULL = 48  # terms per row from which a product with the full row is faster than one term by term


def _times(row: np.ndarray, col: np.ndarray, value: np.ndarray, n: int, basis: np.ndarray, back: np.ndarray | None = None) -> np.ndarray:
    """Product of ``n`` sparse rows with the basis; the rows' transpose times that is added to ``back``."""
    if len(row) >= _FULL * n:
        full = np.bincount(row * len(basis) + col, value, n * len(basis)).reshape(n, -1)
        out = full @ basis
        if back is not None:
            back += full.T @ out
        return out
    out = np.zeros((n, basis.shape[1]))
    if len(row):
        starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        out[row[starts]] = np.add.reduceat(basis[col] * value[:, None], starts, axis=0)
        if back is not None:
            order = np.argsort(col, kind="stable")
            starts = np.flatnonzero(np.r_[True, np.diff(col[order]) != 0])
            back[col[order][starts]] += np.add.reduceat(out[row[order]] * value[order, None], starts, axis=0)
    return out


def fit_latent(df: DataFrame, text: str, dims: int = 64, buckets: int = 4096, passes: int = 4, extra: int = 10, seed: int = 42) -> LatentModel:
    """Basis of the ``dims`` strongest directions of the TF-IDF rows, from ``passes`` passes over the counted terms.

    ``extra`` directions are carried along for accuracy. Texts are tokenised once and their counts written. Buckets that no text
    has are zero; without any term the basis is zero.
    """
    spark = df.sparkSession
    rows = measured(spread(df.select(F.col(text).alias("t"))).select(_cells("t", buckets).alias("c")).select(F.col("c.bucket").alias("bucket"), F.col("c.tf").alias("tf")).filter(F.size("bucket") > 0))

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, texts = 0, np.zeros(buckets, np.int64)
        for batch in batches:
            n += len(batch)
            for at, length in _runs(batch.column(0), 1_000_000):
                row, col = _flat(batch.column(0).slice(at, length))
                texts += np.bincount(np.unique(row * buckets + col) % buckets, minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([texts.tobytes()], pa.binary())], ["n", "texts"])

    facts = rows.select("bucket").mapInArrow(known, "n long, texts binary").collect()  # `buckets` numbers per task
    n = sum(r["n"] for r in facts)
    seen = sum((np.frombuffer(r["texts"], np.int64) for r in facts), np.zeros(buckets, np.int64))
    idf = np.where(seen > 0, np.log((1 + n) / (1 + seen)) + 1, 0.0)
    width = min(dims + extra, buckets)
    groups = max(1, math.isqrt(rows.select(F.spark_partition_id().alias("p")).distinct().count()))
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(buckets, width)) * (idf > 0)[:, None])[0]

    def back_and_forth(basis: np.ndarray) -> np.ndarray:
        """The rows' transpose times the rows times the basis."""
        shared = spark.sparkContext.broadcast((basis, idf))

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            b, weights = shared.value
            total = np.zeros_like(b)
            for batch in batches:
                for at, length in _runs(batch.column(0), 200_000, 512):
                    (row, col), (_, tf) = (_flat(c.slice(at, length)) for c in batch.columns)
                    _times(row, col, _unit(row, col, tf, length, weights), length, b, total)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

        def merge(f: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"sums": [sum(np.frombuffer(x) for x in f.sort_values("p")["sums"]).tobytes()]})

        parts = rows.mapInArrow(partial, "sums binary").withColumn("p", F.spark_partition_id())
        sums = parts.groupBy((F.col("p") % groups).alias("g")).applyInPandas(merge, "sums binary").collect()
        shared.destroy()
        return sum((np.frombuffer(r["sums"]) for r in sums), np.zeros(basis.size)).reshape(basis.shape)

    for _ in range(passes - 1 if n else 0):
        basis = np.linalg.qr(back_and_forth(basis))[0]
    if n:
        _, turn = np.linalg.eigh(basis.T @ back_and_forth(basis))
        basis = basis @ turn[:, ::-1]
    return LatentModel((basis * (idf > 0)[:, None])[:, :dims], idf)


def embed_latent(df: DataFrame, text: str, model: LatentModel) -> DataFrame:
    """Add ``embedding``, the unit-length position of a text in the model's space, ``array<float>``; zeros without known terms."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    buckets = len(model.idf)

    @F.arrow_udf("array<float>")
    def place(hashes: pa.Array) -> pa.Array:
        own = shared.value
        width = own.basis.shape[1]
        out = [np.zeros((0, width), np.float32)]
        for at, n in _runs(hashes, 200_000, 512):
            row, col, tf = _term_counts(hashes.slice(at, n), buckets)
            x = _times(row, col, _unit(row, col, tf, n, own.idf), n, own.basis)
            norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
            out.append((x / np.where(norm > 0, norm, 1)).astype(np.float32))
        all_rows = np.concatenate(out)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(all_rows) + 1, dtype=np.int32) * width), pa.array(all_rows.ravel()))

    return spread(df).withColumn("embedding", place(_hashes(text)))
