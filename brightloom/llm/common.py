"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.functions.text import let  # noqa: F401

# A word is a run of characters other than the blank and \t \n \v \f \r: what bytes.split() yields for UTF-8.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SPACE_BYTES = b" \t\n\x0b\x0c\r"


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def ascii_lower(c: Column | str) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(c: Column | str) -> Column:
    """Words of a text in order; null or empty text has none."""
    parts = F.split(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")), SPACE)
    return F.filter(parts, lambda w: w != "")


def word_count(c: Column | str) -> Column:
    """Number of words (null: 0)."""
    return F.coalesce(F.regexp_count(F.col(c) if isinstance(c, str) else c, F.lit(WORD)), F.lit(0)).cast("long")


def hash_share(seed: int, *keys: Column | str) -> Column:
    """A number in [0, 1) that depends on the keys alone: rows with a share below r are a reproducible sample of rate r."""
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1 << 30)) / F.lit(float(1 << 30))


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """``df``, for sending whole texts to Python: the session's Arrow batches get ``rows`` rows where they have the default of
    10,000, since some texts are very long and a batch is held several times over."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH) == "10000":
        conf.set(_BATCH, str(rows))
    return df


KEY_BITS = 23  # the filter below has 2 ** KEY_BITS bits (1 MB), whatever the number of keys


def may_be_in(key: Column, keys: DataFrame) -> Column:
    """Is the hash of ``key`` among those of the one-column table ``keys``? False for most other keys, never for one of ``keys``.

    A scalar subquery yields the bits as an array of fixed size, so a table can be cut down to about the wanted rows
    before an exact join shuffles it. The more keys there are, the less is cut; results never depend on it.
    """

    def spot(c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(1 << KEY_BITS))

    words = 1 << (KEY_BITS - 6)
    set_bits = keys.select(spot(F.col(f"`{keys.columns[0]}`")).alias("h")).select(F.shiftright("h", 6).alias("w"), (F.col("h") % 64).cast("int").alias("b"))
    set_bits = set_bits.groupBy("w").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("b"))).alias("bits"))
    every = keys.sparkSession.range(words).join(set_bits, F.col("id") == F.col("w"), "left").select("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    table = every.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "bits"))), lambda x: x["bits"])).scalar()
    h = spot(key)
    word = F.get(table, F.shiftright(h, 6).cast("int"))
    return F.call_function("shiftright", word, (h % 64).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1


def _renamed(df: DataFrame, key: str, keys: DataFrame) -> tuple[Column, DataFrame, Column]:
    """The key column, ``keys`` under a name that ``df`` does not have, and the condition that both are equal or null."""
    name = free_name(df, "__wanted")
    k = F.col(f"`{key}`")
    return k, keys.toDF(name), k.eqNullSafe(F.col(name))


def rows_in(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``key`` (null included) is in the one-column table ``keys``; others are mostly not shuffled."""
    k, wanted, same = _renamed(df, key, keys)
    return df.filter(may_be_in(k, keys)).join(wanted, same, "left_semi")


def rows_not_in(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``key`` (null included) is not in ``keys``: most are told without a shuffle, the rest joined."""
    k, wanted, same = _renamed(df, key, keys)
    unsure = df.filter(may_be_in(k, keys)).join(wanted, same, "left_anti")
    return df.filter(~may_be_in(k, keys)).unionByName(unsure)


def slices(texts: Iterable[str | None], limit: int) -> Iterable[tuple[int, list[str]]]:
    """Cut a batch into runs ``(first row, texts)`` of about ``limit`` characters, so that working arrays stay small."""
    run: list[str] = []
    first = size = 0
    for i, t in enumerate(texts):
        if run and size + len(t or "") > limit:
            yield first, run
            first, run, size = i, [], 0
        run.append(t or "")
        size += len(t or "")
    if run:
        yield first, run


def lbfgs(f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int = 60, memory: int = 8, tol: float = 1e-5) -> np.ndarray:
    """Minimise a smooth convex function by limited-memory BFGS with a backtracking line search."""
    value, grad = f(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        if np.abs(grad).max(initial=0.0) <= tol:
            break
        d = grad.copy()
        alphas = []
        for s, y in reversed(past):
            a = s @ d / (s @ y)
            alphas.append(a)
            d -= a * y
        if past:
            s, y = past[-1]
            d *= s @ y / (y @ y)
        for (s, y), a in zip(past, reversed(alphas)):
            d += s * (a - y @ d / (s @ y))
        slope = -(grad @ d)
        if slope >= 0:
            d, slope, past = grad.copy(), -(grad @ grad), []
        step = 1.0 if past else min(1.0, 1.0 / np.abs(grad).sum())
        for _ in range(40):
            new = x - step * d
            new_value, new_grad = f(new)
            if new_value <= value + 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        s, y = new - x, new_grad - grad
        if s @ y > 1e-12:
            past = [*past, (s, y)][-memory:]
        x, value, grad = new, new_value, new_grad
    return x
