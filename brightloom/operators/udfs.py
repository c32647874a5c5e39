"""User functions over columns, groups and rows, in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scalar_function_apply(df: DataFrame, c: str, fn: Callable[[pd.Series], pd.Series], returns: str, name: str) -> DataFrame:
    """Add ``name`` = ``fn`` over whole column batches. Prefer built-in functions where they exist."""
    return df.withColumn(name, F.pandas_udf(fn, returns)(F.col(c)))


def group_function_apply(
    df: DataFrame, keys: Sequence[str], partial: Callable[[pd.DataFrame], dict], merge: Callable[[pd.DataFrame], dict],
    final: Callable[[dict], dict], state_schema: str, schema: str, held_groups: int = 100_000,
) -> DataFrame:
    """One row per group from a mergeable user function.

    ``partial`` reduces the rows of a group in one batch to a state, ``merge`` several states to one, ``final``
    the state to the result. Each task merges the states of up to ``held_groups`` groups before it passes them on, so a
    group that holds most of the rows reaches the merging task as a few small rows per task, never as its rows.
    """
    keys = list(keys)
    key_schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)

    def reduce_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:
            rows = [dict(zip(keys, k), **partial(g)) for k, g in pdf.groupby(keys, dropna=False)]
            new = pd.DataFrame(rows)
            both = new if held is None else pd.concat([held, new])
            held = pd.DataFrame([dict(zip(keys, k), **merge(g)) for k, g in both.groupby(keys, dropna=False)])
            if len(held) > held_groups:
                yield held
                held = None
        if held is not None and len(held):
            yield held

    def finish(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([dict(zip(keys, key), **final(merge(pdf)))])

    states = df.mapInPandas(reduce_task, f"{key_schema}, {state_schema}")
    return states.groupBy(*keys).applyInPandas(finish, f"{key_schema}, {schema}")


def table_function_apply(df: DataFrame, fn: Callable[..., Iterable[tuple]], columns: Sequence[str], schema: str) -> DataFrame:
    """Zero or more rows per input row: ``fn(*values)`` yields tuples of ``schema``. No shuffle."""
    cols = list(columns)
    names = [p.strip().split()[0] for p in schema.split(",")]

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = (r for values in pdf[cols].itertuples(index=False, name=None) for r in fn(*values))
            while part := list(islice(rows, 10_000)):  # a row may yield any number
                yield pd.DataFrame(part, columns=names)

    return df.select(*cols).mapInPandas(expand, schema)
