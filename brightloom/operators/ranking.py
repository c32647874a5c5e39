"""Order-dependent building blocks that never sort a whole column or a whole hot group in one task.

A sort is split into value ranges by a monotone bucket of the order key. Range totals are small; their
running sums give every range its offset, and only rows of one range are sorted together.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from brightloom.session import measured, small_in_parallel, written


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join that treats null keys as equal and keeps the left key columns."""
    other = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    cond = F.expr(" AND ".join(f"`{k}` <=> `__r_{k}`" for k in keys))
    return left.join(other, cond, how).drop(*[f"__r_{k}" for k in keys])


def with_stats(df: DataFrame, stats: DataFrame, name: str = "__s") -> DataFrame:
    """Add the single value of the one-row, one-column ``stats`` as a column.

    It is a scalar subquery referenced once: no join, and expressions that need several of its fields read
    them from the column instead of repeating the subquery.
    """
    return df.withColumn(name, stats.scalar())


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    bucket: Column,
    measures: Mapping[str, Column],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Add ``<name>`` = sum of the measure over all rows of the key group strictly before this row.

    ``order`` must be unique within a key group and ``bucket`` must not decrease along it. Every (key, bucket)
    range gets one extra row that carries the total of the ranges before it and sorts first, so one window
    per range yields the full running total: one shuffle of the rows, no join, and null keys are a group.
    """
    names = list(measures)
    d = df.withColumns({f"__m_{n}": measures[n] for n in names}).withColumns({"__b": bucket, "__row": F.lit(1)})
    totals = d.groupBy(*keys, "__b").agg(*[F.sum(f"__m_{n}").alias(f"__m_{n}") for n in names])
    ahead = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *keys, "__b", F.lit(0).alias("__row"), *[F.coalesce(F.sum(f"__m_{n}").over(ahead), F.lit(0)).alias(f"__m_{n}") for n in names]
    )
    both = d.unionByName(carried, allowMissingColumns=True)
    within = Window.partitionBy(*keys, "__b").orderBy(F.asc("__row"), *order).rowsBetween(Window.unboundedPreceding, -1)
    out = both.withColumns({n: F.sum(f"__m_{n}").over(within) for n in names}).filter(F.col("__row") == 1)
    return out.drop("__b", "__row", *[f"__m_{n}" for n in names])


ROWS_PER_RANGE = 200_000
MOST_RANGES = 10_000


def range_count(rows: int) -> int:
    return max(16, rows // ROWS_PER_RANGE)


def value_ranges(df: DataFrame, c: str, descending: bool = False, tie: str | None = None, name: str = "__range", ranges: int | None = None) -> DataFrame:
    """Add ``name``, a range of column ``c`` (numbers, dates, times) that never decreases along its order.

    Split points are quantiles of the data, so ranges hold about equally many rows whatever the values look like, and
    their number grows with the rows. A value that is a split point has a range of its own; there the order
    continues by ``tie`` (ascending), so rows of one frequent value are split as well. Nulls come first (last if descending).
    More than ``MOST_RANGES`` ranges are found in two steps, the second one inside each range of the first.
    """
    n = ranges or range_count(df.count())
    wide, deep = min(n, MOST_RANGES), -(-n // MOST_RANGES)

    def points(x: str, parts: int) -> Column:
        return F.percentile_approx(x, [i / parts for i in range(1, parts)], 10 * parts)

    def place(x: Column, at: Column, parts: int) -> Column:
        """Twice the number of points below ``x`` (binary search), plus one if ``x`` is a point."""
        steps = F.array(*[F.lit(1 << b) for b in range((parts - 1).bit_length() - 1, -1, -1)])
        below = F.aggregate(steps, F.lit(0), lambda pos, s: pos + F.when((pos + s < parts) & (F.get(at, pos + s - 1) < x), s).otherwise(0))
        return below * 2 + F.coalesce((F.get(at, below) == x).cast("int"), F.lit(0))

    if deep == 1 and tie is None and df.schema[c].dataType.typeName() == "double":  # placed in whole arrays, with the points found once
        found = np.array(df.agg(points(c, wide)).first()[0] or [], float)

        @F.arrow_udf("int")
        def ranged(x: pa.Array) -> pa.Array:
            v = x.to_numpy(zero_copy_only=False)
            below = np.searchsorted(found, v)
            return pa.array(np.where(x.is_null(), 0, below * 2 + (np.r_[found, np.nan][below] == v)), pa.int32())

        return df.withColumn(name, -ranged(c) if descending else ranged(c))

    stats = df.agg(F.struct(points(c, wide).alias("first"), (points(tie, wide) if tie else F.lit(None)).alias("second")))
    out = with_stats(df, stats, "__points")
    out = out.withColumn("__first", F.coalesce(place(F.col(c), F.col("__points.first"), wide), F.lit(-1))).withColumn("__deep", F.lit(0))
    if deep > 1:  # each range has points of its own
        own = measured(out.filter(F.col(c).isNotNull()).groupBy(F.col("__first").alias("__of")).agg(points(c, deep).alias("__own")))
        out = out.join(own, F.col("__first") == F.col("__of"), "left").withColumn("__deep", F.coalesce(place(F.col(c), F.col("__own"), deep), F.lit(-1))).drop("__of", "__own")
    parts = {"a": F.col("__first"), "d": F.col("__deep")} if deep > 1 else {"a": F.col("__first")}
    if descending:
        parts = {k: -v for k, v in parts.items()}
    if tie is not None:
        point = (F.col("__first") % 2 != 0) | (F.col("__deep") % 2 != 0)
        second = F.when(point & F.col(tie).isNotNull(), place(F.col(tie), F.col("__points.second"), wide)).otherwise(F.when(point, F.lit(-1)).otherwise(F.lit(0)))
        parts["b"] = second
    value = parts["a"] if len(parts) == 1 else F.struct(*[v.alias(k) for k, v in parts.items()])
    return out.withColumn(name, value).drop("__points", "__first", "__deep")


def text_bucket(df: DataFrame, c: str, splits: int | None = None) -> Column:
    """Bucket of text column ``c`` that never decreases with it, balanced whatever the prefixes look like.

    Split points are ``splits`` of the distinct values, drawn by hash (a top-n); by default their number grows with
    the rows. Fewer values need one bucket.
    """
    splits = splits or min(MOST_RANGES, range_count(df.count()))
    drawn = df.select(c).filter(F.col(c).isNotNull()).distinct().orderBy(F.xxhash64(c), c).limit(splits).collect()
    if len(drawn) < splits:
        return F.lit(0)
    points = np.array(sorted(r[0] for r in drawn), dtype=object)

    @F.pandas_udf("int")
    def place(v: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(points, v.to_numpy(dtype=object), side="right"))

    return place(F.col(c))


def split_row_number(
    df: DataFrame, order: Sequence[Column], bucket: Column, keys: Sequence[str] = (), name: str = "rn", split_above: int = ROWS_PER_RANGE
) -> DataFrame:
    """Exact ``row_number`` (from 1) within ``keys``; the keyless case and groups of more than ``split_above`` rows are split by ``bucket``."""
    if keys:
        large = measured(df.groupBy(*keys).agg(F.expr("count(1)").alias("__n")).filter(F.col("__n") > split_above).drop("__n").withColumn("__large", F.lit(True)))
        df = join_null_safe(df, large, keys, "left")
        out = running_totals(df, order, F.when(F.col("__large"), bucket), {name: F.lit(1).cast("long")}, keys).drop("__large")
    else:
        out = running_totals(df, order, bucket, {name: F.lit(1).cast("long")})
    return out.withColumn(name, F.col(name) + 1)


def order_ranges(df: DataFrame, c: str, tie: str | None = None, name: str = "__range") -> DataFrame:
    """Add ``name``, a range of ``c`` of any ordered type that never decreases along it; a tie-breaker that is no text splits equal values."""
    if df.schema[c].dataType.typeName() == "string":
        return df.withColumn(name, F.coalesce(text_bucket(df, c), F.lit(-1)))
    return value_ranges(df, c, tie=tie if tie and df.schema[tie].dataType.typeName() != "string" else None, name=name)


def framed(
    df: DataFrame, order: str, columns: Callable[[WindowSpec], Mapping[str, Column]], before: int = 0, after: int = 0, by: Sequence[str] = (),
    position: str | None = None, block: int = ROWS_PER_RANGE, tie: str | None = None,
) -> DataFrame:
    """Add ``columns(w)``, window columns that look at most ``before`` rows back and ``after`` rows ahead along ``order``.

    A series of any length is dealt to tasks in blocks of ``block`` consecutive rows (at least as many as the frame reaches), and
    each block gets a copy of the rows next to it that frames of its own rows reach; copies are dropped afterwards. Blocks follow
    exact row numbers, so one neighbour on either side is always enough. Tables of no more than a block need no
    cutting. ``order``, or ``order`` and ``tie``, must be unique within a group of ``by``, null groups included; ``position`` adds the
    row's number from 0.
    The table is written once, because its size and its rows are both needed.
    """
    df = written(df)
    block = max(block, before, after, 1)
    along = [order, tie] if tie else [order]
    if df.count() <= block:
        w = Window.partitionBy(*by).orderBy(*along)
        out = df.withColumns(dict(columns(w)))
        return out.withColumn(position, F.row_number().over(w) - 1) if position else out
    numbered = split_row_number(order_ranges(df, order, tie), [F.asc(c) for c in along], F.col("__range"), by, "__at", split_above=block).drop("__range")
    at = F.col("__at") - 1
    own, inside = F.floor(at / block), at % block
    goes = F.array(own, F.when(inside >= block - before, own + 1), F.when((inside < after) & (own > 0), own - 1))
    dealt = numbered.withColumns({"__own": own, "__block": F.explode(F.array_compact(goes))})
    w = Window.partitionBy(*by, "__block").orderBy("__at")
    out = dealt.withColumns(dict(columns(w))).filter(F.col("__block") == F.col("__own"))
    if position:
        out = out.withColumn(position, at)
    return out.drop("__at", "__own", "__block")


def dense_ranks(df: DataFrame, c: str, name: str) -> DataFrame:
    """``(c, name)``: the distinct non-null values of ``c``, numbered from 0 in order, in independent ranges."""
    levels = df.select(c).filter(F.col(c).isNotNull()).distinct()
    if df.schema[c].dataType.typeName() == "string":
        numbered = split_row_number(levels, [F.asc(c)], text_bucket(levels, c), (), name)
    else:
        numbered = split_row_number(value_ranges(levels, c), [F.asc(c)], F.col("__range"), (), name).drop("__range")
    return numbered.withColumn(name, F.col(name) - 1)


_ACCURACY = 10_000
_MARGIN = 4 / _ACCURACY  # twice what two merged summaries of 1 / _ACCURACY can be off


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Mapping[str, float], by: Sequence[str] = (), margin: float = _MARGIN
) -> DataFrame:
    """Exact linearly interpolated quantiles: ``(*by, column, n, <one column per name in probs>)``.

    Pass 1 brackets every wanted rank by approximate quantiles; pass 2 counts what lies below a bracket and finds the nearest value on
    either side; pass 3 orders only the distinct values inside (about ``2 * margin`` of the rows). The brackets follow the
    data, so no value distribution makes one of them large. A rank that turns out to lie outside of its bracket and its neighbours
    gets a wider one, until all ranks are inside. NaN counts as missing; columns (of a group) without values have no row.
    """
    names, p = list(probs), [float(v) for v in probs.values()]
    rows = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    rows = small_in_parallel(rows.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in columns}))
    if not by:
        return _global_quantiles(rows, list(columns), names, p, margin)
    while True:
        found = measured(_grouped_quantiles(rows, columns, names, p, by, margin))
        if margin >= 1 or not found.filter("__outside").head(1):
            return found.drop("__outside")
        margin = max(8 * margin, 1e-3)


def _brackets(p: Sequence[float], margin: float) -> list[float]:
    return [x for v in p for x in (max(0.0, v - margin), min(1.0, v + margin))]


def _global_quantiles(rows: DataFrame, columns: list[str], names: list[str], p: list[float], margin: float) -> DataFrame:
    """Counts are plain aggregates over the rows as they are; only values inside a bracket become rows of their own."""
    spark = rows.sparkSession
    schema = ", ".join(["column string", "n long", *[f"`{n}` double" for n in names]])
    sizes = rows.agg(*[F.count(c).alias(f"n{j}") for j, c in enumerate(columns)], *[F.percentile_approx(c, _brackets(p, margin), _ACCURACY).alias(f"q{j}") for j, c in enumerate(columns)]).first()
    count = {c: sizes[f"n{j}"] for j, c in enumerate(columns)}
    value: dict[tuple[str, int], float] = {}  # by column and rank
    wanted = {(c, i): (sizes[f"q{j}"][2 * i], sizes[f"q{j}"][2 * i + 1]) for j, c in enumerate(columns) for i in range(len(p)) if count[c]}
    while wanted:
        keys = list(wanted)
        lows, highs = ([F.lit(wanted[k][side]) for k in keys] for side in (0, 1))
        x = [F.col(c) for c, _ in keys]
        facts = rows.agg(
            *[F.count_if(v < lo).alias(f"below{j}") for j, (v, lo) in enumerate(zip(x, lows))],
            *[F.max(F.when(v < lo, v)).alias(f"prev{j}") for j, (v, lo) in enumerate(zip(x, lows))],
            *[F.min(F.when(v > hi, v)).alias(f"next{j}") for j, (v, hi) in enumerate(zip(x, highs))],
        ).first()
        near = F.array(*[F.when((v >= lo) & (v <= hi), F.struct(F.lit(j).alias("j"), v.alias("x"))) for j, (v, lo, hi) in enumerate(zip(x, lows, highs))])
        inside = rows.select(F.explode(F.array_compact(near)).alias("e")).select("e.*").groupBy("j", "x").agg(F.expr("count(1)").alias("c"))
        ahead = Window.partitionBy("j").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
        ranks = {j: [(math.floor(p[i] * (count[c] - 1)) - facts[f"below{j}"], math.ceil(p[i] * (count[c] - 1)) - facts[f"below{j}"])] for j, (c, i) in enumerate(keys)}
        table = F.create_map(*[y for j, ((down, up),) in ranks.items() for y in (F.lit(j), F.array(F.lit(down), F.lit(up)))])
        placed = inside.withColumn("before", F.coalesce(F.sum("c").over(ahead), F.lit(0))).withColumn("r", table[F.col("j")])
        hit = F.exists("r", lambda r: (F.col("before") <= r) & (r < F.col("before") + F.col("c")))
        total = placed.groupBy("j").agg(F.sum("c").alias("held"), F.collect_list(F.when(hit, F.struct("before", "c", "x"))).alias("hits")).collect()  # two values per rank
        got = {r["j"]: r for r in total}
        wider = {}
        for j, (c, i) in enumerate(keys):
            held = got[j]["held"] if j in got else 0
            for rank, own in zip(ranks[j][0], (math.floor, math.ceil)):
                at = (c, own(p[i] * (count[c] - 1)))
                if 0 <= rank < held:
                    value[at] = next(h["x"] for h in got[j]["hits"] if h["before"] <= rank < h["before"] + h["c"])
                elif rank in (-1, held):
                    value[at] = facts[f"prev{j}"] if rank == -1 else facts[f"next{j}"]
                else:
                    # the values on the rank's side, and its place among them
                    low, high = wanted[c, i]
                    low_side = rank < 0
                    m = facts[f"below{j}"] if low_side else count[c] - facts[f"below{j}"] - held
                    r = rank + facts[f"below{j}"] if low_side else rank - held
                    wider[c, i] = (F.when(F.col(c) < low, F.col(c)) if low_side else F.when(F.col(c) > high, F.col(c)), r / max(m - 1, 1))
        wanted = {}
        if wider:
            margin = max(8 * margin, 1e-3)
            again = rows.agg(*[F.percentile_approx(side, _brackets([share], margin), _ACCURACY).alias(f"q{j}") for j, (side, share) in enumerate(wider.values())]).first()
            wanted = {k: tuple(again[f"q{j}"]) for j, k in enumerate(wider)}
    out = []
    for c in columns:
        if count[c]:
            row = []
            for v in p:
                h = v * (count[c] - 1)
                down, up = value[c, math.floor(h)], value[c, math.ceil(h)]
                row.append(down + (up - down) * (h - math.floor(h)) if up != down else down)
            out.append((c, count[c], *row))
    return spark.createDataFrame(out, schema)


def _grouped_quantiles(rows: DataFrame, columns: Sequence[str], names: Sequence[str], p: Sequence[float], by: Sequence[str], margin: float) -> DataFrame:
    """As above per group, and ``__outside``: is a rank neither in its bracket nor next to it?"""
    at = _brackets(p, margin)
    bracket = [F.percentile_approx(c, at, _ACCURACY).alias(f"__q_{c}") for c in columns]
    placed = join_null_safe(rows, measured(rows.groupBy(*by).agg(*bracket)), by)
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("x"), F.col(f"__q_{c}").alias("q")) for c in columns])
    long = placed.select(*by, F.inline(each)).filter("x IS NOT NULL")
    keys = [*by, "column"]
    lo, hi = (lambda i: F.get("q", F.lit(2 * i))), (lambda i: F.get("q", F.lit(2 * i + 1)))
    x = F.col("x")
    facts = long.groupBy(*keys).agg(
        F.expr("count(1)").alias("n"),
        *[F.count_if(x < lo(i)).alias(f"below{i}") for i in range(len(p))],
        *[F.max(F.when(x < lo(i), x)).alias(f"prev{i}") for i in range(len(p))],
        *[F.min(F.when(x > hi(i), x)).alias(f"next{i}") for i in range(len(p))],
    )
    near = F.filter(F.array(*[F.lit(i) for i in range(len(p))]), lambda i: (x >= F.get("q", i * 2)) & (x <= F.get("q", i * 2 + 1)))
    inside = long.select(*keys, "x", F.explode(near).alias("i")).groupBy(*keys, "i", "x").agg(F.expr("count(1)").alias("c"))
    ahead = Window.partitionBy(*keys, "i").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("before", F.coalesce(F.sum("c").over(ahead), F.lit(0)))
    met = join_null_safe(inside, facts, keys)
    target = F.get(F.array(*[F.lit(v) for v in p]), F.col("i")) * (F.col("n") - 1)
    below = F.get(F.array(*[F.col(f"below{i}") for i in range(len(p))]), F.col("i"))

    def value_at(rank: Column) -> Column:
        return F.max(F.when((F.col("before") <= rank) & (rank < F.col("before") + F.col("c")), F.col("x")))

    met = met.withColumns({"h": target, "below": below})
    down, up = F.floor("h") - F.col("below"), F.ceil("h") - F.col("below")
    picked = met.groupBy(*keys, "i").agg(value_at(down).alias("down"), value_at(up).alias("up"), F.sum("c").alias("held"))
    wide = picked.groupBy(*keys).agg(*[F.max(F.when(F.col("i") == i, F.struct("down", "up", "held"))).alias(f"v{i}") for i in range(len(p))])
    joined = join_null_safe(facts, wide, keys, "left")

    def rank(i: int) -> Column:
        return F.lit(p[i]) * (F.col("n") - 1)

    def result(i: int) -> Column:
        low, high = (rank_of(rank(i)) - F.col(f"below{i}") for rank_of in (F.floor, F.ceil))
        held = F.coalesce(F.col(f"v{i}.held"), F.lit(0))
        down = F.when(low < 0, F.col(f"prev{i}")).when(low >= held, F.col(f"next{i}")).otherwise(F.col(f"v{i}.down"))
        up = F.when(high < 0, F.col(f"prev{i}")).when(high >= held, F.col(f"next{i}")).otherwise(F.col(f"v{i}.up"))
        return (down + (up - down) * (rank(i) - F.floor(rank(i)))).alias(names[i])

    outside = F.lit(False)
    for i in range(len(p)):
        held = F.coalesce(F.col(f"v{i}.held"), F.lit(0))
        outside = outside | (F.floor(rank(i)) - F.col(f"below{i}") < -1) | (F.ceil(rank(i)) - F.col(f"below{i}") > held)
    return joined.select(*keys, "n", *[result(i) for i in range(len(p))], outside.alias("__outside"))
