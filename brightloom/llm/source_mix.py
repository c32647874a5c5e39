"""Mixing sources to target weights by entropy balancing.

Every source gets a token target. Among all document rates that meet the targets, entropy balancing takes those with
the least relative entropy to "each document once"; the solution is an exponential tilt, ``rate = exp(lambda_s * z)``
with z the document's size over its source's mean size, held at ``max_rate``. The convex dual has one unknown per source;
distributed Newton steps (kept inside a shrinking bracket) solve all sources at once over the table of
(source, size) counts, which does not grow with the number of documents. Rates are then rounded to whole copies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brightloom.llm.common import hash_share, word_count
from brightloom.operators.ranking import running_totals
from brightloom.session import measured


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """Sources with their number ``sid`` (from 0) by code point, null last: ranked within ranges, so no task gets all."""
    ranged = measured(sizes.repartitionByRange(F.asc_nulls_last("source")).withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = ranged.groupBy("part").agg(F.expr("count(1) AS c")).select("part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("part").orderBy(F.asc_nulls_last("source"))
    return ranged.join(offsets, "part").withColumn("sid", F.col("offset") + F.row_number().over(within) - 1).drop("part", "offset")


def token_targets(sources: DataFrame, weights: Sequence[float], share: float, max_rate: float) -> DataFrame:
    """Add ``target``: ``share`` of all sizes dealt by the repeating ``weights``; a target stops at ``max_rate`` times its
    source's size, and the excess is dealt to the others until none is above."""
    by_rank = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    s = measured(sources.withColumn("weight", by_rank).withColumn("cap", max_rate * F.col("source_size").cast("double")))
    row = s.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    budget, open_weight, n_full, level = share * (row["size"] or 0), row["weight"] or 0.0, 0, 0.0
    left = budget
    while open_weight:
        level = left / open_weight
        full = F.col("weight") * level >= F.col("cap")
        row = s.agg(F.count_if(full).alias("n"), F.sum(F.when(full, F.col("cap"))).alias("cap"), F.sum(F.when(~full, F.col("weight"))).alias("weight")).first()
        if row["n"] == n_full:
            break
        n_full, left, open_weight = row["n"], budget - (row["cap"] or 0.0), row["weight"] or 0.0
    return s.withColumn("target", F.least(F.col("weight") * level, F.col("cap")) if open_weight else F.col("cap"))


def solve_rates(cells: DataFrame, max_rate: float, steps: int = 60, tolerance: float = 1e-7) -> DataFrame:
    """``(sid, lam)``: the dual solution of every source, from cells ``(sid, size, n, z, target)`` with sizes above 0.

    The token sum rises with ``lam``; a Newton step that leaves the bracket is replaced by its middle (or a doubling
    while one end is open). A target of ``max_rate`` times the size has no finite solution but ends where all
    documents have that rate to within the tolerance.
    """
    tilt = F.exp(F.least(F.col("lam") * F.col("z"), F.lit(700.0)))
    tokens = F.col("n") * F.col("size")
    state = measured(cells.groupBy("sid").agg(F.first("target").alias("target")).select("sid", "target", F.lit(0.0).alias("lam"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"), F.lit(False).alias("done")))
    for _ in range(steps):
        sums = cells.drop("target").join(state, "sid").groupBy("sid", "target", "lam", "lo", "hi", "done").agg(
            F.sum(tokens * F.least(tilt, F.lit(max_rate))).alias("g"),
            F.sum(F.when(tilt < max_rate, tokens * F.col("z") * tilt).otherwise(0.0)).alias("slope"),
        )
        gap = F.col("g") - F.col("target")
        lo, hi = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo")), F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))
        bracketed = sums.withColumns({"lo": lo, "hi": hi, "gap": gap, "newton": F.col("lam") - gap / F.nullif(F.col("slope"), F.lit(0.0))})
        open_step = F.when(F.col("gap") < 0, F.greatest(2 * F.col("lam"), F.lit(1.0))).otherwise(F.least(2 * F.col("lam"), F.lit(-1.0)))
        inside = (F.coalesce(F.col("newton") > F.col("lo"), F.lit(True))) & (F.coalesce(F.col("newton") < F.col("hi"), F.lit(True))) & F.col("newton").isNotNull()
        # far out the slope says little: an open end is not left by more than a doubling
        near = F.abs("newton") <= 4 * F.greatest(F.abs("lam"), F.lit(1.0))
        step = F.when(inside & near, F.col("newton")).when(F.col("lo").isNotNull() & F.col("hi").isNotNull(), (F.col("lo") + F.col("hi")) / 2).otherwise(open_step)
        close = F.col("done") | (F.abs("gap") <= tolerance * F.col("target"))
        state = measured(bracketed.select("sid", "target", F.when(close, F.col("lam")).otherwise(step).alias("lam"), "lo", "hi", close.alias("done")))
        if not state.filter(~F.col("done")).head(1):
            break
    return state.select("sid", "lam")


def round_cells(cells: DataFrame, repairs: int = 4) -> DataFrame:
    """Add ``copies``, the whole number of copies that all documents of a cell get together.

    Running totals of the expected copies, from the largest size down, are rounded, so every cell is within one copy
    and the tokens of a source within half of its largest document. Then the one copy more or less that brings a source
    nearest to its target is applied, ``repairs`` times.
    """
    ahead = Window.partitionBy("sid").orderBy(F.desc("size"))
    c = cells.withColumn("e", F.sum(F.col("n") * F.col("rate")).over(ahead.rowsBetween(Window.unboundedPreceding, 0)))
    c = c.withColumn("upto", F.floor(F.col("e") + 0.5)).withColumn("copies", F.col("upto") - F.coalesce(F.lag("upto").over(ahead), F.lit(0)))
    # floating-point sums may round a full cell up by one
    c = measured(c.withColumn("copies", F.least(F.greatest("copies", F.lit(0)), F.col("n") * F.col("most"))).drop("e", "upto"))
    for _ in range(repairs):
        gaps = c.groupBy("sid").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("gap"))
        up = F.when(F.col("copies") < F.col("n") * F.col("most"), F.struct(F.abs(F.col("gap") - F.col("size")).alias("left"), "size", F.lit(1).alias("by")))
        down = F.when(F.col("copies") > 0, F.struct(F.abs(F.col("gap") + F.col("size")).alias("left"), "size", F.lit(-1).alias("by")))
        best = c.join(gaps, "sid").groupBy("sid", "gap").agg(F.min(F.least(up, down)).alias("b")).filter(F.col("b.left") < F.abs("gap"))
        moves = best.select("sid", F.col("b.size").alias("size"), F.col("b.by").alias("by"))
        c = measured(c.join(moves, ["sid", "size"], "left").withColumn("copies", F.col("copies") + F.coalesce("by", F.lit(0))).drop("by"))
    return c


def mix_sources(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, max_rate: int = 2, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``(doc_id, size, source_size, target, taken, copies)`` of every row.

    ``size`` is the number of words (null text: 0), ``taken`` the size times the whole number of ``copies``, at most ``max_rate``.
    Null is a source of its own. Documents of one size in a source have equal rates; which of them get the extra
    copy is decided by the hash of the key, so reruns agree. Rows without words have one copy and take nothing.
    Texts are read once; from then on only keys, sources and sizes move. Sources of any share are split: counts
    per (source, size) are pre-aggregated and equal documents are ranked in ranges of their hash.
    """
    rows = measured(docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size")))
    counts = rows.groupBy("source", "size").agg(F.expr("count(1) AS n"))
    counts = measured(counts)
    sizes = counts.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum(F.when(F.col("size") > 0, F.col("n"))).alias("texts"))
    sources = measured(token_targets(ranked_sources(sizes), weights, share, max_rate))
    known = sources.withColumnRenamed("source", "of")
    cells = counts.join(known, counts["source"].eqNullSafe(known["of"])).select(
        "sid", "source", "size", "n", "source_size", "target", (F.col("size") * F.col("texts") / F.nullif(F.col("source_size"), F.lit(0))).alias("z")
    )
    cells = measured(cells.withColumn("most", F.lit(max_rate)))
    worded = cells.filter("size > 0")
    lam = solve_rates(worded.select("sid", "size", "n", "z", "target"), float(max_rate))
    rated = worded.join(lam, "sid").withColumn("rate", F.least(F.exp(F.least(F.col("lam") * F.col("z"), F.lit(700.0))), F.lit(float(max_rate)))).drop("lam")
    dealt = round_cells(rated).select("source", "size", "n", "source_size", "target", "copies")
    wordless = cells.filter("size = 0").select("source", "size", "n", "source_size", "target", F.col("n").alias("copies"))
    plan = measured(dealt.unionByName(wordless)).withColumnsRenamed({"source": "of", "size": "words"})
    each = rows.join(plan, rows["source"].eqNullSafe(plan["of"]) & (rows["size"] == plan["words"])).drop("of", "words")
    # ranges of the hash, as many as the cell needs: a cell may hold a third of all rows
    each = each.withColumn("u", hash_share(31, "doc_id")).withColumn("range", F.floor(F.col("u") * F.ceil(F.col("n") / 20_000)))
    numbered = running_totals(each, [F.col("u"), F.col("doc_id")], F.col("range"), {"before": F.lit(1).cast("long")}, ["source", "size"])
    own = F.floor(F.col("copies") / F.col("n")) + (F.col("before") < F.col("copies") % F.col("n")).cast("long")
    return numbered.withColumn("own", own).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("own")).alias("taken"), F.col("own").alias("copies"))
