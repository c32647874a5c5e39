"""Near-duplicate documents: an inverted join on the coordinates of MinHash signatures.

1. Every text becomes its set of word shingles and a signature of ``coordinates`` minimum hashes. Equal sets form one class.
2. Classes are posted under their (coordinate, value) pairs. Two sets of similarity t agree on ``coordinates * t``
   coordinates on average; the match threshold c is the largest that misses less than ``miss`` of such pairs. Two
   signatures that agree on c coordinates share one of the rarest ``coordinates - c + 1`` postings of either (one global
   order: frequency), so only this prefix is posted. Postings of a single class come first in the order and need no
   list: classes that are mostly of their own drop out here, and very frequent passages are rarely reached.
3. Lists are not merged pair by pair. Every list is first skipped through by its pivot, the member with the fewest
   postings of its own: (member, pivot) collisions are counted, retained from c matching coordinates on, and
   confirmed on the full sets. Links become components.
4. What is left are pairs of a list whose members are still in different components. Lists are cut into blocks of
   bounded size, and blocks are compared in tasks: matching coordinates first, then full sets of what passed. Tasks
   return connecting links only, never the pairs of a group.

No list, group of copies or frequent passage is capped or dropped. Class ids are 64-bit hashes of the sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.llm.common import hash_share, rows_in, rows_not_in, small_batches
from brightloom.session import measured, stages

_PIECE = 1 << 12


def match_threshold(coordinates: int, similarity: float, miss: float) -> int:
    """Largest c with P(fewer than c of ``coordinates`` agree) <= ``miss`` for sets of the given similarity."""
    total = 0.0
    for c in range(coordinates + 1):
        total += comb(coordinates, c) * similarity**c * (1 - similarity) ** (coordinates - c)
        if total > miss:
            return max(c, 1)
    return coordinates


def shingle_set(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of UTF-8 text, A-Z lower-cased; with fewer words one, without none."""
    words = (text or b"").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    take = min(width, n)
    factor = np.uint64(0x9E3779B97F4A7C15)
    total = np.full(n - take + 1, take, np.uint64)
    for i in range(take):
        total = (total ^ h[i : n - take + 1 + i]) * factor
        total ^= total >> np.uint64(29)
    return np.unique(total)


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    rng = np.random.default_rng(20240229)
    a = rng.integers(0, 1 << 63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, coordinates, dtype=np.uint64)
    lowest = np.full(coordinates, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), _PIECE):
        part = shingles[i : i + _PIECE, None] * a + b
        part ^= part >> np.uint64(31)
        np.minimum(lowest, (part * np.uint64(0xD6E8FEB86659FD93)).min(0), out=lowest)
    return (lowest >> np.uint64(33)).astype(np.int32)


def _sign(docs: DataFrame, key: str, text: str, width: int, coordinates: int) -> DataFrame:
    """``(doc_id, n_shingles, cls, sig)``; null class and signature without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, ids, sigs = [], [], []
            for t in b.column(1):
                s = shingle_set(t.as_py(), width)
                sizes.append(len(s))
                ids.append(np.int64(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).view(np.int64)) if len(s) else None)
                sigs.append(signature(s, coordinates) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), pa.array(sigs, pa.list_(pa.int32()))], names=["doc_id", "n_shingles", "cls", "sig"]
            )

    rows = small_batches(docs).select(F.col(key).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(sign, f"doc_id {kind}, n_shingles long, cls long, sig array<int>")


def _sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``(cls, shingles)`` of the wanted ``(cls, rep)``: texts of the representatives only are shingled again."""

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t.as_py(), width) for t in b.column(0)]
            ids = [np.int64(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).view(np.int64)) for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["cls", "shingles"])

    reps = wanted.select(F.col("rep").alias("__rep")).distinct()
    texts = rows_in(docs.select(F.col(f"`{key}`").alias("__key"), F.col(text).alias("__text")), "__key", measured(reps)).select(F.col("__text").cast("binary"))
    made = texts.mapInArrow(shingle, "cls long, shingles array<long>")
    # rows that repeat an id may bring other or equal sets
    return made.join(wanted.select("cls"), "cls", "left_semi").groupBy("cls").agg(F.first("shingles").alias("shingles"))


def components(edges: DataFrame) -> DataFrame:
    """``(node, comp)``: connected components of edges ``(a, b)``, named by their smallest node.

    Alternating large-star and small-star steps, each two shuffles of the edges, written after every round, until
    nothing changes. High-degree nodes are split by pre-aggregation: a step needs the minimum of a node's
    neighbours only.
    """
    with stages(edges.sparkSession):
        both = lambda e: e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        e = measured(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        before = None
        while True:
            # large star: neighbours above a node move to the smallest of its neighbourhood
            sym = both(e)
            low = sym.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
            large = sym.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            large = measured(large.filter("a <> b").distinct())
            # small star: neighbours below a node, and the node itself, move to the smallest of them
            low = large.groupBy("a").agg(F.min("b").alias("m"))
            moved = large.join(low, "a")
            small = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(low.select("a", F.col("m").alias("b")))
            e = measured(small.filter("a <> b").distinct())
            now = tuple(e.agg(F.expr("count(1)"), F.expr("sum(cast(xxhash64(a, b) as decimal(38, 0)))")).first())
            if now == before:
                break
            before = now
        named = e.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionAll(e.select("b", "b").distinct().toDF("node", "comp"))
        return measured(named, keep=True)


def _runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Groups of equal ``keys`` from sorted rows that come in batches."""
    rest = None
    for f in batches:
        f = f if rest is None else pd.concat([rest, f], ignore_index=True)
        if not len(f):
            continue
        values = f[keys].to_numpy()
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(1)) + 1
        starts = np.r_[0, cuts]
        for s, t in zip(starts[:-1], cuts):
            yield f.iloc[s:t]
        rest = f.iloc[starts[-1] :]
    if rest is not None and len(rest):
        yield rest


def _matching(threshold: int):
    """Members of a block that agree with one of another component on enough coordinates: ``(token, xb, yb, cls, side)``."""

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in _runs(batches, ["token", "xb", "yb"]):
            side = g["side"].to_numpy()
            if side.all() or not side.any():
                continue
            x, y = g[side == 1], g[side == 0]
            sx, sy = np.stack(x["sig"].to_numpy()), np.stack(y["sig"].to_numpy())
            equal = sx[:, None, :] == sy[None, :, :]
            ok = (equal.sum(2) >= threshold) & (x["comp"].to_numpy()[:, None] != y["comp"].to_numpy()[None, :])
            if not ok.any():
                continue
            # a pair belongs to the first list that both are posted in; whole values tell which coordinates agree
            i, j = np.nonzero(ok)
            mx, my = x["mask"].to_numpy()[i], y["mask"].to_numpy()[j]
            bits = (equal[i, j] * (np.int64(1) << np.arange(sx.shape[1], dtype=np.int64))).sum(1) & mx & my
            first = bits & -bits
            mine = first == np.int64(1) << np.int64(int(g["token"].iloc[0]) >> 32)
            i, j = np.unique(i[mine]), np.unique(j[mine])
            if not len(i):
                continue
            members = np.r_[x["cls"].to_numpy()[i], y["cls"].to_numpy()[j]]
            comps = np.r_[x["comp"].to_numpy()[i], y["comp"].to_numpy()[j]]
            yield pd.DataFrame({k: g[k].iloc[0] for k in ("token", "xb", "yb")} | {"cls": members, "comp": comps, "side": np.r_[np.ones(len(i), int), np.zeros(len(j), int)]})

    return match


def overlaps(x: list[np.ndarray], y: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, as products of membership matrices cut by ``columns``."""
    flat = np.concatenate([*x, *y])
    owner = np.repeat(np.arange(len(x) + len(y)), [len(s) for s in (*x, *y)])
    values, at, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[at]
    owner, col = owner[keep], number[at[keep]]
    order = np.argsort(col, kind="stable")
    owner, col = owner[order], col[order]
    total = np.zeros((len(x), len(y)), np.float32)
    for start in range(0, int(shared.sum()), columns):
        lo, hi = np.searchsorted(col, [start, start + columns])
        m = np.zeros((len(x) + len(y), columns), np.float32)
        m[owner[lo:hi], col[lo:hi] - start] = 1
        total += m[: len(x)] @ m[len(x) :].T
    return total.astype(np.int64)


def _confirming(percent: int):
    """Links ``(a, b)`` that connect components inside a block, confirmed on full sets; no link that others imply."""

    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in _runs(batches, ["token", "xb", "yb"]):
            side = g["side"].to_numpy()
            x, y = g[side == 1], g[side == 0]
            if not len(x) or not len(y):
                continue
            sx, sy = [np.asarray(s) for s in x["shingles"]], [np.asarray(s) for s in y["shingles"]]
            both = overlaps(sx, sy)
            union = np.array([len(s) for s in sx])[:, None] + np.array([len(s) for s in sy])[None, :] - both
            cx, cy = x["comp"].to_numpy(), y["comp"].to_numpy()
            i, j = np.nonzero((100 * both >= percent * union) & (cx[:, None] != cy[None, :]))
            parent: dict[int, int] = {}

            def root(v: int) -> int:
                while parent.get(v, v) != v:
                    v = parent[v]
                return v

            links = []
            for p, q in zip(i, j):
                a, b = root(int(cx[p])), root(int(cy[q]))
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    links.append((int(x["cls"].iloc[p]), int(y["cls"].iloc[q])))
            if links:
                yield pd.DataFrame(links, columns=["a", "b"])

    return confirm


def duplicate_groups(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    coordinates: int = 48,
    miss: float = 1e-5,
    block: int = 256,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every row.

    Texts are linked whose word shingle sets have an intersection of at least ``percent`` percent of their union;
    ``component_id`` is the smallest id reachable over links, ``kept`` whether it is the row's own. Null, empty and blank
    texts have no shingles and are linked with nothing (``component_id`` is their id). Rows that repeat an id and
    text are equal copies with one id; a null id is never the smallest unless a group has no other.
    """
    with stages(docs.sparkSession):
        c = match_threshold(coordinates, percent / 100, miss)
        prefix = coordinates - c + 1
        signed = measured(_sign(docs, key, text, width, coordinates), keep=True)
        classes = (
            signed.filter("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.expr("count(1)").alias("rows"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"))
        )
        # for comparing, 15 bits of a coordinate do
        classes = measured(classes.withColumn("short", F.transform("sig", lambda v: (v % 32768).cast("short"))))

        # postings, their frequencies, and each class's rarest ones
        posted = classes.select("cls", F.posexplode("sig").alias("i", "v")).select("cls", (F.shiftleft(F.col("i").cast("long"), 32) + F.col("v")).alias("token"))
        shared = measured(posted.groupBy("token").agg(F.expr("count(1)").alias("df")).filter("df > 1"))
        ranked = posted.join(shared, "token").groupBy("cls").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("p"))
        own = coordinates - F.size("p")
        heads = ranked.withColumn("own", own).filter(F.col("own") < prefix).select("cls", "own", F.expr(f"slice(p, 1, {prefix} - own)").alias("p"))
        mask = F.aggregate("p", F.lit(0).cast("long"), lambda m, x: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(x["token"], 32).cast("int"))))
        postings = measured(heads.select("cls", "own", mask.alias("mask"), F.explode("p.token").alias("token")))
        lists = measured(postings.groupBy("token").agg(F.expr("count(1)").alias("members"), F.min(F.struct("own", "cls")).alias("pivot")).filter("members > 1"))

        # members against the pivots of their lists
        met = postings.join(lists, "token").select("cls", F.col("pivot.cls").alias("other")).filter("cls <> other")
        pairs = met.select(F.least("cls", "other").alias("a"), F.greatest("cls", "other").alias("b")).groupBy("a", "b").agg(F.expr("count(1)").alias("collisions"))
        a, b = (classes.select(F.col("cls").alias(s), F.col("n").alias(f"n_{s}"), F.col("short").alias(f"sig_{s}")) for s in "ab")
        agreeing = F.size(F.filter(F.zip_with("sig_a", "sig_b", lambda p, q: p == q), lambda x: x))
        alike = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
        candidates = measured(pairs.join(a, "a").join(b, "b").filter(alike).filter(agreeing >= c).select("a", "b", "collisions"))
        wanted = postings.join(lists.select("token"), "token", "left_semi").select("cls").distinct()
        sets = measured(_sets(docs, measured(classes.join(wanted, "cls", "left_semi").select("cls", "rep")), key, text, width))
        sa, sb = (sets.select(F.col("cls").alias(s), F.col("shingles").alias(f"s_{s}")) for s in "ab")
        inter = F.size(F.array_intersect("s_a", "s_b"))
        confirmed = candidates.join(sa, "a").join(sb, "b").withColumn("both", inter)
        confirmed = confirmed.filter(100 * F.col("both") >= percent * (F.size("s_a") + F.size("s_b") - F.col("both"))).select("a", "b")
        links = measured(confirmed)
        comps = components(links)

        # lists that still hold several components: all pairs of different components, block by block
        placed = postings.join(comps.withColumnRenamed("node", "cls"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
        placed = measured(placed)
        several = placed.groupBy("token").agg(F.expr("count(1)").alias("members"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        several = several.filter("members > 2 AND lo <> hi").join(lists.select("token", F.col("pivot.cls").alias("pivot")), "token")
        at_pivot = several.join(comps.withColumnRenamed("node", "pivot").withColumnRenamed("comp", "main"), "pivot", "left").withColumn("main", F.coalesce("main", "pivot"))
        open_lists = placed.join(at_pivot.select("token", "members", "main"), "token")
        outside = (F.col("comp") != F.col("main")).cast("int")
        counts = open_lists.groupBy("token").agg(F.sum(outside).alias("x_members"))
        # the pivot itself met everybody
        row = open_lists.join(counts, "token").join(classes.select("cls", "sig"), "cls").withColumns({"nx": F.ceil(F.col("x_members") / block), "ny": F.ceil(F.col("members") / block)})
        spot = hash_share(37, "cls")
        row = row.withColumns({"bx": F.floor(spot * F.col("nx")), "by": F.floor(spot * F.col("ny"))})
        cols = ["token", "cls", "comp", "mask", "sig"]
        as_y = row.select(*cols, F.lit(0).alias("side"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("nx") - 1)).alias("xb"), F.col("by").alias("yb"))
        as_x = row.filter(outside == 1).select(*cols, F.lit(1).alias("side"), F.col("bx").alias("xb"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("ny") - 1)).alias("yb"))
        blocks = as_x.unionByName(as_y).repartition("token", "xb", "yb").sortWithinPartitions("token", "xb", "yb")
        passed = measured(blocks.mapInPandas(_matching(c), "token long, xb long, yb long, cls long, comp long, side long"))
        full = passed.join(sets, "cls").repartition("token", "xb", "yb").sortWithinPartitions("token", "xb", "yb")
        more = measured(full.mapInPandas(_confirming(percent), "a long, b long"))
        if more.head(1):
            comps = components(links.unionByName(more))

        # smallest id per component, then per class; only classes with copies or links need a lookup
        linked = classes.select("cls", "rep", "rows").join(comps.withColumnRenamed("node", "cls"), "cls", "left").withColumn("group", F.coalesce("comp", "cls"))
        linked = linked.filter((F.col("rows") > 1) | F.col("comp").isNotNull())
        smallest = linked.groupBy("group").agg(F.min("rep").alias("component_id"))
        lookup = measured(linked.join(smallest, "group").select("cls", F.col("component_id").alias("found")), keep=True)
    result = signed.select("doc_id", "n_shingles", "cls").join(lookup.withColumn("hit", F.lit(True)), "cls", "left")
    component = F.when(F.col("hit"), F.col("found")).otherwise(F.col("doc_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", **params) -> DataFrame:
    """One row of every group; columns unchanged.

    The row whose id is the group's smallest stays. Rows that share an id are one document: it stays if one of them
    would, as one row (any of them). Rows with a null id count as one document in this, but keep all their rows.
    """
    groups = duplicate_groups(docs, key=key, **params)
    ids = groups.groupBy(F.col("doc_id").alias("__id")).agg(F.bool_or("kept").alias("kept"), F.expr("count(1)").alias("n"))
    changed = measured(ids.filter("NOT kept OR n > 1"))
    rest = rows_not_in(docs, key, changed.select("__id"))
    again = changed.filter("kept").select("__id")
    if not again.head(1):
        return rest
    repeated = rows_in(docs, key, again)
    once = repeated.filter(F.col(f"`{key}`").isNotNull()).dropDuplicates([key])
    return rest.unionByName(once).unionByName(repeated.filter(F.col(f"`{key}`").isNull()))
