"""Spelling variants: near words found by k-d trees over letter counts, and the forms they lead to.

Two words that differ by one replaced letter have equal lengths and letter counts that differ by one up and one down; an inserted
letter adds one count. So the words of a length form a tree over their letter counts, and a search keeps only the boxes that a
word can reach within one step up and one down. Words with the same letters are told apart further by the counts of their first half,
which an edit changes by one up and one down at most. Only words in a reached leaf are compared letter by letter.

The upper levels of a length's tree cut its words into cells of a bounded size, which are the tasks: every word goes to its own
cell as a member and to each cell it can reach, of its own length and of the next, as a query. The rest of the tree is grown there.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.llm.common import ascii_lower, hash_share
from brightloom.session import measured

RUN = "[A-Za-zÀ-ÿ]+"
LETTERS = 90  # a to z, and 64 dimensions for all other code points
LEAF = 16
# Steps up and down that an edit may take: in the counts of the word, and in those of its first half.
REPLACED = ((1, 1), (1, 1))
INSERTED = ((1, 0), (1, 1))


def letter_codes(words: list[str], length: int) -> np.ndarray:
    """``(words, length)`` code points."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(-1, length)


def letter_counts(codes: np.ndarray, half: int) -> np.ndarray:
    """Counts (up to 255) of every letter in the words and in their first ``half`` letters, side by side."""
    dims = np.where((codes >= 97) & (codes < 123), codes.astype(np.int64) - 97, 26 + codes % 64)
    rows = np.arange(len(codes))[:, None] * (2 * LETTERS)

    def count(d: np.ndarray, shift: int) -> np.ndarray:
        return np.bincount((rows + d + shift).ravel(), minlength=len(codes) * 2 * LETTERS)

    both = count(dims, 0) + count(dims[:, :half], LETTERS)
    return np.minimum(both, 255).astype(np.uint8).reshape(-1, 2 * LETTERS)


def _best_cut(x: np.ndarray) -> tuple[float, int, int]:
    """The most even cut ``(share of the smaller side, dimension, largest count on the left)`` of the rows ``x``."""
    middle = (x.min(axis=0).astype(int) + x.max(axis=0)) // 2
    best = (0.0, 0, 0)
    for cut in (0, 1, 2, 3, middle):
        share = (x <= cut).mean(axis=0)
        even = np.minimum(share, 1 - share)
        d = int(even.argmax())
        if even[d] > best[0]:
            best = (float(even[d]), d, int(cut if np.isscalar(cut) else cut[d]))
    return best


def grow(counts: np.ndarray, rows: np.ndarray, most: float) -> tuple | np.ndarray:
    """Tree ``(dimension, cut, left, right)`` whose leaves hold at most ``most`` of the ``rows``, or rows that no count tells apart.

    Letters of the whole word are cut first; those of its first half only where the others cut off less than a sixteenth.
    """
    if len(rows) <= most:
        return rows
    x = counts[rows]
    even, d, cut = _best_cut(x[:, :LETTERS])
    if even < 1 / 16:
        other = _best_cut(x[:, LETTERS:])
        if other[0] > even:
            even, d, cut = other[0], other[1] + LETTERS, other[2]
    if not even:
        return rows
    left = x[:, d] <= cut
    return d, cut, grow(counts, rows[left], most), grow(counts, rows[~left], most)


def reach(tree: tuple | np.ndarray | int, x: np.ndarray, steps: tuple) -> Iterator[tuple]:
    """``(leaf, rows of x)``: the leaves whose box each row can reach within the ``steps``.

    A box that lies beyond a row in a dimension costs it as many steps as it is away; steps add up over dimensions.
    """
    low, high = {}, {}

    def walk(node, rows: np.ndarray, spent: np.ndarray):
        if not len(rows):
            return
        if not isinstance(node, tuple):
            yield node, rows
            return
        d, cut, left, right = node
        group = d // LETTERS
        v = x[rows, d].astype(np.int16)
        was_low, was_high = low.get(d, 0), high.get(d, 255)
        for child, column, cost in (
            (left, 2 * group + 1, np.maximum(v - cut, 0) - np.maximum(v - was_high, 0)),
            (right, 2 * group, np.maximum(cut + 1 - v, 0) - np.maximum(was_low - v, 0)),
        ):
            total = spent[:, column] + cost
            go = total <= steps[group][column % 2]
            then = spent[go]
            then[:, column] = total[go]
            low[d], high[d] = (was_low, cut) if child is left else (cut + 1, was_high)
            yield from walk(child, rows[go], then)
        low[d], high[d] = was_low, was_high

    yield from walk(tree, np.arange(len(x)), np.zeros((len(x), 4), np.int16))


def replaced_in(queries: np.ndarray, members: np.ndarray) -> np.ndarray:
    """``[query, member]``: do the words differ in exactly one place?"""
    different = np.zeros((len(queries), len(members)), np.uint8)
    for i in range(members.shape[1]):
        different += (different < 2) & (queries[:, None, i] != members[None, :, i])
    return different == 1


def inserted_in(queries: np.ndarray, members: np.ndarray) -> np.ndarray:
    """``[query, member]``: is the member the query and one more letter somewhere?"""
    length = queries.shape[1]
    shape = (len(queries), len(members))
    begin, end = np.zeros(shape, np.int32), np.zeros(shape, np.int32)
    for i in range(length):
        begin += (begin == i) & (queries[:, None, i] == members[None, :, i])
        end += (end == i) & (queries[:, None, length - 1 - i] == members[None, :, length - i])
    return begin + end >= length


def near_in_cell(members: list[str], queries: list[str], cells: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of pairs ``(query, member)`` that differ by one edit; members have one length, queries the same or one less."""
    length = len(members[0])
    member_codes = letter_codes(members, length)
    tree = grow(letter_counts(member_codes, length // 2), np.arange(len(members)), LEAF)
    sizes = np.fromiter(map(len, queries), np.int64, len(queries))
    for n, steps, test in ((length, REPLACED, replaced_in), (length - 1, INSERTED, inserted_in)):
        own = np.flatnonzero(sizes == n)
        if not len(own) or not n:
            continue
        codes = letter_codes([queries[i] for i in own], n)
        for leaf, rows in reach(tree, letter_counts(codes, length // 2), steps):
            each = max(1, cells // len(leaf))
            for i in range(0, len(rows), each):
                q, m = np.nonzero(test(codes[rows[i : i + each]], member_codes[leaf]))
                if len(q):
                    yield own[rows[i : i + each][q]], leaf[m]


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = 6, least: int = 5, period: int = 199) -> DataFrame:
    """``(word, n, length)``: words of at least ``shortest`` letters that occur at least ``least`` times in all texts.

    Words are runs of letters, A-Z lower-cased. Where the crc32 of ``<key>:<run>`` is a multiple of ``period``, the run loses
    one letter, which the crc32 chooses. A null key is written as the empty string; null and empty texts have no words.
    """
    runs = docs.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("k"), F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.filter(F.length("run") >= shortest).select("k", ascii_lower("run").alias("run"))
    runs = runs.withColumns({"h": F.crc32(F.concat("k", F.lit(":"), "run")), "length": F.length("run")})
    at: Column = (F.col("h") % F.col("length")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.col("length")))
    word = F.when(F.col("h") % period == 0, shorter).otherwise(F.col("run"))
    counts = runs.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counts.withColumn("length", F.length("word")).filter((F.col("n") >= least) & (F.col("length") >= shortest))


def upper_trees(words: DataFrame, cell_words: int, sample: int) -> dict[int, tuple | int]:
    """For every length with more than ``cell_words`` words the upper levels of its tree, its leaves numbered.

    Cuts come from about ``sample`` words in all, drawn by hash; a cell is not made smaller than 32 of them. The cuts only place
    words, so the result does not depend on them.
    """
    sizes = {r["length"]: r["count"] for r in words.groupBy("length").count().filter(F.col("count") > cell_words).collect()}
    if not sizes:
        return {}
    rate = min(1.0, sample / sum(sizes.values()))
    most = max(cell_words * rate, 32)
    drawn = words.filter(F.col("length").isin(list(sizes)) & (hash_share(13, "word") < rate)).select("word", "length")
    trees = {}

    def numbered(node, count: Iterator[int]):
        return (node[0], node[1], numbered(node[2], count), numbered(node[3], count)) if isinstance(node, tuple) else next(count)

    for length, part in drawn.toPandas().groupby("length"):  # about `sample` words
        counts = letter_counts(letter_codes(part["word"].tolist(), length), length // 2)
        trees[length] = numbered(grow(counts, np.arange(len(counts)), most), iter(range(len(counts) + 1)))
    return trees


def _leaves(tree: tuple | int) -> int:
    return _leaves(tree[2]) + _leaves(tree[3]) if isinstance(tree, tuple) else 1


def near_words(words: DataFrame, cell_words: int = 8000, sample: int = 200_000) -> DataFrame:
    """``(word, n, near, near_n)``: every pair of ``(word, n, length)`` that differs by one letter, once from either side."""
    trees = upper_trees(words, cell_words, sample)
    stay = ((0, 0), (0, 0))

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for length, part in frame.groupby("length"):
                codes = letter_codes(part["word"].tolist(), length)
                for target, role, steps in ((length, 0, stay), (length, 1, REPLACED), (length + 1, 1, INSERTED)):
                    if target not in trees:
                        yield part[["word", "n"]].assign(length=target, cell=0, role=role)
                        continue
                    for cell, rows in reach(trees[target], letter_counts(codes, target // 2), steps):
                        yield part.iloc[rows][["word", "n"]].assign(length=target, cell=cell, role=role)

    def match(pdf: pd.DataFrame) -> pd.DataFrame:
        mine, theirs = (pdf[pdf["role"] == r] for r in (0, 1))
        found = [(np.array([], object), np.array([], np.int64)) * 2]
        if len(mine) and len(theirs):
            (a, an), (b, bn) = ((side["word"].to_numpy(object), side["n"].to_numpy(np.int64)) for side in (theirs, mine))
            for q, m in near_in_cell(b.tolist(), a.tolist()):
                once = np.fromiter((len(x) < len(y) or x < y for x, y in zip(a[q], b[m])), bool, len(q))
                q, m = q[once], m[once]
                found += [(a[q], an[q], b[m], bn[m]), (b[m], bn[m], a[q], an[q])]
        return pd.DataFrame(dict(zip(("word", "n", "near", "near_n"), map(np.concatenate, zip(*found)))))

    tasks = max(words.sparkSession.sparkContext.defaultParallelism, 2 * sum(map(_leaves, trees.values())))
    sent = words.mapInPandas(route, "word string, n long, length int, cell int, role int").repartition(min(tasks, 20_000), "length", "cell")
    return sent.groupBy("length", "cell").applyInPandas(match, "word string, n long, near string, near_n long")


def spelling_forms(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = 6, least: int = 5, period: int = 199, ratio: int = 5, cell_words: int = 8000, sample: int = 200_000
) -> DataFrame:
    """One row per word of ``word_counts``: ``(word, form, root, n, n_near, form_n)``.

    A word's form is its near word of largest count (ties: the smallest in code-point order), if it occurs at least ``ratio``
    times as often; its root is where the forms lead in the end, or the word itself. Counts rise by ``ratio`` along a chain, so
    chains are short and a few rounds of doubling reach every end. An empty table gives no rows; other columns are ignored.
    """
    words = measured(word_counts(docs, key, text, shortest, least, period))
    near = near_words(words, cell_words, sample)
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    found = words.join(measured(best), "word", "left")
    enough = -F.col("best.minus") >= F.col("n") * ratio
    rows = measured(
        found.select("word", F.when(enough, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, -F.col("best.minus")).alias("form_n"))
    )
    links = rows.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    top = rows.agg(F.max("n").alias("n")).first()["n"] or 1
    for _ in range(ceil(log(top, ratio) + 1).bit_length()):
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = measured(links.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
    out = rows.join(links, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
