"""Benchmark decontamination: size-partitioned MinHash containment search.

A test item is a set of word shingles; its MinHash sketch is the part of the set with the smallest hashes. Items
are partitioned by size, and the size class fixes the length of the sketch: a document that contains at least a
share t of an item of at most u shingles misses no more than (1 - t) u of them, so it hits one of any
floor((1 - t) u) + 1. Documents of any length are looked up against these sketches (no signature of the long side
is needed, so its length does not dilute the search), and the collisions are verified by the exact number of the
item's shingles that the document contains. No containment above the threshold is missed, of items of any length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.llm.common import SPACE, let, may_be_in, rows_not_in
from brightloom.operators.ranking import join_null_safe
from brightloom.session import measured


PUNCTUATION = ".,;:!?\"'()[]{}<>|*#$%&-_/\\`~^+=@"


def normalised_words(c: Column) -> Column:
    """Lower-case words without punctuation at their edges; words of punctuation only are dropped."""
    parts = F.split(F.lower(F.coalesce(c, F.lit(""))), SPACE)
    return F.filter(F.transform(parts, lambda w: F.btrim(w, F.lit(PUNCTUATION))), lambda w: w != "")


def shingle_hashes(words: Column, width: int, short: Sequence[int] = ()) -> Column:
    """Hashes of all runs of ``width`` words in order; fewer words form one shingle, none give an empty array.

    ``short`` adds the runs of these numbers of words, hashed like a text of as many words.
    """

    def text_hash(w: Column) -> Column:
        return F.xxhash64(F.concat_ws(" ", w))

    def runs(w: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(w) - width), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(width)]))
        none = F.array().cast("array<bigint>")
        out = F.when(F.size(w) >= width, each).when(F.size(w) > 0, F.array(text_hash(w))).otherwise(none)

        def every(n: int) -> Column:
            return F.when(F.size(w) > n, F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: text_hash(F.slice(w, i, F.lit(n))))).otherwise(none)

        return F.concat(out, *map(every, short)) if short else out

    return let(words, runs)


def short_lengths(items: DataFrame, width: int, text: str = "text") -> list[int]:
    """Numbers of words, below ``width``, that items have."""
    n = items.select(F.size(normalised_words(F.col(text))).alias("n")).filter((F.col("n") > 0) & (F.col("n") < width))
    return sorted(r["n"] for r in n.distinct().collect())  # width - 1 rows at most


def item_shingles(items: DataFrame, width: int, threshold: float, item: str = "item_id", text: str = "text") -> DataFrame:
    """``(item_id, h, n_item, size_class, in_sketch)``: every shingle of every item, marked where it is in the sketch.

    Size classes are powers of two; the sketch length comes from the largest size of the class. Rows that repeat
    an item id are one item: the union of their shingles.
    """
    own = items.select(F.col(item).alias("item_id"), shingle_hashes(normalised_words(F.col(text)), width).alias("s"))
    each = own.select("item_id", F.explode("s").alias("h")).groupBy("item_id").agg(F.sort_array(F.collect_set("h")).alias("s"))
    n = F.size("s")
    size_class = F.ceil(F.log2(n)).cast("int")
    # the class bound, but no more than the set itself has
    length = F.least(n, F.floor((1 - threshold) * F.pow(F.lit(2.0), size_class) + 1e-9).cast("int") + 1)
    # which shingles are smallest must not depend on their own hash bits alone: a second hash orders them
    ranked = F.array_sort(F.transform("s", lambda h: F.struct(F.xxhash64(F.lit(7), h).alias("r"), h.alias("h"))))
    return each.select("item_id", n.alias("n_item"), size_class.alias("size_class"), length.alias("length"), F.posexplode(ranked).alias("i", "x")).select(
        "item_id", F.col("x.h").alias("h"), "n_item", "size_class", (F.col("i") < F.col("length")).alias("in_sketch")
    )


def find_contained(docs: DataFrame, items: DataFrame, width: int = 5, threshold: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, item_id, n_item, n_found, containment)`` of all pairs with containment at or above ``threshold``.

    Items of fewer than ``width`` words are one shingle, and are looked for among the runs of as many words of the documents.
    Search: the shingles of all documents meet the sketches, which gives candidate pairs. Verification: documents with a
    candidate (told by a filter of fixed size, so texts are not shuffled) are compared with the whole items. Texts
    are read whole. Null and empty texts contain nothing; items without words are in nothing. Rows that repeat a
    document id count as one document. Tables of items and candidates are written first, so they are broadcast
    only where their measured size allows it.
    """
    wanted = measured(item_shingles(items, width, threshold))
    short = short_lengths(items, width)
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def shingled(of: DataFrame) -> DataFrame:
        return of.select("doc_id", F.explode(shingle_hashes(normalised_words(F.col("text")), width, short)).alias("h"))

    met = shingled(rows).join(wanted.filter("in_sketch").select("item_id", "h"), "h")
    candidates = measured(met.groupBy("doc_id", "item_id").agg(F.expr("count(1)").alias("collisions")))
    near = rows.filter(may_be_in(F.col("doc_id"), candidates.select("doc_id")))
    hits = join_null_safe(shingled(near).join(wanted.select("item_id", "h", "n_item"), "h"), candidates, ["doc_id", "item_id"])
    # a set of n_item hashes at most
    found = hits.groupBy("doc_id", "item_id", "n_item").agg(F.size(F.collect_set("h")).alias("n_found"))
    share = F.col("n_found") / F.col("n_item")
    return found.filter(share >= threshold).select("doc_id", "item_id", "n_item", "n_found", share.alias("containment"))


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", **params) -> DataFrame:
    """Rows of ``docs`` that contain no item; columns unchanged. Rows with a null key are judged together, as one document."""
    bad = measured(find_contained(docs, items, key=key, **params).select(F.col("doc_id").alias("__bad")).distinct())
    return rows_not_in(docs, key, bad)
