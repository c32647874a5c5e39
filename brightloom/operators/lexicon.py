"""A sentiment lexicon grown from seed words over the graph of words that occur together."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.functions.text import POLARITY, STOP_WORDS, sentences, tokens
from brightloom.session import measured, spread, stages


def _pair_counts(window: int, most: int = 1_000_000) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sentences as lists of words to ``(a, b, n)``: every word with those up to ``window`` places ahead, the smaller one first.

    Words become numbers in their order, pairs products of numbers, which are counted over about ``most`` words at a time.
    """

    def counted(lists: list[pa.Array]) -> pa.RecordBatch:
        w = pa.concat_arrays(lists)
        sentence = np.repeat(np.arange(len(w)), w.value_lengths().to_numpy(zero_copy_only=False))
        coded = w.flatten().dictionary_encode()
        order = pc.sort_indices(coded.dictionary).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        word = rank[coded.indices.to_numpy(zero_copy_only=False)]
        met = [np.zeros(0, np.int64)]
        for j in range(1, window + 1):
            x, y = word[:-j], word[j:]
            ok = (sentence[:-j] == sentence[j:]) & (x != y)
            met.append(np.minimum(x, y)[ok] * len(order) + np.maximum(x, y)[ok])
        pair, n = np.unique(np.concatenate(met), return_counts=True)
        a, b = np.divmod(pair, max(1, len(order)))
        words = coded.dictionary.take(pa.array(order))
        return pa.RecordBatch.from_arrays([words.take(pa.array(a)), words.take(pa.array(b)), pa.array(n, pa.int64())], ["a", "b", "n"])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch.column(0))
            size += len(batch.column(0).flatten())
            if size >= most:
                yield counted(held)
                held, size = [], 0
        if size:
            yield counted(held)

    return pairs


def word_graph(df: DataFrame, text: str, window: int = 5, least: int = 5, least_pairs: int = 3, stop_words: Iterable[str] = STOP_WORDS) -> DataFrame:
    """``(a, b, weight)``: words that stand within ``window`` words of each other in a sentence more often than by chance.

    The weight is the positive pointwise mutual information of a pair seen at least ``least_pairs`` times, of words with at least
    ``least`` occurrences; both directions are there. Pairs are formed and summed up inside the task before they are
    shuffled; words too rare are dropped from the pairs by a join on written counts.
    """
    with stages(df.sparkSession):
        rows = measured(spread(df.select(F.col(text).alias("t"))).select(F.explode(F.transform(sentences("t"), lambda s: tokens(s, stop_words, 2))).alias("w")).filter(F.size("w") > 0))
        words = measured(rows.select(F.explode("w").alias("word")).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least))

        met = rows.mapInArrow(_pair_counts(window), "a string, b string, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_pairs)
        met = measured(met)
        total = met.agg(F.sum("n").cast("double").alias("n")).first()["n"] or 1.0
        ends = met.select(F.col("a").alias("word"), "n").unionByName(met.select(F.col("b").alias("word"), "n")).groupBy("word").agg(F.sum("n").alias("k"))
        known = measured(words.join(ends, "word").select("word", "k"))
        both = met.join(known.withColumnsRenamed({"word": "a", "k": "ka"}), "a").join(known.withColumnsRenamed({"word": "b", "k": "kb"}), "b")
        weight = F.log(F.col("n") * 2 * total / (F.col("ka").cast("double") * F.col("kb")))
        edges = both.select("a", "b", weight.alias("weight")).filter("weight > 0")
        return measured(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "weight")), keep=True)


def propagate(edges: DataFrame, seeds: Mapping[str, float] = POLARITY, rounds: int = 20, settle: float = 1e-3, pull: float = 0.85) -> DataFrame:
    """``(word, polarity)`` of all words that the graph connects with a seed, between -1 and 1.

    In every round a word takes ``pull`` times the weighted mean of its neighbours; seeds keep their own value. It ends when no word
    moves by more than ``settle``. Messages are summed where they arise before they meet at a word, so a hub is no hot task.
    """
    spark = edges.sparkSession
    fixed = spark.createDataFrame([(w, float(v)) for w, v in seeds.items()], "word string, seed double")
    with stages(spark):
        strength = measured(edges.groupBy(F.col("a").alias("word")).agg(F.sum("weight").alias("total")).join(F.broadcast(fixed), "word", "left"))  # the seeds
        now = strength.filter("seed IS NOT NULL").select("word", F.col("seed").alias("polarity"))
        for _ in range(rounds):
            heard = edges.join(now, F.col("b") == F.col("word")).groupBy(F.col("a").alias("to")).agg(F.sum(F.col("weight") * F.col("polarity")).alias("sum"))
            then = strength.join(heard, F.col("word") == F.col("to"), "left").select("word", F.coalesce("seed", pull * F.col("sum") / F.col("total")).alias("polarity")).filter("polarity IS NOT NULL")
            old = now.withColumnsRenamed({"word": "was", "polarity": "before"})
            now = measured(then.join(old, F.col("word") == F.col("was"), "left").select("word", "polarity", F.abs(F.col("polarity") - F.coalesce("before", F.lit(0.0))).alias("moved")))
            most = now.agg(F.max("moved").alias("m")).first()["m"]
            now = now.drop("moved")
            if most is None or most <= settle:
                break
        return measured(now, keep=True)


def grown_lexicon(df: DataFrame, text: str, seeds: Mapping[str, float] = POLARITY, most: int = 10_000, least_polarity: float = 0.05, **graph) -> dict[str, float]:
    """The ``most`` most polar words with their polarity, in steps of a tenth of the strongest word that is no seed, and the seeds.

    A bounded table, so that scoring texts with it stays a projection.
    """
    found = propagate(word_graph(df, text, **graph), seeds).filter(~F.col("word").isin(*seeds) & (F.abs("polarity") >= least_polarity))
    best = found.orderBy(F.desc(F.abs("polarity")), "word").limit(most).collect()
    top = max((abs(r["polarity"]) for r in best), default=1.0)
    return {r["word"]: round(r["polarity"] / top, 1) for r in best if round(r["polarity"] / top, 1)} | {w: float(v) for w, v in seeds.items()}
