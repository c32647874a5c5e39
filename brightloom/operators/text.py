"""Text and survey analysis over whole texts."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import LDA, KMeans
from pyspark.ml.feature import IDF, CountVectorizer, ElementwiseProduct, HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightloom.functions.text import POLARITY, STOP_WORDS, let, ngrams, one_of, polarity_sum, sentences, term_counts, tokens
from brightloom.operators.ranking import with_stats
from brightloom.session import measured, spread


def exploded(df: DataFrame, items: Column, name: str, *keep: str) -> DataFrame:
    """One row per array element. The outer form computes the array once; a plain explode adds a size filter
    below itself that computes the whole token expression again."""
    return df.select(*keep, F.explode_outer(items).alias(name)).filter(F.col(name).isNotNull())


def tokenize_filter(df: DataFrame, text: str, stop_words: Iterable[str] = STOP_WORDS, key: str | None = None, lemmas: DataFrame | None = None) -> DataFrame:
    """Add ``clean_text``: tokens without stop words, blank-joined in order; with ``lemmas(token, lemma)`` mapped.

    The lemma table is written first, so the join is by measured size; tokens of one text come back together by ``key``,
    which ``lemmas`` needs.
    """
    if lemmas is not None and key is None:
        raise ValueError("lemmas need a key column")
    toks = tokens(text, stop_words)
    if lemmas is None:
        return df.withColumn("clean_text", F.array_join(toks, " "))
    pos = df.select(key, F.posexplode_outer(toks).alias("pos", "token")).filter("token IS NOT NULL")
    joined = pos.join(measured(lemmas), "token", "left").select(key, "pos", F.coalesce("lemma", "token").alias("t"))
    folded = joined.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "t"))).alias("a"))
    clean = folded.select(key, F.array_join(F.transform("a", lambda s: s["t"]), " ").alias("clean_text"))
    return df.join(clean, key, "left").withColumn("clean_text", F.coalesce("clean_text", F.lit("")))


def lexicon_sentiment(df: DataFrame, text: str, lexicon: Mapping[str, float] | None = None) -> DataFrame:
    """Add ``polarity`` = 1/(1+e^-sum of word weights), ``label`` and ``score`` = confidence of the label.

    The whole text counts. Null or blank text is ``UNKNOWN`` with score 0. A pure projection: large inputs are not shuffled.
    """
    total = polarity_sum(F.col("__toks"), POLARITY if lexicon is None else lexicon)
    known = F.length(F.trim(F.col(text))) > 0
    p = F.col("polarity")
    return (
        spread(df).withColumn("__toks", tokens(text, ()))
        .withColumn("polarity", F.when(known, 1 / (1 + F.exp(-total))))
        .drop("__toks")
        .withColumn("label", F.when(p >= 0.5, "POSITIVE").when(p < 0.5, "NEGATIVE").otherwise("UNKNOWN"))
        .withColumn("score", F.coalesce(F.greatest(p, 1 - p), F.lit(0.0)))
    )


def sentiment_distribution(scored: DataFrame) -> DataFrame:
    return scored.groupBy("label").agg(F.count("*").alias("n"), F.avg("score").alias("mean_score"), F.avg("polarity").alias("mean_polarity"))


def sentiment_segments(scored: DataFrame, key: str, high: float = 0.6, low: float = 0.4, n: int = 5) -> DataFrame:
    """The first ``n`` texts by key with polarity above ``high`` and below ``low``: ``(key, polarity, segment, rank)``.

    The scores are written once: as a pushed-down filter the token expressions would run several times.
    """
    scored = measured(scored.select(key, "polarity"))
    segment = F.when(F.col("polarity") > high, "positive").when(F.col("polarity") < low, "negative")
    w = Window.partitionBy("segment").orderBy(key)
    return scored.withColumn("segment", segment).filter("segment IS NOT NULL").withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def top_phrases(df: DataFrame, text: str, k: int = 10, sizes: Sequence[int] = (1, 2, 3), stop_words: Iterable[str] = STOP_WORDS, most: int = 10_000) -> DataFrame:
    """The ``k`` most frequent 1-3-word phrases that neither start nor end with a stop word.

    A phrase is no more frequent than any of its words, so the ``k``-th best count of what is counted already rules out all
    longer phrases with a rarer word. Words are counted first; of longer phrases only those of the words left are
    formed, inside the row, and the bar rises with every size. Where more than ``most`` words are left (all words
    are about equally rare), all phrases of the size are counted. No phrase that can be among the best is left out.
    """
    stop = list(stop_words)
    rows = spread(df.select(F.col(text).alias("t"))).select(tokens("t", ()).alias("toks"))
    words = measured(exploded(rows, F.col("toks"), "phrase").groupBy("phrase").agg(F.count("*").alias("n")))
    found = words.filter(~F.col("phrase").isin(*stop)) if stop else words
    best = measured(found.orderBy(F.desc("n"), "phrase").limit(k)) if 1 in sizes else words.limit(0)
    for size in sorted(set(sizes) - {1}):
        bar = best.agg(F.when(F.count("*") >= k, F.min("n")).otherwise(0)).first()[0]
        kept = [r["phrase"] for r in words.filter(F.col("n") >= bar).limit(most + 1).collect()]  # `most` words and one
        toks = F.col("toks")
        if len(kept) <= most:
            # a word that is too rare cuts the text: runs of the others are what phrases can lie in
            marks = F.transform(toks, lambda t: F.when(t.isin(*kept), t)) if kept else F.array().cast("array<string>")
            grams = let(marks, lambda m: _phrases(m, size, stop))
        else:
            grams = ngrams(toks, size, stop)
        counted = exploded(rows, grams, "phrase").groupBy("phrase").agg(F.count("*").alias("n")).filter(F.col("n") >= bar)
        best = measured(best.unionByName(counted).orderBy(F.desc("n"), "phrase").limit(k))
    return best


def _phrases(marks: Column, n: int, stop: Sequence[str]) -> Column:
    """Blank-joined n-grams without nulls that neither start nor end with a stop word."""
    starts = F.when(F.size(marks) >= n, F.sequence(F.lit(0), F.size(marks) - n)).otherwise(F.array().cast("array<int>"))

    def whole(i: Column) -> Column:
        ok = F.get(marks, i).isNotNull()
        for j in range(1, n):
            ok = ok & F.get(marks, i + j).isNotNull()
        return ok & ~F.get(marks, i).isin(*stop) & ~F.get(marks, i + (n - 1)).isin(*stop) if stop else ok

    return F.transform(F.filter(starts, whole), lambda i: F.concat_ws(" ", *[F.get(marks, i + j) for j in range(n)]))


def vocabulary(df: DataFrame, text: str, size: int = 1000, stop_words: Iterable[str] = STOP_WORDS) -> DataFrame:
    """``(term, total, df, idf)`` of the ``size`` most frequent terms; idf = ln((1+n)/(1+df)) + 1.

    Terms are counted inside each row, so one pass and one shuffle of (term, count) sums give totals and frequencies.
    """
    counts = spread(df.select(F.col(text).alias("t"))).select(F.inline(term_counts(tokens("t", stop_words, 2))))
    return _most_frequent(counts, df.agg(F.count("*")), size)


def _most_frequent(counts: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """The vocabulary of ``(term, tf)`` rows, one per text and term; ``texts`` holds the number of texts."""
    top = counts.groupBy("term").agg(F.sum("tf").alias("total"), F.count("*").alias("df")).orderBy(F.desc("total"), "term").limit(size)
    return with_stats(top, texts, "__n").select("term", "total", "df", (F.log((1 + F.col("__n")) / (1 + F.col("df"))) + 1).alias("idf"))


def tfidf_vectors(df: DataFrame, key: str, text: str, size: int = 1000, stop_words: Iterable[str] = STOP_WORDS) -> DataFrame:
    """Long L2-normalised TF-IDF ``(key, term, weight)``.

    Rows of one ``key`` are one text. Texts are tokenised and counted once, inside the row, and the counts written; other terms
    than the vocabulary's are dropped there, so only its weights are shuffled, once, for the norm.
    """
    rows = spread(df.select(F.col(key).alias("k"), F.col(text).alias("t")))
    counted = measured(rows.select("k", term_counts(tokens("t", stop_words, 2)).alias("terms")))
    vocab = measured(_most_frequent(counted.select(F.inline("terms")), counted.agg(F.count("*")), size)).select("term", "idf")
    known = [r["term"] for r in vocab.select("term").collect()]  # `size` terms
    terms = counted.select("k", F.inline(F.filter("terms", lambda x: x["term"].isin(*known)))).join(F.broadcast(vocab), "term")
    raw = F.col("tf") * F.col("idf")
    norm = F.sqrt(F.sum(raw * raw).over(Window.partitionBy("k")))
    return terms.select(F.col("k").alias(key), "term", (raw / norm).alias("weight"))


def group_top_terms(weights: DataFrame, groups: DataFrame, key: str, group: str, k: int = 10) -> DataFrame:
    """The ``k`` terms with the highest mean weight per group; absent terms count as zero."""
    sizes = measured(groups.groupBy(group).agg(F.count("*").alias("__size")))
    total = weights.join(groups.select(key, group), key).groupBy(group, "term").agg(F.sum("weight").alias("__w"))
    mean = total.join(sizes, group).withColumn("mean_weight", F.col("__w") / F.col("__size"))
    w = Window.partitionBy(group).orderBy(F.desc(F.round("mean_weight", 9)), "term")
    return mean.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select(group, "rank", "term", "mean_weight")


def sparse_tfidf(df: DataFrame, text: str, size: int = 1000, stop_words: Iterable[str] = STOP_WORDS) -> DataFrame:
    """Add the sparse ``features`` vector with smoothed idf and L2 norm."""
    d = df.withColumn("__toks", tokens(text, stop_words, 2))
    counter = CountVectorizer(inputCol="__toks", outputCol="__tf", vocabSize=size).fit(d)
    counted = counter.transform(d)
    fitted = IDF(inputCol="__tf", outputCol="__unused").fit(counted)
    n = fitted.numDocs
    idf = [math.log((1 + n) / (1 + f)) + 1 for f in fitted.docFreq]
    scaled = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="__tf", outputCol="__scaled").transform(counted)
    return Normalizer(p=2.0, inputCol="__scaled", outputCol="features").transform(scaled).drop("__toks", "__tf", "__scaled")


def text_clusters(df: DataFrame, text: str, k: int = 5, seed: int = 42, size: int = 1000) -> DataFrame:
    """Add the k-means ``cluster`` of the TF-IDF vector; only the vectors are cached for the fit, not the texts."""
    vectors = sparse_tfidf(df, text, size)
    fitted_on = vectors.select("features").persist()
    try:
        model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(fitted_on)
    finally:
        fitted_on.unpersist()
    return model.transform(vectors).drop("features")


def theme_extraction(
    df: DataFrame, key: str, text: str, themes: int = 5, words: int = 8, examples: int = 3, seed: int = 42, size: int = 1000, steps: int = 10
) -> DataFrame:
    """LDA themes: ``(theme, keywords, n_texts, share, example_keys)``; every step trains on all texts, over ``size`` terms.

    Only the counts of the ``size`` terms are cached for the steps, not the tokens.
    """
    d = df.select(key, tokens(text, STOP_WORDS, 2).alias("toks"))
    counter = CountVectorizer(inputCol="toks", outputCol="features", vocabSize=size).fit(d)
    counted = counter.transform(d).select(key, "features").persist()
    try:
        model = LDA(k=themes, seed=seed, maxIter=steps, subsamplingRate=1.0, featuresCol="features").fit(counted)
        vocab = F.array(*[F.lit(w) for w in counter.vocabulary])
        topics = model.describeTopics(words).select(
            F.col("topic").alias("theme"), F.transform("termIndices", lambda i: F.get(vocab, i)).alias("keywords")
        )
        mix = vector_to_array("topicDistribution")
        placed = model.transform(counted).select(key, mix.alias("m"))
        placed = placed.select(key, (F.array_position("m", F.array_max("m")) - 1).cast("int").alias("theme"), F.array_max("m").alias("fit"))
        placed = measured(placed)
    finally:
        counted.unpersist()
    w = Window.partitionBy("theme").orderBy(F.desc("fit"), key)
    best = placed.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= examples)
    best = best.groupBy("theme").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", key))), lambda s: s[key]).alias("example_keys"))
    sizes = with_stats(placed.groupBy("theme").agg(F.count("*").alias("n_texts")), placed.agg(F.count("*")), "__n")
    out = topics.join(sizes, "theme", "left").join(best, "theme", "left")
    return out.select(
        "theme", "keywords", F.coalesce("n_texts", F.lit(0)).alias("n_texts"), F.coalesce(F.col("n_texts") / F.col("__n"), F.lit(0.0)).alias("share"),
        "example_keys",
    )


def theme_sentiment_crosstab(scored: DataFrame, theme: str) -> DataFrame:
    return scored.groupBy(theme).agg(F.count("*").alias("n"), F.avg("polarity").alias("mean_polarity"), F.count_if(F.col("label") == "NEGATIVE").alias("n_negative"))


def feedback_categories(df: DataFrame, text: str, keywords: Mapping[str, Sequence[str]]) -> DataFrame:
    """Add ``categories``: every category one of whose keywords occurs; ``Uncategorized`` when none does."""
    toks = F.col("__toks")
    found = F.filter(
        F.array(*[F.when(F.exists(toks, one_of(ws)), F.lit(c)) for c, ws in keywords.items()]), lambda c: c.isNotNull()
    )
    out = df.withColumn("__toks", tokens(text, ())).withColumn("__found", found).drop("__toks")
    chosen = F.when(F.size("__found") > 0, F.col("__found")).otherwise(F.array(F.lit("Uncategorized")))
    return out.withColumn("categories", chosen).drop("__found")


def category_distribution(df: DataFrame) -> DataFrame:
    return exploded(df, F.col("categories"), "category").groupBy("category").agg(F.count("*").alias("n"))


def extractive_summary(df: DataFrame, key: str, text: str, n: int = 3, frequent: int = 20_000) -> DataFrame:
    """The ``n`` sentences per text with the highest mean term weight: ``(key, rank, position, sentence, score)``.

    A term weighs its share among all term occurrences. Sentences are tokenised once and written. Most occurrences are of the
    ``frequent`` terms, whose weights are broadcast, and are summed per sentence where they are; only those of other terms
    are shuffled to their weights. ``key`` is unique.
    """
    counts = spread(df.select(F.col(text).alias("t"))).select(F.inline(term_counts(tokens("t", STOP_WORDS, 2)))).groupBy("term").agg(F.sum("tf").alias("total"))
    counts = measured(counts)
    weights = measured(with_stats(counts, counts.agg(F.sum("total")), "__t").select("term", (F.col("total") / F.col("__t")).alias("w")))
    rows = spread(df.select(F.col(key).alias("k"), F.col(text).alias("t")))
    parts = measured(rows.select("k", F.posexplode(F.transform(sentences("t"), lambda s: tokens(s, STOP_WORDS, 2))).alias("position", "toks")).filter(F.size("toks") > 0))
    terms = parts.select("k", "position", F.explode("toks").alias("term"))
    top = measured(weights.orderBy(F.desc("w"), "term").limit(frequent))
    known = terms.join(F.broadcast(top), "term").groupBy("k", "position").agg(F.sum("w").alias("w"), F.count("*").alias("n"))
    rest = weights.join(F.broadcast(top.select("term")), "term", "left_anti")
    rare = terms.join(F.broadcast(top.select("term")), "term", "left_anti").join(rest, "term", "left").groupBy("k", "position").agg(F.sum(F.coalesce("w", F.lit(0.0))).alias("w"), F.count("*").alias("n"))
    scored = known.unionByName(rare).groupBy("k", "position").agg((F.sum("w") / F.sum("n")).alias("score"))
    w = Window.partitionBy("k").orderBy(F.desc(F.round("score", 9)), "position")
    best = scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
    chosen = measured(best.groupBy("k").agg(F.collect_list(F.struct("rank", "position", "score")).alias("__best")))  # n at most
    found = rows.join(chosen, "k").select("k", sentences("t").alias("__all"), F.inline("__best"))
    return found.select(F.col("k").alias(key), "rank", "position", F.get("__all", F.col("position")).alias("sentence"), "score")


def conversation_transcripts(df: DataFrame, conv: str, turn: str, role: str, text: str, part_turns: int | None = None) -> DataFrame:
    """Turns folded in order into one JSON record per conversation: ``(conv, n_turns, transcript)``.

    With ``part_turns``, a record holds that many turn numbers at most and ``part`` counts the records, so that no record
    grows with its conversation.
    """
    keys = [F.col(conv)] if part_turns is None else [F.col(conv), F.floor(F.col(turn) / part_turns).cast("int").alias("part")]
    turns = F.array_sort(F.collect_list(F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))))
    return df.groupBy(*keys).agg(F.count("*").alias("n_turns"), F.to_json(turns).alias("transcript"))


def train_text_classifier(df: DataFrame, text: str, label: str, features: int = 1 << 14):
    """Hashed TF-IDF and logistic regression; returns the fitted pipeline model."""
    d = df.select(tokens(text, STOP_WORDS, 2).alias("toks"), F.col(label).cast("double").alias("label"))
    stages = [HashingTF(inputCol="toks", outputCol="tf", numFeatures=features), IDF(inputCol="tf", outputCol="features"), LogisticRegression(maxIter=20, regParam=0.01)]
    return Pipeline(stages=stages).fit(d)


def apply_text_classifier(model, df: DataFrame, text: str) -> DataFrame:
    """Add ``predicted`` and ``probability`` of class 1."""
    out = model.transform(df.withColumn("toks", tokens(text, STOP_WORDS, 2)))
    p: Column = vector_to_array("probability")[1]
    return out.select(*df.columns, F.col("prediction").cast("int").alias("predicted"), p.alias("probability"))
