"""Text and survey analysis over the documents table. Its prose is invented, so the word tables here are frequent fragments."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightloom.functions.numeric import rounded
from brightloom.functions.text import STOP_WORDS
from brightloom.operators import latent, lexicon
from brightloom.operators import text as tx
from brightloom.plans.common import table
from brightloom.registry import query

LEXICON = {"tion": 1.0, "ha": 1.0, "ing": 1.0, "ai": 1.0, "eau": 0.5, "th": -1.0, "nd": -1.0, "ed": -1.0, "ch": -1.0, "or": -0.5}
KEYWORDS = {"service": ["tion", "ing"], "price": ["eau", "ai"], "quality": ["orantion", "ononst"], "delivery": ["thatin", "hehely"]}

_STOP = "(" + ", ".join(f"'{w}'" for w in STOP_WORDS) + ")"
_RAW = r"list_filter(string_split_regex(regexp_replace(lower(text), '[^a-z\s]', '', 'g'), '\s+'), lambda t: len(t) >= 1)"
_TOKS = rf"list_filter(string_split_regex(regexp_replace(lower(text), '[^a-z\s]', '', 'g'), '\s+'), lambda t: len(t) >= 1 AND t NOT IN {_STOP})"
_LONG = rf"list_filter(string_split_regex(regexp_replace(lower(text), '[^a-z\s]', '', 'g'), '\s+'), lambda t: len(t) >= 2 AND t NOT IN {_STOP})"
_SUM = " + ".join(f"{w} * len(list_filter(toks, lambda t: t = '{k}'))" for k, w in LEXICON.items())
_SENT = f"""r AS (SELECT doc_id, lang, text, {_RAW} AS toks FROM documents),
 p AS (SELECT doc_id, lang, CASE WHEN length(trim(text)) > 0 THEN 1 / (1 + exp(-({_SUM}))) END AS polarity FROM r),
 s AS (SELECT *, CASE WHEN polarity >= 0.5 THEN 'POSITIVE' WHEN polarity < 0.5 THEN 'NEGATIVE' ELSE 'UNKNOWN' END AS label,
   coalesce(greatest(polarity, 1 - polarity), 0) AS score FROM p)"""
_VOCAB = f"""e AS (SELECT doc_id, unnest({_LONG}) AS term FROM documents),
 v AS (SELECT term, count(*) AS total, count(DISTINCT doc_id) AS df FROM e GROUP BY term ORDER BY total DESC, term LIMIT 1000),
 i AS (SELECT term, total, df, ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1 AS idf FROM v),
 t AS (SELECT doc_id, e.term, count(*) * any_value(idf) AS raw FROM e JOIN i ON i.term = e.term GROUP BY doc_id, e.term),
 w AS (SELECT doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM t)"""


def docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang", "text")


def scored(spark, sf):
    return tx.lexicon_sentiment(docs(spark, sf).select("doc_id", "lang", "text"), "text", LEXICON)


@query("tokenize_filter", f"SELECT doc_id, coalesce(array_to_string({_TOKS}, ' '), '') AS clean_text FROM documents")
def tokenize_filter(spark, sf):
    return tx.tokenize_filter(docs(spark, sf), "text").select("doc_id", "clean_text")


@query("lexicon_sentiment", f"WITH {_SENT} SELECT doc_id, label, round(score, 6) AS score, round(polarity, 6) AS polarity FROM s")
def lexicon_sentiment(spark, sf):
    return scored(spark, sf).select("doc_id", "label", rounded("score", 6).alias("score"), rounded("polarity", 6).alias("polarity"))


@query("text_classifier")
def text_classifier(spark, sf):
    d = docs(spark, sf).join(table(spark, sf, "labels"), "doc_id").select("doc_id", "text", "quality")
    fresh = F.md5(F.col("doc_id").cast("string")) < "cccccccc"
    model = tx.train_text_classifier(d.filter(fresh), "text", "quality")
    out = tx.apply_text_classifier(model, d.filter(~fresh), "text")
    return out.select("doc_id", "quality", "predicted", rounded("probability", 4).alias("probability"))


@query(
    "sentiment_distribution",
    f"WITH {_SENT} SELECT label, count(*) AS n, round(avg(score), 6) AS mean_score, round(avg(polarity), 6) AS mean_polarity FROM s GROUP BY label",
)
def sentiment_distribution(spark, sf):
    out = tx.sentiment_distribution(scored(spark, sf))
    return out.withColumns({"mean_score": rounded("mean_score", 6), "mean_polarity": rounded("mean_polarity", 6)})


@query(
    "sentiment_segments",
    f"""WITH {_SENT}, g AS (SELECT doc_id, CASE WHEN polarity > 0.6 THEN 'positive' WHEN polarity < 0.4 THEN 'negative' END AS segment FROM s)
        SELECT segment, doc_id, CAST(row_number() OVER (PARTITION BY segment ORDER BY doc_id) AS INTEGER) AS rank FROM g WHERE segment IS NOT NULL QUALIFY rank <= 5""",
)
def sentiment_segments(spark, sf):
    return tx.sentiment_segments(scored(spark, sf), "doc_id").select("segment", "doc_id", "rank")


@query(
    "top_phrases",
    f"""WITH r AS (SELECT {_RAW} AS toks FROM documents),
        g AS (SELECT unnest(list_concat(toks, list_transform(range(1, len(toks)), lambda i: toks[i] || ' ' || toks[i + 1]),
              list_transform(range(1, len(toks) - 1), lambda i: toks[i] || ' ' || toks[i + 1] || ' ' || toks[i + 2]))) AS phrase FROM r)
        SELECT phrase, count(*) AS n FROM g WHERE split_part(phrase, ' ', 1) NOT IN {_STOP} AND split_part(phrase, ' ', -1) NOT IN {_STOP}
        GROUP BY phrase ORDER BY n DESC, phrase LIMIT 10""",
)
def top_phrases(spark, sf):
    return tx.top_phrases(docs(spark, sf), "text", 10)


@query("tfidf_vectors", f"WITH {_VOCAB} SELECT doc_id, term, round(weight, 6) AS weight FROM w")
def tfidf_vectors(spark, sf):
    return tx.tfidf_vectors(docs(spark, sf), "doc_id", "text").withColumn("weight", rounded("weight", 6))


@query("text_clusters")
def text_clusters(spark, sf):
    return tx.text_clusters(docs(spark, sf), "text", 5).select("doc_id", "cluster")


@query(
    "cluster_top_terms",
    f"""WITH {_VOCAB}, n AS (SELECT lang, count(*) AS size FROM documents GROUP BY lang),
        m AS (SELECT d.lang, term, sum(weight) / any_value(size) AS mean_weight FROM w JOIN documents d ON d.doc_id = w.doc_id JOIN n ON n.lang = d.lang GROUP BY d.lang, term)
        SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY round(mean_weight, 9) DESC, term) AS INTEGER) AS rank, term, round(mean_weight, 6) AS mean_weight
        FROM m QUALIFY rank <= 10""",
)
def cluster_top_terms(spark, sf):
    d = docs(spark, sf)
    out = tx.group_top_terms(tx.tfidf_vectors(d, "doc_id", "text"), d.select("doc_id", "lang"), "doc_id", "lang")
    return out.withColumn("mean_weight", rounded("mean_weight", 6))


@query("theme_extraction")
def theme_extraction(spark, sf):
    return tx.theme_extraction(docs(spark, sf), "doc_id", "text").withColumn("share", rounded("share", 4))


@query(
    "theme_sentiment_crosstab",
    f"WITH {_SENT} SELECT lang, count(*) AS n, round(avg(polarity), 6) AS mean_polarity, count(*) FILTER (label = 'NEGATIVE') AS n_negative FROM s GROUP BY lang",
)
def theme_sentiment_crosstab(spark, sf):
    return tx.theme_sentiment_crosstab(scored(spark, sf), "lang").withColumn("mean_polarity", rounded("mean_polarity", 6))


_CATS = ", ".join(
    f"CASE WHEN len(list_filter(toks, lambda t: t IN ({', '.join(repr(w) for w in ws)}))) > 0 THEN '{c}' END" for c, ws in KEYWORDS.items()
)


@query(
    "feedback_categories",
    f"""WITH r AS (SELECT doc_id, {_RAW} AS toks FROM documents), f AS (SELECT doc_id, list_filter([{_CATS}], lambda c: c IS NOT NULL) AS found FROM r)
        SELECT doc_id, CASE WHEN len(found) > 0 THEN array_to_string(found, ',') ELSE 'Uncategorized' END AS categories FROM f""",
)
def feedback_categories(spark, sf):
    out = tx.feedback_categories(docs(spark, sf), "text", KEYWORDS)
    return out.select("doc_id", F.array_join("categories", ",").alias("categories"))


@query(
    "feedback_distribution",
    f"""WITH r AS (SELECT doc_id, {_RAW} AS toks FROM documents), f AS (SELECT doc_id, list_filter([{_CATS}], lambda c: c IS NOT NULL) AS found FROM r)
        SELECT unnest(CASE WHEN len(found) > 0 THEN found ELSE ['Uncategorized'] END) AS category, count(*) AS n FROM f GROUP BY 1""",
)
def feedback_distribution(spark, sf):
    return tx.category_distribution(tx.feedback_categories(docs(spark, sf), "text", KEYWORDS))


_SENTENCES = r"list_filter(list_transform(string_split_regex(text, '[.!?]+\s*|\n+'), lambda s: trim(s)), lambda s: s <> '')"


@query(
    "extractive_summary",
    rf"""WITH e AS (SELECT unnest({_LONG}) AS term FROM documents), v AS (SELECT term, count(*) AS total FROM e GROUP BY term),
        w AS (SELECT term, total / sum(total) OVER () AS w FROM v), l AS (SELECT doc_id, {_SENTENCES} AS ss FROM documents),
        s AS (SELECT doc_id, unnest(range(len(ss))) AS position, unnest(ss) AS text FROM l),
        x AS (SELECT doc_id, position, text, unnest({_LONG}) AS term FROM s),
        c AS (SELECT doc_id, position, any_value(text) AS sentence, avg(coalesce(w, 0)) AS score FROM x LEFT JOIN w ON w.term = x.term GROUP BY doc_id, position)
        SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, position) AS INTEGER) AS rank, CAST(position AS INTEGER) AS position,
               sentence, round(score, 6) AS score FROM c QUALIFY rank <= 3""",
)
def extractive_summary(spark, sf):
    out = tx.extractive_summary(docs(spark, sf), "doc_id", "text", 3)
    return out.select("doc_id", "rank", "position", "sentence", rounded("score", 6).alias("score"))


@query(
    "conversation_transcripts",
    """SELECT conv_id, count(*) AS n_turns,
       CAST(to_json(list(struct_pack(turn := turn, role := role, text := text) ORDER BY turn)) AS VARCHAR) AS transcript FROM conversations GROUP BY ALL""",
)
def conversation_transcripts(spark, sf):
    return tx.conversation_transcripts(table(spark, sf, "conversations"), "conv_id", "turn", "role", "text")


_GRAPH = rf"""l AS (SELECT unnest({_SENTENCES}) AS text FROM documents), t AS (SELECT {_LONG} AS w FROM l),
 n AS (SELECT word FROM (SELECT unnest(w) AS word FROM t) GROUP BY word HAVING count(*) >= 20),
 p AS (SELECT w[i] AS x, w[i + j] AS y FROM (SELECT w, unnest(range(1, len(w))) AS i FROM t), range(1, 6) r(j) WHERE i + j <= len(w)),
 e AS (SELECT least(x, y) AS a, greatest(x, y) AS b, count(*) AS n FROM p WHERE x <> y GROUP BY ALL HAVING count(*) >= 5),
 k AS (SELECT word, sum(n) AS k FROM (SELECT a AS word, n FROM e UNION ALL SELECT b, n FROM e) GROUP BY word),
 g AS (SELECT a, b, ln(e.n * 2 * (SELECT sum(n) FROM e)::DOUBLE / (ka.k::DOUBLE * kb.k)) AS weight FROM e JOIN k ka ON ka.word = a JOIN k kb ON kb.word = b
       WHERE a IN (SELECT word FROM n) AND b IN (SELECT word FROM n))"""


@query("word_graph", f"WITH {_GRAPH} SELECT a, b, round(weight, 6) AS weight FROM g WHERE weight > 0 UNION ALL SELECT b, a, round(weight, 6) FROM g WHERE weight > 0")
def word_graph(spark, sf):
    """Words that stand near each other more often than by chance; the lexicon grows along these edges."""
    return lexicon.word_graph(docs(spark, sf), "text", least=20, least_pairs=5).withColumn("weight", rounded("weight", 6))


@query(
    "embed_latent",
    f"""WITH t AS (SELECT {_LONG} AS w FROM documents) SELECT count(*) AS n_texts, count(*) FILTER (len(w) > 0) AS n_placed, true AS unit_length, CAST(64 AS BIGINT) AS dims FROM t""",
)
def embed_latent(spark, sf):
    """Checked summary of the latent embeddings: every text with a term has a position of length one."""
    d = docs(spark, sf)
    out = latent.embed_latent(d.select("text"), "text", latent.fit_latent(d, "text", dims=64))
    length = F.aggregate("embedding", F.lit(0.0), lambda t, x: t + x.cast("double") * x)
    return out.select(length.alias("l"), F.size("embedding").alias("d")).agg(
        F.count("*").alias("n_texts"), F.count_if(F.col("l") > 0).alias("n_placed"), F.every((F.col("l") == 0) | (F.abs(F.col("l") - 1) < 1e-5)).alias("unit_length"), F.max("d").cast("long").alias("dims")
    )


@query("sentiment_lexicon")
def sentiment_lexicon(spark, sf):
    """Polarity of all words that the graph of the documents connects with the seed words."""
    edges = lexicon.word_graph(docs(spark, sf), "text", least=20, least_pairs=5)
    return lexicon.propagate(edges, LEXICON).withColumn("polarity", rounded("polarity"))
