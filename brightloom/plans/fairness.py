"""Fairness over labelled documents: outcome = quality, protected attribute = English or not."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightloom.functions.numeric import rounded
from brightloom.operators import eda, fairness
from brightloom.plans.common import table
from brightloom.registry import query

_D = """d AS (SELECT d.doc_id, d.lang, l.quality, l.toxic, CAST(d.lang = 'en' AS INTEGER) AS en, CAST(n_chars > 1500 AS INTEGER) AS pred
              FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"""
_RATES = """r AS (SELECT avg(quality) FILTER (en = 0) AS ru, avg(quality) FILTER (en = 1) AS rp, avg(pred) FILTER (en = 0 AND quality = 1) AS tu,
              avg(pred) FILTER (en = 1 AND quality = 1) AS tp FROM d)"""
_W = """w AS (SELECT *, (count(*) OVER (PARTITION BY en))::DOUBLE * (count(*) OVER (PARTITION BY quality)) /
              ((count(*) OVER ()) * (count(*) OVER (PARTITION BY en, quality))) AS weight FROM d)"""


def labelled(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return d.join(table(spark, sf, "labels"), "doc_id").select(
        "doc_id", "lang", "quality", "toxic", (F.col("lang") == "en").cast("int").alias("en"), (F.col("n_chars") > 1500).cast("int").alias("pred")
    )


@query(
    "protected_groups",
    f"""WITH {_D} SELECT doc_id, en AS en_privileged, toxic AS toxic_privileged, NULL::INTEGER AS lang_privileged FROM d""",
)
def protected_groups(spark, sf):
    out = fairness.encode_protected(labelled(spark, sf), ["en", "toxic", "lang"])
    return out.select("doc_id", "en_privileged", "toxic_privileged", "lang_privileged")


@query("disparate_impact", f"WITH {_D}, {_RATES} SELECT round(ru, 6) AS rate_unprivileged, round(rp, 6) AS rate_privileged, round(ru / rp, 6) AS disparate_impact FROM r")
def disparate_impact(spark, sf):
    m = fairness.fairness_metrics(labelled(spark, sf), "quality", ["en"])
    return m.select(*[rounded(c, 6).alias(c) for c in ("rate_unprivileged", "rate_privileged", "disparate_impact")])


@query("statistical_parity_difference", f"WITH {_D}, {_RATES} SELECT round(ru - rp, 6) AS statistical_parity_difference FROM r")
def statistical_parity_difference(spark, sf):
    m = fairness.fairness_metrics(labelled(spark, sf), "quality", ["en"])
    return m.select(rounded("statistical_parity_difference", 6).alias("statistical_parity_difference"))


@query("equal_opportunity_difference", f"WITH {_D}, {_RATES} SELECT round(tu, 6) AS tpr_unprivileged, round(tp, 6) AS tpr_privileged, round(tu - tp, 6) AS equal_opportunity_difference FROM r")
def equal_opportunity_difference(spark, sf):
    m = fairness.fairness_metrics(labelled(spark, sf), "quality", ["en"], prediction="pred")
    return m.select(*[rounded(c, 6).alias(c) for c in ("tpr_unprivileged", "tpr_privileged", "equal_opportunity_difference")])


@query("reweighing", f"WITH {_D}, {_W} SELECT doc_id, en, quality, round(weight, 6) AS weight FROM w")
def reweighing(spark, sf):
    out = fairness.reweighing(labelled(spark, sf), "quality", "en")
    return out.select("doc_id", "en", "quality", rounded("weight", 6).alias("weight"))


@query(
    "fairness_improvement",
    f"""WITH {_D}, {_RATES}, {_W}, a AS (SELECT sum(weight * quality) FILTER (en = 0) / sum(weight) FILTER (en = 0) AS wu,
            sum(weight * quality) FILTER (en = 1) / sum(weight) FILTER (en = 1) AS wp FROM w)
        SELECT 'disparate_impact' AS metric, round(ru / rp, 6) AS before, round(wu / wp, 6) AS after, round(wu / wp - ru / rp, 6) + 0::DOUBLE AS change FROM r, a
        UNION ALL SELECT 'statistical_parity_difference', round(ru - rp, 6), round(wu - wp, 6) + 0::DOUBLE, round(wu - wp - (ru - rp), 6) + 0::DOUBLE FROM r, a""",
)
def fairness_improvement(spark, sf):
    out = fairness.fairness_improvement(labelled(spark, sf), "quality", "en")
    return out.select("metric", *[rounded(c, 6).alias(c) for c in ("before", "after", "change")])


@query("protected_distribution", f"WITH {_D} SELECT lang, quality, count(*) AS n FROM d GROUP BY ALL")
def protected_distribution(spark, sf):
    return eda.grouped_histogram(labelled(spark, sf), "lang", "quality")
