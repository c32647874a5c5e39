"""URL filters by path templates.

For every host a tree of path segments is grown level by level from counts: values that are frequent at their node or
differ significantly from the rest of it stay literal, all others become the wildcard ``*``, and literal branches whose
continuations and labels do not differ statistically are merged. A url's template is its path through the tree. Templates are then rejected by
the purity of their labelled urls, smoothed towards the same template on all hosts, and that towards the rate of all urls.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightloom.llm.common import ascii_lower
from brightloom.session import measured, stages


@dataclass(frozen=True)
class Rule:
    action: str  # allow or block
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without it."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """Text of the longest rule that fits, null if none does (of equally long ones: the longer host)."""
    fits = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(str(r)), len(r.host))):
        on_host = (host == r.host) | F.endswith(host, F.lit("." + r.host))
        fits = F.when(on_host & F.startswith(path, F.lit(r.path)), F.lit(str(r))).otherwise(fits)
    return fits


KINDS = ["k_end", "k_number", "k_word", "k_mixed"]
LISTED = 20  # members that the name of a merged branch lists; others are counted


def _merge_branches(max_distance: float, max_z: float):
    """Merge the profiles of a node: a frequent segment has one of its own, others share the one of their bin."""

    def similar(a, b) -> bool:
        if sum(abs(a[k] / a["n"] - b[k] / b["n"]) for k in KINDS) / 2 > max_distance:
            return False
        if not a["lab"] or not b["lab"]:
            return a["lab"] == b["lab"]  # branches without labels don't take over those of others
        pooled = (a["bad"] + b["bad"]) / (a["lab"] + b["lab"])
        spread = (pooled * (1 - pooled) * (1 / a["lab"] + 1 / b["lab"])) ** 0.5
        return abs(a["bad"] / a["lab"] - b["bad"] / b["lab"]) <= max_z * spread

    def merge(node: pd.DataFrame) -> pd.DataFrame:
        groups: list[dict] = []
        for row in node.sort_values(["n", "seg"], ascending=[False, True]).to_dict("records"):
            for g in groups:
                if similar(g, row):
                    g["of"].append(row)
                    for k in [*KINDS, "n", "lab", "bad"]:
                        g[k] += row[k]
                    break
            else:
                groups.append(row | {"of": [row]})
        out = []
        for g in groups:
            names = sorted(r["seg"].replace("*", "%2A").replace("(", "%28").replace("|", "%7C") for r in g["of"])
            more = sum(r["members"] for r in g["of"]) - len(names[:LISTED])
            listed = [*names[:LISTED], *[f"+{more}"][: more > 0]]
            token = listed[0] if len(listed) == 1 else "(" + "|".join(listed) + ")"
            out += [(g["host"], g["prefix"], r["bin"], token) for r in g["of"]]
        return pd.DataFrame(out, columns=["host", "prefix", "bin", "token"])

    return merge


def _difference(parts: Sequence[str]) -> Column:
    """How much the counts ``parts`` (they add up to ``n``) differ from those of the rest of the node (columns with ``all_``).

    Likelihood-ratio statistic, less what any further degree of freedom adds: by chance it exceeds u with about ``exp(-u / 2)``.
    """

    def term(seen: Column, of: Column, both: Column) -> Column:
        expected = of.cast("double") * both / F.col("all_n")
        return F.when(seen > 0, 2 * seen * F.log(seen / expected)).otherwise(0.0)

    total = F.lit(-2.0 * (len(parts) - 3))
    for k in parts:
        own, both = F.col(k), F.col(f"all_{k}")
        total = total + term(own, F.col("n"), both) + term(both - own, F.col("all_n") - F.col("n"), both)
    return total


def _literal_branches(children: DataFrame, min_support: int, min_share: float, max_distance: float, max_z: float) -> DataFrame:
    """``(host, prefix, seg, token)`` of the segments that stay literal: any number in a node.

    Below ``min_share`` a segment has to differ from the rest of its node, in labels (bad, good or none) or in continuations;
    about 5 % (``max_z`` 1.96) of those that pass may do so by chance (Benjamini and Hochberg, on counts per step of 1/2).
    They are pooled by bins of their profile (continuations in steps of 1/16, labels none or a share of bad ones in steps of
    1/20), summed without bringing a node together; one task then merges the profiles of a node, whose number the bins
    and ``min_share`` bound.
    """
    children = children.withColumns({"good": F.col("lab") - F.col("bad"), "bare": F.col("n") - F.col("lab")})
    counts = ["n", "bad", "good", "bare", *KINDS]
    nodes = children.groupBy("host", "prefix").agg(*[F.sum(c).alias(f"all_{c}") for c in counts], F.count_if(F.col("n") >= min_support).alias("candidates"))
    rest = F.greatest(F.col("all_n") - F.col("n"), F.lit(1))
    distance = sum((F.abs(F.col(k) / F.col("n") - (F.col(f"all_{k}") - F.col(k)) / rest) for k in KINDS), F.lit(0.0)) / 2
    told = F.greatest(_difference(["bad", "good", "bare"]), F.when(distance > max_distance, _difference(KINDS)))
    shape = [F.floor(16 * F.col(k) / F.col("n")).cast("string") for k in KINDS]
    shares = F.when(F.col("lab") > 0, F.floor(20 * F.col("bad") / F.col("lab")).cast("string")).otherwise("-")
    frequent = F.col("n") >= min_share * F.col("all_n")
    candidates = measured(
        children.filter(F.col("n") >= min_support)
        .join(nodes, ["host", "prefix"])
        .withColumns({"frequent": frequent, "told": F.floor(2 * F.least(told, F.lit(200.0))) / 2})
        .withColumn("bin", F.when(frequent, F.concat(F.lit("s"), F.col("seg"))).otherwise(F.concat_ws(",", F.lit("p"), *shape, shares)))
        .select("host", "prefix", "seg", "bin", "n", "lab", "bad", *KINDS, "frequent", "told", "candidates")
    )
    steps = candidates.groupBy("host", "prefix", "told").agg(F.expr("count(1)").alias("here"), F.first("candidates").alias("candidates"))
    passing = F.sum("here").over(Window.partitionBy("host", "prefix").orderBy(F.desc("told")))
    enough = F.col("told") >= max_z**2 + 2 + 2 * F.log(F.col("candidates") / F.col("passing"))
    bounds = steps.withColumn("passing", passing).filter(enough).groupBy("host", "prefix").agg(F.min("told").alias("bound"))
    kept = candidates.join(bounds, ["host", "prefix"], "left").filter(F.col("frequent") | (F.col("told") >= F.col("bound")))
    profiles = kept.groupBy("host", "prefix", "bin").agg(F.min("seg").alias("seg"), F.expr("count(1)").alias("members"), *[F.sum(c).alias(c) for c in ("n", "lab", "bad", *KINDS)])
    merged = measured(profiles.groupBy("host", "prefix").applyInPandas(_merge_branches(max_distance, max_z), "host string, prefix string, bin string, token string"))
    return kept.join(merged, ["host", "prefix", "bin"]).select("host", "prefix", "seg", "token")


_LEVELS = 8  # after so many levels hosts with few rows left are looked for, to end early


def path_templates(urls: DataFrame, min_support: int = 5, min_share: float = 0.05, max_distance: float = 0.15, max_z: float = 1.96, max_depth: int | None = None) -> DataFrame:
    """Add ``template`` to rows that have ``host``, ``path`` and ``label`` (1 bad, 0 good, null unlabelled).

    A segment value stays literal where it has ``min_support`` rows and either ``min_share`` of the rows of its node or
    labels or continuations that differ significantly from those of the rest of its node, so a node may have any number of
    literal branches; see ``_literal_branches``. Every level is one aggregation with map-side sums, split over hosts of any
    share, and one join with the level's literal branches, broadcast by measured size. Only rows that go deeper take part in the
    next level. The tree ends where its paths do: a host with fewer than ``min_support`` rows left can have no more literal
    segments, so deep paths of few rows cost no levels of their own. With ``max_depth``, segments beyond it are summed up as ``**``.
    """
    spark = urls.sparkSession
    parts = F.filter(F.split("path", "/"), lambda s: s != "")
    rows = measured(urls.withColumns({"__segs": parts, "__prefix": F.lit("")}))
    depth = rows.agg(F.max(F.size("__segs"))).first()[0] or 0
    finished = []
    for level in range(depth if max_depth is None else min(depth, max_depth)):
        finished.append(rows.filter(F.size("__segs") <= level))
        deeper = rows.filter(F.size("__segs") > level)
        with stages(spark):
            seg, following = F.get("__segs", F.lit(level)), F.get("__segs", F.lit(level + 1))
            kind = F.when(following.isNull(), "k_end").when(F.regexp_like(following, F.lit(r"^[0-9]+$")), "k_number").when(F.regexp_like(following, F.lit(r"^\p{L}+$")), "k_word").otherwise("k_mixed")
            children = measured(
                deeper.groupBy("host", F.col("__prefix").alias("prefix"), seg.alias("seg")).agg(
                    F.expr("count(1)").alias("n"),
                    F.count("label").alias("lab"),
                    F.coalesce(F.sum("label"), F.lit(0)).cast("long").alias("bad"),
                    *[F.count_if(kind == k).alias(k) for k in KINDS],
                )
            )
            if level >= _LEVELS:
                few = measured(children.groupBy(F.col("host").alias("__host")).agg(F.sum("n").alias("n")).filter(F.col("n") < min_support).select("__host"))
                ended = deeper.join(few, F.col("host") == F.col("__host"), "left_semi")
                left = F.size("__segs") - level
                if max_depth is not None:
                    left = F.least(left, F.lit(max_depth - level))
                finished.append(measured(ended.withColumn("__prefix", F.concat("__prefix", F.repeat(F.lit("/*"), left))), keep=True))
                deeper = deeper.join(few, F.col("host") == F.col("__host"), "left_anti")
            literal = measured(_literal_branches(children, min_support, min_share, max_distance, max_z))
            known = literal.withColumnsRenamed({"host": "__host", "prefix": "__of", "seg": "__seg", "token": "__token"})
            same = (F.col("host") == F.col("__host")) & (F.col("__prefix") == F.col("__of")) & (seg == F.col("__seg"))
            token = F.concat(F.lit("/"), F.coalesce("__token", F.lit("*")))
            rows = measured(deeper.join(known, same, "left").withColumn("__prefix", F.concat("__prefix", token)).drop("__host", "__of", "__seg", "__token"), keep=True)
        if level >= _LEVELS and not rows.head(1):
            break
    for part in finished:
        rows = rows.unionByName(part)
    template = F.col("__prefix") if max_depth is None else F.when(F.size("__segs") > max_depth, F.concat("__prefix", F.lit("/**"))).otherwise(F.col("__prefix"))
    return rows.withColumn("template", template).drop("__segs", "__prefix")


def template_purity(rows: DataFrame, weight: float = 10.0) -> DataFrame:
    """``(host, template, urls, labelled, purity)``: smoothed share of bad ones among a template's labelled urls.

    ``weight`` is how many labelled urls the level above counts for: the same template on all hosts, and for that all urls.
    """
    sums = measured(rows.groupBy("host", "template").agg(F.expr("count(1)").alias("urls"), F.count("label").alias("labelled"), F.coalesce(F.sum("label"), F.lit(0)).alias("bad")))
    total = sums.agg(F.sum("labelled").alias("n"), F.sum("bad").alias("bad")).first()
    rate = (total["bad"] or 0) / total["n"] if total["n"] else 0.0
    shared = sums.groupBy("template").agg(((F.sum("bad") + weight * rate) / (F.sum("labelled") + weight)).alias("above"))
    return sums.join(shared, "template").select("host", "template", "urls", "labelled", ((F.col("bad") + weight * F.col("above")) / (F.col("labelled") + weight)).alias("purity"))


def judge_urls(pages: DataFrame, rules: Sequence[Rule], threshold: float = 0.5, weight: float = 10.0, key: str = "page_id", url: str = "url", **tree) -> DataFrame:
    """``(page_id, host, path, rule, verdict, template, purity)`` of every row.

    The longest fitting rule decides; its verdicts are also the labels of the templates. Urls without a rule are
    blocked where their template's purity (share of blocked urls) reaches ``threshold``. Null urls and urls without
    ``://`` have an empty host and path and the empty template; repeated rows are judged alike and count as often as
    they occur.
    """
    split = pages.select(F.col(key).alias("page_id"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    ruled = split.withColumn("rule", matching_rule(rules, F.col("host"), F.col("path")))
    blocking = [str(r) for r in rules if r.action == "block"]
    ruled = ruled.withColumn("label", F.when(F.col("rule").isNotNull(), F.col("rule").isin(*blocking).cast("int")))
    rows = measured(path_templates(ruled, **tree))
    purity = measured(template_purity(rows, weight).select("host", "template", "purity"))
    blocked = F.coalesce(F.col("label"), (F.col("purity") >= threshold).cast("int")) == 1
    return rows.join(purity, ["host", "template"]).select(
        "page_id", "host", "path", "rule", F.when(blocked, "block").otherwise("allow").alias("verdict"), "template", "purity"
    )
