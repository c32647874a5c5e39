"""Corpus pipeline: toxicity, language identification, near-duplicates, benchmark decontamination, source mix.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows that the stage before kept, and all but the last return the
columns of ``documents``. Models are trained on the rows at hand and the labels of ``sf_dir``. Null ids, repeated rows,
null and empty texts and extra columns are handled as the operators say; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brightloom.llm import decontaminate, language_id, near_dedup, source_mix, toxicity
from brightloom.plans.common import table
from brightloom.session import measured


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.drop_unidentified(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs, width=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), width=5, threshold=0.8)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return source_mix.mix_sources(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: SQL cannot express the trained models; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of what the stages keep; every stage is written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = measured(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
