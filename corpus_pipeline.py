"""Corpus pipeline: rule and classifier filters, near duplicates, packing, each stage over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quotegrid.llm import jaccard_join, packing, quality_classifier, quality_rules
from quotegrid.session import stage


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return quality_rules.keep_good(docs)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more by a model fitted on the labelled ones of the whole table: few bad ones are left here."""
    documents, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return quality_classifier.keep_good(docs, labels, documents)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by 0.8 on five-word shingles."""
    return jaccard_join.keep_one(docs, k=5, p=80, q=100)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document lies in the packed sequences."""
    return packing.pack(docs)


STAGES = [("quality_rules", rules), ("quality_classifier", classifier), ("near_duplicates", near_duplicates), ("packing", pack)]

#: Robust estimates, a fitted model and greedy packing are not SQL. The tests hold base rules, components and packing against
#: brute force, and the two filters by what they keep of planted rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
