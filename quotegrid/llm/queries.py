"""One query per operator, over its whole table, with the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quotegrid.llm import bwt_dedup, byte_bpe, fingerprints, jaccard_join, packing, prefix_trie, quality_classifier, quality_rules, sharding, token_counts, warc, whitening, wrappers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {"op2_warc": warc.ORACLE, "op12_prefix_trie": prefix_trie.ORACLE}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.round_trip(read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(read(spark, sf_dir, "pages"))


@query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(read(spark, sf_dir, "documents"))


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op7_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(read(spark, sf_dir, "pages"))


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


@query
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edit_probe(read(spark, sf_dir, "documents"))


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read(spark, sf_dir, "documents"), shards=40)


@query
def op11_bwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwt_dedup.removal_report(read(spark, sf_dir, "documents"))


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie_report(read(spark, sf_dir, "conversations"))


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))
