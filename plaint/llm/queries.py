"""The registered query of each operator, over whole tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaint.llm import (
    alignment,
    decontaminate,
    fingerprints,
    language,
    negatives,
    neardup,
    packing,
    phrases,
    quality,
    sharding,
    suffixes,
    tokencounts,
    warc,
)
from plaint.session import pin

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_odd_sketch_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op3_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_sequences(table(spark, sf_dir, "documents"))


@query
def op4_deep_shallow_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_earlier_bytes(table(spark, sf_dir, "documents"))


@query
def op5_prefix_filtered_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_byte_network_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


@query
def op8_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.hilbert_shards(table(spark, sf_dir, "documents"))


@query
def op9_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archived(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op10_phrase_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.document_fingerprints(table(spark, sf_dir, "documents"))


@query
def op11_rank_synchronous_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.token_counts(table(spark, sf_dir, "documents"))


@query
def op12_hilbert_block_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = vectors.withColumn("label", F.expr("case when vec_id % 7 = 0 then (label + 1) % 10 else label end"))
    return negatives.hard_negatives(moved, "vec_id % 100 = 0")


@query
def op13_coalesced_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokens(table(spark, sf_dir, "documents"))
