"""A corpus from raw documents to packed sequences, as a chain of five stages.

Each stage reads what its predecessor kept and returns documents again (doc_id, text, lang, source,
n_chars); the last one returns the pieces of packed sequences. Between stages the documents are a
Parquet table in the folder that the cluster shares.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import plaint
from plaint.llm import decontaminate, neardup, packing, phrases, quality
from plaint.llm.batches import staged
from plaint.session import pin

# Workers may not have this folder on their path; send the functions themselves.
cloudpickle.register_pickle_by_value(plaint)

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def with_nodes(docs: DataFrame) -> DataFrame:
    """Documents with ``_node``, a number for each document: its id where that names one text.

    Rows without an id and ids that stand before several texts are named by id and text, above all
    ids. So each text has its own decision, and rows that are there twice have one."""
    rows = docs.select(*COLUMNS)
    key = F.xxhash64("text")
    named = F.shiftleft(F.lit(1).cast("bigint"), 62).bitwiseOR(
        F.xxhash64("doc_id", key).bitwiseAND(F.lit((1 << 62) - 1))
    )
    texts = rows.filter("doc_id is not null").groupBy("doc_id").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    several = texts.filter("low != high").select("doc_id", F.lit(True).alias("_several"))
    # Usually there is none: then no document is moved for this.
    if several.isEmpty():
        return rows.withColumn("_node", F.when(F.col("doc_id").isNull(), named).otherwise(F.col("doc_id")))
    asked = rows.join(several, "doc_id", "left")
    own = F.col("doc_id").isNotNull() & F.col("_several").isNull()
    return asked.select(*COLUMNS, F.when(own, F.col("doc_id")).otherwise(named).alias("_node"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the votes of labelled neighbours do not reject."""
    labels = pin(spark).read.parquet(f"{sf_dir}/labels.parquet")
    judged = quality.quality_scores(docs, labels, keep=COLUMNS)
    return judged.filter("predicted = 1").select(*COLUMNS)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Rows without an id are grouped like all others and come after those that have one. A row that is
    there twice stays once; rows without id and words, which nothing tells apart, all stay."""
    nodes = with_nodes(docs)
    judged = neardup.near_duplicates(nodes, doc_id="_node")
    one = judged.dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("_node"), "kept", "n_shingles")
    kept = nodes.join(one, "_node").filter("kept")
    blank = F.col("doc_id").isNull() & (F.col("n_shingles") == 0)
    known = kept.filter(~blank).dropDuplicates(["_node"])
    return known.unionByName(kept.filter(blank)).select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that recur; a text that loses nothing stays as it is."""
    # By id and text, so that no text gets what is left of another one under its id.
    cut = phrases.remove_repeats(docs, with_text=True).select("doc_id", "text_key", "kept_text")
    cut = cut.dropDuplicates(["doc_id", "text_key"]).withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.xxhash64("text").eqNullSafe(F.col("_key"))
    judged = docs.select(*COLUMNS).join(cut, same, "left")
    text = F.coalesce("kept_text", "text")
    lost = F.col("kept_text").isNotNull()
    return judged.select(
        "doc_id",
        text.alias("text"),
        "lang",
        "source",
        F.when(lost, F.length(text).cast("bigint")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage beyond the contract's share. The text alone decides,
    so each row is judged by its own, whatever its id."""
    benchmark = pin(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    nodes = with_nodes(docs)
    judged = decontaminate.contamination(nodes, benchmark, doc_id="_node").filter("contaminated")
    dirty = judged.select(F.col("doc_id").alias("_node")).distinct()
    return nodes.join(dirty, "_node", "left_anti").select(*COLUMNS)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return packing.pack_sequences(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("minhash near dedup", minhash_near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", sequence_packing),
]

# The first stage is a fitted model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each result is written before the next begins."""
    docs = pin(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
