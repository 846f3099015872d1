"""Corpus pipeline: quality rules, toxicity, near duplicates, pseudonyms, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``documents``.  ``run`` writes each stage as Parquet to the shared folder
and reads it again as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepframe.llm.common import bitmap_flag, cut_lineage, load, scratch_path
from prepframe.llm.jaccard import similarity_components
from prepframe.llm.packing import pack
from prepframe.llm.pii import pseudonymise
from prepframe.llm.quality import apply_cascade
from prepframe.llm.tokens import tokenizer_path
from prepframe.llm.toxicity import keep_clean

# Near duplicates of the pipeline: word shingles and least Jaccard similarity in percent.
SHINGLE_WORDS, SIMILARITY = 5, 80

# Toxicity is a learnt model: SQL cannot express the rows.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return apply_cascade(docs).where("kept").select(docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learnt from the labels among them, does not reject."""
    return keep_clean(docs, load(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every near-duplicate group; repeated rows once."""
    groups = cut_lineage(similarity_components(docs, width=SHINGLE_WORDS, percent=SIMILARITY))
    gone = groups.where("doc_id != component_id").select(F.col("doc_id").alias("_id")).distinct()
    twice = groups.groupBy(F.col("doc_id").alias("_id")).agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("_id")
    # Only rows that a bitmap of these ids lets through are shuffled; all others stay where they are.
    marked = bitmap_flag(docs, "doc_id", cut_lineage(gone.union(twice)))
    some = marked.where("_maybe").drop("_maybe").join(gone, F.col("doc_id") == F.col("_id"), "left_anti")
    some = some.withColumn("_h", F.xxhash64("text")).dropDuplicates(["doc_id", "_h"]).drop("_h")
    return marked.where("NOT _maybe").drop("_maybe").union(some)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets replaced by pseudonyms of the same format (and length)."""
    return pseudonymise(docs).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of every document with their places in sequences of 2048 tokens."""
    return pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality),
    ("toxicity", toxicity),
    ("ngram_jaccard_join", near_duplicates),
    ("pii", pii),
    ("best_fit_packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``."""
    docs = load(spark, sf_dir, "documents")
    out = scratch_path(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{out}/{name}")
        docs = spark.read.parquet(f"{out}/{name}")
    return docs
