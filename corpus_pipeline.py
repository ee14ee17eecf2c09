"""From raw documents to packed sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costalloc.llm import decontam, packing, quality, simhash, substrings
from costalloc.llm.common import materialize, ship, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules, or score below the threshold, go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays."""
    return simhash.drop_near_duplicates(docs, shingle=3, distance=3).select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of words are cut out; a document of which nothing is left goes. n_chars is that of the new text."""
    cut = substrings.remove_repeats(docs, size=13)
    n_chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    left = cut.where("n_removed = 0 OR n_removed < n_words")
    return left.withColumn("n_chars", n_chars.cast("bigint")).select(*COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"), coverage=0.5, least=5).select(*COLUMNS)


def hilbert_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens, with their ids."""
    return packing.pack(docs, sequence=2048)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", hilbert_packing),
]

# The models and the tokenizer cannot be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the table documents; each stage's rows are written and read again."""
    ship(spark)
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = materialize(stage(spark, rows, sf_dir), name.replace(" ", "-"))
    return rows
