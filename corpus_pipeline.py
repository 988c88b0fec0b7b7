"""The corpus pipeline: stages over ``documents``, each calling one operator of ``ledgerline.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet to the
shared scratch folder and read back as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontaminate, line_dedup, mixing, ngram_jaccard, quality
from ledgerline.llm.common import staged, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_quality(docs, table(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated passages go; a document goes if all its lines do.  n_chars of a cut text is counted anew."""
    cut = line_dedup.drop_repeated_lines(docs.withColumn("__before", F.char_length("text")))
    cut = cut.where((F.col("__n_removed") == 0) | (F.col("__n_removed") < F.col("__n_lines")))
    after = F.char_length("text")
    n_chars = F.when(after < F.col("__before"), after.cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", n_chars).select(*docs.columns)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest doc_id."""
    return ngram_jaccard.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages, by the contamination rule, go; the others stay as they are."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document with the words that the mix takes of it."""
    return mixing.mix_sources(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("quality", good_quality),
    ("line_dedup", without_repeated_lines),
    ("near_duplicates", one_of_near_duplicates),
    ("decontaminate", decontaminated),
    ("mix_sources", mixed),
]

ORACLE_SQL = None  # training, hashing and seeded choices are not SQL; tests/llm compares stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
