"""The corpus pipeline: five stages over ``documents``, each on all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's result to the
shared folder and reads it back for the next.  Rejected documents go, kept ones keep their columns,
and ``n_chars`` follows a text that was shortened.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakframe.llm import decontaminate, lines, near_dups, packing, quality
from cloakframe.llm.stage import bounded_batches, saved


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _stage(function):
    """The stage with Arrow batches of bounded size."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return function(spark, docs, sf_dir)

    return run_stage


@_stage
def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within their language's limit."""
    rated = quality.rate(docs, _table(spark, sf_dir, "labels"))
    return rated.where("kept").select(docs.columns)


@_stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without chunks of lines that occur earlier; one that loses its whole text goes."""
    cut = lines.remove_repeated_lines(docs)
    left = cut.where("n_removed = 0 or trim(kept_text) <> ''")
    return left.withColumn("text", F.col("kept_text")).withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity of 0.8 or more)."""
    return near_dups.drop_near_duplicates(docs)


@_stage
def benchmark_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


@_stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_filter),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_filter),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: No SQL states the language model or the packing; the tests compare with brute force.
ORACLE_SQL = None
