"""The corpus pipeline: documents in, packed training sequences out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm import common, decontaminate, line_dedup, ngram_join, packing, quality_rules
from cohortkit.session import materialize


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the isolation forest reject go."""
    return quality_rules.keep_good(docs, common.table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines of five documents or more stay in one of them; n_chars follows the text."""
    return line_dedup.drop_repeated_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, by five-word shingles at a similarity of 0.8."""
    return ngram_join.keep_one_per_group(docs, n=5, percent=80)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontaminate.drop_leaks(docs, common.table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 1024 tokens, every window with the sources' proportions, with their ids."""
    return packing.pack(docs, with_ids=True)


def _stage(run):
    """A stage over whole texts: what its tasks hold of them at once is bounded."""
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.small_batches(spark)
        return run(spark, docs, sf_dir)
    return stage


STAGES = [(name, _stage(run)) for name, run in [
    ("quality_rules", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]]

#: The forest, the tokenizer and the LSH have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read by the next."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
