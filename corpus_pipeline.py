"""From raw documents to packed training sequences, a stage at a time.

Each stage works on all that the one before kept; what it returns is written as Parquet
to the folder that driver and executors share, and read back as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerstone.llm import decontamination, line_dedup, ngram_join, packing, toxicity
from ledgerstone.llm.common import release, stored
from ledgerstone.llm.queries import table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal regression calls toxic go."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def without_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in the last one only; n_chars follows the text."""
    return line_dedup.deduplicated(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document with the smallest doc_id stays."""
    return ngram_join.representatives(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, re-parameterised or not, go."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, as op1 returns them."""
    return packing.digests(packing.pack(docs))


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_common_lines),
    ("ngram_join", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: SQL cannot express the learned and tokenised stages; tests hold the stages, one by one, against brute force or by what they must keep.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
        release(spark)
    return docs


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
