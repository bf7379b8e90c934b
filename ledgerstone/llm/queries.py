"""One registered query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerstone.llm import curve_search, decontamination, hard_negatives, licences, line_dedup, merge_encoding, ngram_join, packing, passages, quality, spelling, suffix_dedup, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack(table(spark, sf_dir, "documents")))


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(table(spark, sf_dir, "documents"))


ORACLES["op4_line_dedup"] = line_dedup.ORACLE


@query
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


@query
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked(table(spark, sf_dir, "documents"))


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.graded(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scanned(table(spark, sf_dir, "documents"))


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


ORACLES["op3_licences"] = licences.ORACLE
ORACLES["op8_decontamination"] = decontamination.ORACLE


@query
def op5_curve_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve_search.nearest(table(spark, sf_dir, "embeddings"))


@query
def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op11_merge_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_encoding.digests(merge_encoding.decode(merge_encoding.encode(table(spark, sf_dir, "documents"))))


@query
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.grouped(table(spark, sf_dir, "documents"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))
