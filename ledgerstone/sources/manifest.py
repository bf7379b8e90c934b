"""Batch manifests, file fingerprints and their reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SOURCE_TYPES = ("CDC", "EVENT", "FILE")


def artifacts(watermarks: DataFrame, source_type: str, path: Column | None = None) -> DataFrame:
    """Manifest entries of the landed data sets of each batch."""
    where = F.concat_ws("/", F.lit(source_type.lower()), "dataset", F.concat(F.lit("batch-"), "batch_id", F.lit(".jsonl")))
    return watermarks.select(
        "batch_id",
        (where if path is None else path).alias("path"),
        "record_count",
        F.lit(source_type).alias("source_type"),
        F.col("dataset").alias("source_dataset"),
        *[c for c in watermarks.columns if c.startswith(("min_", "max_")) or c == "topics"],
    )


def manifest(entries: DataFrame) -> DataFrame:
    """One row per batch. A batch lists one entry per data set and file, never rows."""
    counts = [
        F.coalesce(F.sum(F.when(F.col("source_type") == t, F.col("record_count"))), F.lit(0)).alias(t) for t in SOURCE_TYPES
    ]
    listed = F.sort_array(F.collect_list(F.struct(*[c for c in entries.columns if c != "batch_id"])))
    return (
        entries.groupBy("batch_id")
        .agg(
            F.count("*").alias("artifact_count"),
            F.sum("record_count").alias("total_records"),
            *counts,
            listed.alias("artifacts"),
        )
        .withColumn("source_record_counts", F.struct(*SOURCE_TYPES))
        .withColumn("manifest_version", F.lit("1.0"))
        .drop(*SOURCE_TYPES)
    )


def file_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and SHA-256 of every file; each file is hashed by one task."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def file_record_counts(rows: DataFrame) -> DataFrame:
    """Records per file of a frame read from files."""
    return rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("record_count"))


def unprocessed(files: DataFrame, ledger: DataFrame, name: str = "name") -> DataFrame:
    """Files whose landing name is not in the ledger of promoted files."""
    return files.join(ledger.select(name), name, "left_anti")


def repeated_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose content hash was delivered before."""
    return files.join(ledger.select("sha256"), "sha256", "left_semi")


def reconcile(listed: DataFrame, observed: DataFrame) -> DataFrame:
    """Differences between listed and observed files: path, reason, expected, actual.

    Both sides hold one row per path.
    """
    want = listed.select("path", F.struct("record_count", "sha256").alias("want"))
    have = observed.select("path", F.struct("record_count", "sha256").alias("have"))
    both = want.join(have, "path", "full")

    def issue(condition: Column, reason: str, expected: Column, actual: Column) -> Column:
        return F.when(
            condition,
            F.struct(F.lit(reason).alias("reason"), expected.cast("string").alias("expected"), actual.cast("string").alias("actual")),
        )

    w, h, nothing = F.col("want"), F.col("have"), F.lit(None)
    issues = F.array_compact(
        F.array(
            issue(h.isNull(), "FILE_MISSING", w["record_count"], nothing),
            issue(w.isNull(), "FILE_NOT_LISTED", nothing, h["record_count"]),
            issue(w["record_count"] != h["record_count"], "RECORD_COUNT", w["record_count"], h["record_count"]),
            issue(w["sha256"] != h["sha256"], "SHA256", w["sha256"], h["sha256"]),
            issue(w.isNotNull() & (w["record_count"].isNull() | w["sha256"].isNull()), "REQUIRED_VALUE", nothing, nothing),
        )
    )
    return both.select("path", F.explode(issues).alias("i")).select("path", "i.*")
