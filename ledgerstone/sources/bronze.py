"""Source-aligned Bronze rows: the record's own columns plus control columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ledgerstone.sources import landing, reading, registry
from ledgerstone.sources.envelope import operation
from ledgerstone.sources.rescue import RESCUED

INCREMENTAL_FILE = r"-[0-9]{8}T[0-9]{6}Z\.csv$"


def _rescued(source: DataFrame) -> Column:
    return (F.col(RESCUED) if RESCUED in source.columns else F.lit(None).cast("string")).alias(RESCUED)


def _file_columns(with_size: bool = False) -> list[Column]:
    columns = [
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_modification_time").alias("_source_file_modified_at"),
    ]
    return [*columns, F.col("_metadata.file_size").alias("_source_file_size")] if with_size else columns


def _transport(key_name: str) -> list[Column]:
    return [
        F.col("load_type").alias("_load_type"),
        F.col("topic").alias("_topic"),
        F.col("partition").cast("bigint").alias("_kafka_partition"),
        F.col("offset").cast("bigint").alias("_kafka_offset"),
        F.col("key").alias(key_name),
        F.col("batch_id").alias("_batch_id"),
        F.col("captured_at").try_cast("timestamp").alias("_captured_at"),
    ]


def cdc_rows(source: DataFrame, dataset: str, ingested_at: Column | None = None, files: bool = True) -> DataFrame:
    """Database changes: ``record.*``, operation, log position and transport columns."""
    now = F.current_timestamp() if ingested_at is None else ingested_at
    return source.select(
        "record.*",
        F.lit(dataset).alias("_source_dataset"),
        operation(F.col("payload.op")).alias("_operation"),
        F.col("payload.source.snapshot").cast("string").alias("_snapshot_state"),
        F.col("payload.source.lsn").cast("bigint").alias("_source_lsn"),
        F.timestamp_millis(F.col("payload.ts_ms").cast("bigint")).alias("_commit_ts"),
        *_transport("_record_key"),
        _rescued(source),
        *(_file_columns() if files else []),
        now.alias("_ingested_at"),
    )


def event_rows(source: DataFrame, dataset: str, ingested_at: Column | None = None, files: bool = True) -> DataFrame:
    """Business events: ``record.*``, event identity and transport columns."""
    now = F.current_timestamp() if ingested_at is None else ingested_at
    identity = ["event_id", "event_type", "event_version", "producer", "correlation_id"]
    return source.select(
        "record.*",
        F.lit(dataset).alias("_source_dataset"),
        *[F.col(f"payload.{c}").alias(f"_{c}") for c in identity],
        F.col("payload.occurred_at").try_cast("timestamp").alias("_occurred_at"),
        *_transport("_event_key"),
        _rescued(source),
        *(_file_columns() if files else []),
        now.alias("_ingested_at"),
    )


def file_load_type(path: Column) -> Column:
    return F.when(path.rlike(INCREMENTAL_FILE), "INCREMENTAL").otherwise("INITIAL")


def file_batch(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)\.csv$", 1)


def file_rows(source: DataFrame, dataset: str, ingested_at: Column | None = None) -> DataFrame:
    """CSV rows with the batch named after their file."""
    now = F.current_timestamp() if ingested_at is None else ingested_at
    path = F.col("_metadata.file_path")
    return source.select(
        *[c for c in source.columns if c != "_metadata"],
        F.lit(dataset).alias("_source_dataset"),
        file_load_type(path).alias("_load_type"),
        file_batch(path).alias("_batch_id"),
        *_file_columns(with_size=True),
        now.alias("_ingested_at"),
    )


def manifest_rows(source: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    now = F.current_timestamp() if ingested_at is None else ingested_at
    return source.select("*", *_file_columns(), now.alias("_ingested_at"))


def landed_lines(spark: SparkSession, root: str, table: str, streaming: bool = False, files_per_batch: int | None = None) -> DataFrame:
    """Lines of a registered data set's files."""
    kind, _, dataset = table.partition("_")
    return reading.text_lines(spark, registry.landing_path(root, kind, dataset), streaming, files_per_batch)


def opened(lines: DataFrame, table: str, record: StructType, ingested_at: Column | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(Bronze rows with what their schema did not expect, lines that cannot be read) of a data set's lines.

    JSON lines may be a stream. CSV lines are a batch or one micro-batch of a stream;
    none of them is unreadable.
    """
    kind, _, dataset = table.partition("_")
    if kind == "file":
        return file_rows(reading.csv_rows(lines, record.fieldNames()), dataset, ingested_at), None
    make, envelope = (cdc_rows, landing.cdc_schema) if kind == "cdc" else (event_rows, landing.event_schema)
    rows = reading.json_rows(lines, envelope(record))
    good, bad = (rows.where(F.col(reading.UNREADABLE).isNull()), rows.where(F.col(reading.UNREADABLE).isNotNull()))
    return make(good, dataset, ingested_at), bad


def tables(
    spark: SparkSession, root: str, records: Mapping[str, StructType], streaming: bool = False, ingested_at: Column | None = None
) -> dict[str, DataFrame]:
    """One Bronze frame per registered data set whose record schema is given, rescued data included.

    Streams of CSV data sets take their names from each file, micro-batch by micro-batch,
    and are not among the streaming frames: ``streaming.ingestion`` drives them.
    """
    return {
        table: opened(landed_lines(spark, root, table, streaming), table, records[table.partition("_")[2]], ingested_at)[0]
        for table in registry.bronze_tables()
        if table.partition("_")[2] in records and not (streaming and table.startswith("file_"))
    }


def _refused(frame: DataFrame, kind: str, dataset: Column, reason: Column, data: Column, file: Column, batch: Column, at: Column) -> DataFrame:
    return frame.select(
        F.lit(kind.upper()).alias("source_type"),
        dataset.cast("string").alias("source_dataset"),
        reason.alias("failure_reason"),
        data.alias("rescued_data"),
        file.alias("source_file"),
        batch.alias("batch_id"),
        at.alias("quarantined_at"),
    )


def rescued_rows(bronze: DataFrame, kind: str, dataset: str, at: Column | None = None) -> DataFrame:
    """Bronze rows that kept something their schema did not expect."""
    now = F.current_timestamp() if at is None else at
    held = bronze.where(F.col(RESCUED).isNotNull())
    return _refused(
        held, kind, F.lit(dataset), F.lit("SCHEMA_RESCUED_DATA"), F.col(RESCUED), F.col("_source_file"), F.col("_batch_id"), now
    )


def unreadable_lines(bad: DataFrame, kind: str, dataset: str, at: Column | None = None) -> DataFrame:
    """Lines that hold no JSON object, whole, in the same shape as rescued rows."""
    now = F.current_timestamp() if at is None else at
    path, none = F.col("_metadata.file_path"), F.lit(None).cast("string")
    return _refused(bad, kind, F.lit(dataset), F.lit("UNREADABLE_LINE"), F.col(reading.UNREADABLE), path, none, now)


def refused_rows(rows: DataFrame, bad: DataFrame | None, table: str, at: Column | None = None) -> DataFrame:
    """All that a data set sends to the ingestion quarantine."""
    kind, _, dataset = table.partition("_")
    rescued = rescued_rows(rows, kind, dataset, at)
    return rescued if bad is None else rescued.unionByName(unreadable_lines(bad, kind, dataset, at))


def refused_messages(invalid: DataFrame, kind: str, file: Column | None = None, at: Column | None = None) -> DataFrame:
    """Invalid transport in the same shape as rescued rows."""
    now = F.current_timestamp() if at is None else at
    path = F.lit(None).cast("string") if file is None else file
    return _refused(
        invalid, kind, F.lit(None), F.col("parse_error"), F.col("raw_value"), path, F.col("batch_id"), now
    )


def ingestion_quarantine(parts: Sequence[DataFrame]) -> DataFrame:
    """One stream or table of everything refused at ingestion."""
    return reduce(DataFrame.unionByName, parts)


def refused_in_lines(lines: DataFrame, table: str, record: StructType, at: Column | None = None) -> DataFrame:
    """All that a data set's JSON lines send to the ingestion quarantine, without its Bronze rows: one pass over the lines."""
    kind, _, dataset = table.partition("_")
    envelope = landing.cdc_schema if kind == "cdc" else landing.event_schema
    rows = reading.json_rows(lines, envelope(record))
    held = rows.where(F.col(reading.UNREADABLE).isNotNull() | F.col(RESCUED).isNotNull())
    unread = F.col(reading.UNREADABLE).isNotNull()
    return _refused(
        held, kind, F.lit(dataset), F.when(unread, "UNREADABLE_LINE").otherwise("SCHEMA_RESCUED_DATA"), F.coalesce(reading.UNREADABLE, RESCUED),
        F.col("_metadata.file_path"), F.when(~unread, F.col("batch_id")), F.current_timestamp() if at is None else at,
    )


def landing_quarantine(spark: SparkSession, root: str, records: Mapping[str, StructType], at: Column | None = None) -> DataFrame:
    """Everything refused in the landing area: each data set whose record schema is given, and both kinds of invalid transport."""
    parts = []
    for table in registry.bronze_tables():
        dataset = table.partition("_")[2]
        if dataset not in records:
            continue
        lines = landed_lines(spark, root, table)
        if table.startswith("file_"):
            parts.append(refused_rows(*opened(lines, table, records[dataset], at), table, at))
        else:
            parts.append(refused_in_lines(lines, table, records[dataset], at))
    for kind in ("cdc", "event"):
        invalid = landing.invalid_transport(spark, f"{root}/quarantine/{kind}")
        parts.append(refused_messages(invalid, kind, F.col("_metadata.file_path"), at))
    return ingestion_quarantine(parts)
