"""Readers of the landing area, as batch or stream.

Streams use Spark's file source: its checkpoint remembers every file, existing
files included, so each is read once; ``trigger(availableNow=True)`` drains what is there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from ledgerstone.sources import reading

INVALID_TRANSPORT = (
    "topic string, partition bigint, offset bigint, timestamp bigint, timestamp_type bigint, key string,"
    " parse_error string, raw_value string, captured_at string, batch_id string"
)
ARTIFACT = (
    "struct<path: string, record_count: bigint, sha256: string, native_format: string, source_type: string,"
    " source_dataset: string, min_kafka_offset: bigint, max_kafka_offset: bigint, min_source_lsn: bigint,"
    " max_source_lsn: bigint, topics: array<string>>"
)
MANIFEST = (
    "manifest_version string, batch_id string, created_at string, heartbeat_status string,"
    f" artifacts array<{ARTIFACT}>, artifact_count bigint, total_records bigint,"
    " source_record_counts struct<CDC: bigint, EVENT: bigint, FILE: bigint>"
)


def _reader(spark: SparkSession, streaming: bool, files_per_batch: int | None = None):
    if not streaming:
        return spark.read
    reader = spark.readStream
    return reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader


def envelope_schema(record: StructType, payload: StructType) -> StructType:
    """Schema of a landed envelope around a record of the given type."""
    base = StructType.fromDDL(
        "topic string, partition bigint, offset bigint, timestamp bigint, timestamp_type bigint, key string"
    )
    tail = StructType.fromDDL("load_type string, captured_at string, batch_id string")
    return StructType(
        [*base.fields, StructField("payload", payload), StructField("record", record), *tail.fields]
    )


def cdc_schema(record: StructType) -> StructType:
    payload = StructType.fromDDL(
        "op string, ts_ms bigint, source struct<schema: string, table: string, lsn: bigint, snapshot: string>"
    )
    return envelope_schema(record, payload)


def event_schema(record: StructType) -> StructType:
    payload = StructType.fromDDL(
        "event_id string, event_type string, event_version string, occurred_at string, producer string,"
        " correlation_id string, source_dataset string, load_type string"
    )
    return envelope_schema(record, payload)


def string_schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def json_lines(spark, path: str, schema: StructType, streaming: bool = False, files_per_batch: int | None = None) -> DataFrame:
    return _reader(spark, streaming, files_per_batch).schema(schema).json(path)


def csv_rows(spark, path: str, columns: list[str]) -> DataFrame:
    """CSV rows by the names in each file's own header, every column a string; see ``reading.csv_rows``."""
    return reading.csv_rows(reading.text_lines(spark, path), columns)


def manifests(spark, path: str, streaming: bool = False) -> DataFrame:
    return _reader(spark, streaming).schema(MANIFEST).option("multiLine", "true").json(path)


def invalid_transport(spark, path: str, streaming: bool = False) -> DataFrame:
    return _reader(spark, streaming).schema(INVALID_TRANSPORT).json(path)
