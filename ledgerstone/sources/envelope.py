"""Transport messages: classify, name, split and measure them.

A message is a row with topic, partition, offset, timestamp, key, ``value`` (the
raw text), captured_at and batch_id. The known fields are read by one native
parse per message, so nothing runs in Python and one bad message cannot fail a job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

VALID, TOMBSTONE = "VALID", "TOMBSTONE"
INVALID_JSON = "INVALID_JSON"
UNCLASSIFIED_CDC = "UNCLASSIFIED_CDC_ENVELOPE"
UNCLASSIFIED_EVENT = "UNCLASSIFIED_EVENT_ENVELOPE"

# Change operation codes.
OPERATIONS = {"r": "SNAPSHOT", "c": "INSERT", "u": "UPDATE", "d": "DELETE"}


_ENVELOPE = "_envelope"
_CDC_FIELDS = (
    "op string, ts_ms string, source struct<schema: string, table: string, lsn: string, snapshot: string>,"
    " after string, before string"
)
_EVENT_FIELDS = "source_dataset string, load_type string, payload string"


def _field(name: str) -> Column:
    return F.col(f"{_ENVELOPE}.{name}")


def _filled(column: Column) -> Column:
    return F.when(column != "", column)


def slug(column: Column, unknown: str = "unknown_dataset") -> Column:
    """A data set name of lower-case letters, digits and underscores."""
    name = F.btrim(F.regexp_replace(F.lower(column), "[^a-z0-9_]+", "__"), F.lit("_"))
    return F.when(name != "", name).otherwise(F.lit(unknown))


def operation(code: Column) -> Column:
    chain = F.lit("UNKNOWN")
    for letter, name in OPERATIONS.items():
        chain = F.when(code == letter, name).otherwise(chain)
    return chain


def _is_object(column: Column) -> Column:
    return F.coalesce(F.ltrim(column).startswith("{"), F.lit(False))


def _not_empty(column: Column) -> Column:
    """Of valid JSON: an object with at least one member."""
    return _is_object(column) & ~column.rlike(r"^\s*\{\s*\}\s*$")


def classify_cdc(messages: DataFrame) -> DataFrame:
    """Add status, data set, record image, load type and change columns to database messages."""
    value = F.col("value")
    opened = messages.withColumn(_ENVELOPE, F.from_json("value", _CDC_FIELDS))
    table = _filled(_field("source.table"))
    qualified = F.concat_ws(".", _filled(_field("source.schema")), table)
    status = (
        F.when(F.coalesce(value, F.lit("")) == "", TOMBSTONE)
        .when(F.try_parse_json(value).isNull(), INVALID_JSON)
        .when(~_not_empty(value), TOMBSTONE)
        .when(table.isNull(), UNCLASSIFIED_CDC)
        .otherwise(VALID)
    )
    after, before, code = _field("after"), _field("before"), _field("op")
    return opened.withColumns(
        {
            "status": status,
            "dataset": slug(F.coalesce(_filled(qualified), _filled(F.col("topic")), F.lit("unknown_cdc"))),
            "record": F.when(_not_empty(after), after).otherwise(before),
            "load_type": F.when(code == "r", "INITIAL").otherwise("INCREMENTAL"),
            "_operation": operation(code),
            "_snapshot_state": _field("source.snapshot"),
            "_source_lsn": _field("source.lsn").try_cast("bigint"),
            "_commit_ts": F.timestamp_millis(_field("ts_ms").try_cast("bigint")),
        }
    ).drop(_ENVELOPE)


def classify_events(messages: DataFrame) -> DataFrame:
    """Add status, data set, record and load type to business events."""
    value = F.col("value")
    opened = messages.withColumn(_ENVELOPE, F.from_json("value", _EVENT_FIELDS))
    body, dataset = _field("payload"), _filled(_field("source_dataset"))
    broken = (F.coalesce(value, F.lit("")) != "") & F.try_parse_json(value).isNull()
    status = (
        F.when(broken, INVALID_JSON)
        .when(dataset.isNull() | ~_is_object(body), UNCLASSIFIED_EVENT)
        .otherwise(VALID)
    )
    return opened.withColumns(
        {
            "status": status,
            "dataset": slug(F.coalesce(dataset, _filled(F.col("topic")), F.lit("unknown_event"))),
            "record": body,
            "load_type": F.coalesce(_filled(_field("load_type")), F.lit("INCREMENTAL")),
        }
    ).drop(_ENVELOPE)


def valid(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("status") == VALID)


def invalid(classified: DataFrame) -> DataFrame:
    """Messages for the transport quarantine; tombstones carry no record and are dropped."""
    bad = classified.where(~F.col("status").isin(VALID, TOMBSTONE))
    kept = [c for c in ("topic", "partition", "offset", "timestamp", "timestamp_type", "key") if c in bad.columns]
    return bad.select(
        *kept,
        F.col("status").alias("parse_error"),
        F.when(F.col("status") == INVALID_JSON, F.col("value")).alias("raw_value"),
        "captured_at",
        "batch_id",
    )


def watermarks(classified: DataFrame) -> DataFrame:
    """Per data set and batch: record count, offset and log position bounds, and topics.

    Everything combines on the map side; topics of one data set are few.
    """
    lsn = "_source_lsn" if "_source_lsn" in classified.columns else None
    position = F.col(lsn) if lsn else F.lit(None).cast("bigint")
    return classified.groupBy("dataset", "batch_id").agg(
        F.count("*").alias("record_count"),
        F.min("offset").alias("min_kafka_offset"),
        F.max("offset").alias("max_kafka_offset"),
        F.min(position).alias("min_source_lsn"),
        F.max(position).alias("max_source_lsn"),
        F.sort_array(F.collect_set(_filled(F.col("topic")))).alias("topics"),
    )
