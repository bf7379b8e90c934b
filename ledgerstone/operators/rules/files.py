"""Rules about files and schemas."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

Spec = Mapping[str, Any]


def small_files(files: DataFrame, spec: Spec, as_of: datetime) -> DataFrame:
    """Files below the least size. ``files`` holds path, size, modified_at and sha256."""
    return _bad(files.where(F.col("size") < spec["min"]), spec)


def old_files(files: DataFrame, spec: Spec, as_of: datetime) -> DataFrame:
    """Files last changed longer ago than allowed."""
    age = F.unix_seconds(F.lit(as_of).cast("timestamp")) - F.unix_seconds(F.col("modified_at").cast("timestamp"))
    return _bad(files.where(age > spec["max_hours"] * 3600), spec)


def repeated_files(files: DataFrame, spec: Spec, as_of: datetime) -> DataFrame:
    """Files whose content was delivered before, or twice now (all but the first path)."""
    first = files.groupBy("sha256").agg(F.min("path").alias("first_path"))
    known = spec.get("ledger")
    marked = files.join(first, "sha256")
    twice = marked.where(F.col("path") != F.col("first_path"))
    if known is None:
        return _bad(twice, spec)
    before = marked.where(F.col("path") == F.col("first_path")).join(known.select("sha256"), "sha256", "left_semi")
    return _bad(twice.unionByName(before), spec)


def _bad(files: DataFrame, spec: Spec) -> DataFrame:
    return files.select(F.lit(spec["type"]).alias("rule_type"), F.col("path").alias("record_key"))


FILE_RULES: dict[str, Callable[[DataFrame, Spec, datetime], DataFrame]] = {
    "FILE_SIZE_MIN": small_files,
    "FILE_MODIFICATION_AGE": old_files,
    "DUPLICATE_FILE_HASH": repeated_files,
}


def _wrong_count(schema: StructType, spec: Spec) -> list[str]:
    return [] if len(schema.fields) == spec["count"] else [f"{len(schema.fields)} columns"]


def _schema_differences(schema: StructType, spec: Spec) -> list[str]:
    want = {f.name: f.dataType.simpleString() for f in spec["schema"].fields}
    have = {f.name: f.dataType.simpleString() for f in schema.fields}
    return sorted(f"{n}: {want.get(n)} -> {have.get(n)}" for n in want.keys() | have.keys() if want.get(n) != have.get(n))


def _forbidden(schema: StructType, spec: Spec) -> list[str]:
    return sorted(f.name for f in schema.fields if f.name.lower() in {c.lower() for c in spec["columns"]})


SCHEMA_RULES: dict[str, Callable[[StructType, Spec], list[str]]] = {
    "EXACT_COLUMN_COUNT": _wrong_count,
    "AUTHORITATIVE_SCHEMA_MATCH": _schema_differences,
    "COLUMN_MUST_NOT_EXIST": _forbidden,
    "PROHIBITED_RAW_FIELDS_IN_AI_OUTPUT": _forbidden,
}


def schema_violations(spark: SparkSession, schema: StructType, specs: Sequence[Spec]) -> DataFrame:
    """Schema differences as rows. Schemas are metadata, so this reads no data."""
    rows = [(s["type"], difference) for s in specs for difference in SCHEMA_RULES[s["type"]](schema, s)]
    return spark.createDataFrame(rows, "rule_type string, record_key string")
