"""Rescued data and additive schema change for JSON lines and string columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType

RESCUED = "_rescued_data"


def _typed(text: Column, kind: DataType) -> Column:
    if isinstance(kind, StringType):
        return text
    if isinstance(kind, (StructType, ArrayType, MapType)):
        return F.from_json(text, kind)
    return text.try_cast(kind)


def _object(entries: Column) -> Column:
    """JSON text of entries; a key may repeat, as it may in the message itself."""

    def member(entry: Column) -> Column:
        text = F.to_json(F.create_map(entry["key"], entry["value"]))
        return F.substring(text, F.lit(2), F.length(text) - 2)

    return F.concat(F.lit("{"), F.array_join(F.transform(entries, member), ","), F.lit("}"))


def with_rescued(lines: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """Typed columns of JSON lines; unknown keys and values of the wrong type go to one JSON column."""
    raw = F.from_json(F.col(value), MapType(StringType(), StringType()))
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    opened = lines.withColumn("_raw", raw)

    def text(name: str) -> Column:
        return F.try_element_at(F.col("_raw"), F.lit(name))

    stray = F.map_filter("_raw", lambda k, v: ~F.array_contains(known, k))
    wrong = [
        F.when(
            text(f.name).isNotNull() & _typed(text(f.name), f.dataType).isNull(),
            F.struct(F.lit(f.name).alias("key"), text(f.name).alias("value")),
        )
        for f in schema.fields
        if not isinstance(f.dataType, StringType)
    ]
    entries = F.map_entries(stray)
    if wrong:
        entries = F.concat(entries, F.array_compact(F.array(*wrong)))
    unread = F.col("_raw").isNull() & (F.trim(F.col(value)) != "")
    rescued = F.when(unread, F.col(value)).when(F.size(entries) > 0, _object(entries))
    rest = [c for c in lines.columns if c != value]
    return opened.select(
        *rest, *[_typed(text(f.name), f.dataType).alias(f.name) for f in schema.fields], rescued.alias(RESCUED)
    )


def inferred(spark: SparkSession, path: str, sample: float = 1.0) -> StructType:
    """JSON schema of all records at ``path``; a smaller ``sample`` may miss rare columns."""
    return spark.read.option("samplingRatio", sample).json(path).schema


def evolved(stored: StructType, seen: StructType) -> tuple[StructType, list[str]]:
    """The stored schema plus new columns (nullable, at the end). Known columns keep their type.

    A stream cannot change its schema while it runs: compare at start, extend the
    stored schema and restart from the same checkpoint.
    """
    names = {f.name.lower() for f in stored.fields}
    new = [StructField(f.name, f.dataType, True) for f in seen.fields if f.name.lower() not in names]
    return StructType([*stored.fields, *new]), [f.name for f in new]
