"""Additive schema change: a ledger of new columns that a reader takes up when it starts.

A stream cannot change its schema while it runs. What its schema does not know is
rescued, so nothing is lost; when the stream starts again, columns seen in rescued data
or in new CSV headers are added to the ledger (nullable, at the end, known columns keep
their type) and the same checkpoint goes on with the wider schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, StructField, StructType

from ledgerstone.sources.rescue import evolved

COLUMNS = "table string, name string, type string, ordinal int"


def seen_in_rescued(rescued: DataFrame, column: str = "rescued_data", member: str | None = "record") -> StructType:
    """Schema of rescued JSON objects, or of one member of them, inferred over all of them in one aggregate.

    Kinds that differ between rows, nulls and dates become strings.
    """
    at = "$" if member is None else f"$['{member}']"
    part = F.try_variant_get(F.try_parse_json(column), at, "variant")
    objects = F.when(F.schema_of_variant(part).startswith("OBJECT"), part)
    kind = rescued.select(objects.alias("part")).agg(F.schema_of_variant_agg("part").alias("kind")).first()["kind"]
    if kind is None or not kind.startswith("OBJECT<"):
        return StructType([])
    text = kind.replace("OBJECT<", "STRUCT<").replace("VARIANT", "STRING").replace("VOID", "STRING")
    found = StructType.fromDDL(f"s {text}")["s"].dataType
    return StructType([StructField(f.name, _plain(f.dataType)) for f in found.fields])


def _plain(kind: DataType) -> DataType:
    """Decimals of a sample would be too narrow for the next value."""
    return StructType.fromDDL("x double")["x"].dataType if kind.typeName() == "decimal" else kind


class SchemaLedger:
    """Columns added to tables so far: an append-only table of one row per column."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def _rows(self, table: str) -> DataFrame | None:
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
            return None
        return self.spark.read.schema(COLUMNS).parquet(self.path).where(F.col("table") == table)

    def schema(self, table: str, declared: StructType) -> StructType:
        """The declared schema and the columns added since."""
        rows = self._rows(table)
        if rows is None:
            return declared
        # one row per added column of one table; repeated appends of one column count once
        first = rows.groupBy("name").agg(F.min(F.struct("ordinal", "type")).alias("f"))
        added = first.agg(F.sort_array(F.collect_list(F.struct("f.ordinal", "name", "f.type"))).alias("columns")).first()["columns"]
        fields = [StructField(c["name"], StructType.fromDDL(f"x {c['type']}")["x"].dataType) for c in added]
        return evolved(declared, StructType(fields))[0]

    def extend(self, table: str, declared: StructType, seen: StructType) -> list[str]:
        """Add the columns of ``seen`` that the table does not have; returns their names."""
        known = self.schema(table, declared)
        wider, new = evolved(known, seen)
        if new:
            rows = [(table, n, wider[n].dataType.simpleString(), len(known.fields) + i) for i, n in enumerate(new)]
            self.spark.createDataFrame(rows, COLUMNS).write.mode("append").parquet(self.path)
        return new
