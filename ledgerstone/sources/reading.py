"""Landed files read line by line: typed columns, what they cannot hold, lines that cannot be read.

Text is read once as lines with the file's metadata. JSON lines are opened by one parse
into a variant: each field of the expected schema is taken out with its type, and keys
that the schema does not know or values that do not fit their type stay, as JSON at
their place, in one rescued column. CSV files are read by the names in their own header:
an index holds the header of each file, files with one header form a group, and a group
is one native CSV read whose columns are then taken by name. Lines that hold no JSON
object, or repeat a key, are told apart, so they never become rows of nulls.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerstone.sources.rescue import RESCUED

VALUE, METADATA, UNREADABLE = "value", "_metadata", "_unreadable"
#: Where a row whose number of values differs from its header's keeps its whole line.
WHOLE_LINE = "_line"
CSV_OPTIONS = {"header": "true", "encoding": "UTF-8", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnPruning": "false"}


def text_lines(spark: SparkSession, path: str, streaming: bool = False, files_per_batch: int | None = None) -> DataFrame:
    """Lines of every file with the file's metadata, as batch or stream; blank lines are left out."""
    reader = spark.readStream if streaming else spark.read
    if streaming and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path).select(VALUE, METADATA).where(F.trim(VALUE) != "")


def _member(key: Column, value: Column) -> Column:
    """``"key":value`` as JSON text."""
    return F.regexp_extract(F.to_json(F.create_map(key, value)), r"(?s)^\{(.*)\}$", 1)


def _object(members: Column) -> Column:
    return F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))


class _Opened:
    """The columns of one object of a parsed line and the members that its schema cannot hold.

    What is used more than once is a column of its own, the objects inside first, so
    that plans stay as small as the schema: ``steps`` holds these columns by depth.
    """

    def __init__(self, path: str, schema: StructType, steps: list[dict[str, Column]], depth: int = 1) -> None:
        while len(steps) <= depth:
            steps.append({})
        name = f"{len(steps[0])}"
        steps[0][f"_held{name}"] = F.try_variant_get("_parsed", path, "map<string,variant>")
        self.held, self.members = F.col(f"_held{name}"), F.col(f"_members{name}")
        self.fields: list[Column] = []
        known = F.array(*[F.lit(f.name) for f in schema.fields]).cast("array<string>")
        unknown = F.filter(F.map_entries(self.held), lambda e: ~F.array_contains(known, e["key"]))
        parts = [F.transform(F.coalesce(unknown, F.array()), lambda e: _member(e["key"], e["value"]))]
        for f in schema.fields:
            at = f"{path}['{f.name}']"
            raw = F.try_variant_get("_parsed", at, "variant")
            there = raw.isNotNull() & ~F.is_variant_null(raw)
            if isinstance(f.dataType, StructType):
                inner = _Opened(at, f.dataType, steps, depth + 1)
                self.fields.append(F.when(inner.held.isNotNull(), F.struct(*inner.fields)).alias(f.name))
                nested = F.when(F.size(inner.members) > 0, F.concat(F.lit(f'"{f.name}":'), _object(inner.members)))
                lost = F.when(there & inner.held.isNull(), _member(F.lit(f.name), raw)).otherwise(nested)
            else:
                typed = F.try_variant_get("_parsed", at, f.dataType.simpleString())
                self.fields.append(typed.alias(f.name))
                lost = F.when(there & typed.isNull(), _member(F.lit(f.name), raw))
            parts.append(F.array(lost))
        steps[depth][f"_members{name}"] = F.array_compact(F.flatten(F.array(*parts)))


def json_rows(lines: DataFrame, schema: StructType) -> DataFrame:
    """The lines' other columns, the schema's fields, the rescued JSON and the line itself where it cannot be read."""
    steps: list[dict[str, Column]] = []
    opened = _Opened("$", schema, steps)
    rest = [c for c in lines.columns if c != VALUE]
    parsed = lines.withColumn("_parsed", F.try_parse_json(VALUE)).withColumns(steps[0])
    for step in reversed(steps[1:]):
        parsed = parsed.withColumns(step)
    unreadable = F.when(opened.held.isNull(), F.col(VALUE)).alias(UNREADABLE)
    rescued = F.when(F.size(opened.members) > 0, _object(opened.members)).alias(RESCUED)
    # Made by a generator: a filter on a projected column would move below the steps and repeat all of them, the parse included
    parsed = parsed.select("*", F.inline(F.array(F.struct(rescued, unreadable))))
    return parsed.select(*rest, *opened.fields, RESCUED, UNREADABLE)


def csv_headers(lines: DataFrame) -> DataFrame:
    """(path, header, records) of each CSV file: its first line and how many lines follow."""
    numbered = lines.select(
        F.col(f"{METADATA}.file_path").alias("path"), F.col(VALUE),
        F.struct(F.col(f"{METADATA}.file_block_start"), F.monotonically_increasing_id()).alias("_place"),
    )
    return numbered.groupBy("path").agg(F.ltrim(F.min_by(VALUE, "_place"), F.lit("﻿")).alias("header"), (F.count("*") - 1).alias("records"))


def _readable(path: str) -> str:
    """A path as a reader takes it: not encoded, its special characters escaped."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(path))


def _csv_group(spark: SparkSession, header: str, paths: list[str], columns: Sequence[str]) -> DataFrame:
    names = next(csv.reader([header]))
    places = [f"_{i}" for i in range(len(names))]
    schema = StructType([StructField(p, StringType()) for p in [*places, WHOLE_LINE]])
    rows = spark.read.schema(schema).options(**CSV_OPTIONS, columnNameOfCorruptRecord=WHOLE_LINE).csv([_readable(p) for p in paths])
    place_of: dict[str, str] = {}
    for name, place in zip(names, places):
        place_of.setdefault(name.strip().lower(), place)
    taken = [(c, place_of.get(c.lower())) for c in columns]
    stray = [(n.strip(), p) for n, p in zip(names, places) if p not in {p for _, p in taken}]
    # Spark refuses a read of nothing but the whole line, so a value stands beside it
    line = F.coalesce(WHOLE_LINE, places[0])
    lost = [F.when(F.col(p).isNotNull(), _member(F.lit(n), F.col(p))) for n, p in stray]
    lost.append(F.when(F.col(WHOLE_LINE).isNotNull(), _member(F.lit(WHOLE_LINE), line)))
    members = F.array_compact(F.array(*lost))
    return rows.select(
        *[(F.col(p) if p else F.lit(None).cast("string")).alias(c) for c, p in taken],
        F.when(F.size(members) > 0, _object(members)).alias(RESCUED),
        F.col(METADATA),
    )


def csv_rows(lines: DataFrame, columns: Sequence[str]) -> DataFrame:
    """String columns by the names in each file's own header, unknown columns rescued, absent ones null.

    Names match whatever their case; of a repeated name the first counts, the others are
    rescued. A row with more or fewer values than its header keeps its line as rescued
    data. What comes to the driver is the list of files, which Spark's reader holds too.
    Works on a batch of lines, one micro-batch of a stream included.
    """
    spark = lines.sparkSession
    groups = csv_headers(lines).groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("header")
    frames = [_csv_group(spark, g["header"], g["paths"], columns) for g in groups.toLocalIterator()]
    if not frames:
        kind = lines.schema[METADATA].dataType
        empty = StructType([*[StructField(c, StringType()) for c in [*columns, RESCUED]], StructField(METADATA, kind)])
        return spark.createDataFrame([], empty)
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def new_headers(lines: DataFrame, columns: Sequence[str]) -> StructType:
    """Columns that some file's header has and ``columns`` does not, as strings."""
    known = {c.lower() for c in columns}
    headers = csv_headers(lines).select("header").distinct().orderBy("header")
    found: dict[str, str] = {}
    for row in headers.toLocalIterator():
        for name in map(str.strip, next(csv.reader([row["header"]]))):
            if name and name.lower() not in known:
                found.setdefault(name.lower(), name)
    return StructType([StructField(n, StringType()) for n in found.values()])
