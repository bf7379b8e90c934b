"""Derived columns that contracts declare: flags, translations, enrichment, lineage, routing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerstone.functions import apply_handling
from ledgerstone.operators.joins import lookup
from ledgerstone.operators.ordered import time_chunk, with_ordinal
from ledgerstone.operators.quality import failed_rules

# What happens to a row, file or output that breaks a rule.
ACTIONS = (
    "QUARANTINE",
    "ALLOW_WITH_WARNING",
    "REJECT_FILE",
    "DEDUPLICATE_TRANSPORT_COPY",
    "SKIP_DUPLICATE_DELIVERY",
    "BLOCK_AI_OUTPUT",
    "QUARANTINE_CHILD_RECORD",
)


def days_open(start: Column, end: Column, as_of: datetime) -> Column:
    """Whole days from start to end; an open interval runs to the clock."""
    return F.datediff(F.coalesce(end.cast("date"), F.lit(as_of.date())), start.cast("date"))


def overdue(deadline: Column, done: Column, as_of: datetime) -> Column:
    """Still open after its deadline. Whether it was late when it closed is another, stored fact."""
    return done.isNull() & F.coalesce(deadline < F.lit(as_of).cast("timestamp"), F.lit(False))


def first_like(column: Column, patterns: Sequence[tuple[str, str]], otherwise: str | None = None) -> Column:
    """Value of the first LIKE pattern that matches. ``_`` stands for any one character."""
    chain = F.lit(otherwise).cast("string")
    for pattern, value in reversed(list(patterns)):
        chain = F.when(column.like(pattern), F.lit(value)).otherwise(chain)
    return chain


def transition_text(before: Column, after: Column) -> Column:
    return F.concat(before, F.lit(" -> "), after)


def json_presence(column: Column, paths: Mapping[str, str]) -> Column:
    """Names of the JSON paths that hold a value, in declaration order."""
    return F.array_compact(
        F.array(*[F.when(F.get_json_object(column, p).isNotNull(), F.lit(name)) for name, p in paths.items()])
    )


def recency_rank(frame: DataFrame, group: str, moment: str, tie: str, name: str = "recency_rank") -> DataFrame:
    """Rank of each row within its group, newest first; groups of any size are split by time."""
    newest_first = frame.withColumn("_age", -F.unix_micros(F.col(moment).cast("timestamp")))
    age_chunk = F.coalesce(
        -F.unix_seconds(F.date_trunc("month", F.col(moment).cast("timestamp"))), F.lit(0).cast("bigint")
    )
    return with_ordinal(newest_first, [group], ["_age", tie], age_chunk, name).drop("_age")


def latest_value(
    frame: DataFrame, group: Sequence[str], value: str, moment: str, tie: str, name: str
) -> DataFrame:
    """The value of the latest row per group; a partial aggregate, so groups may be large."""
    return frame.groupBy(*group).agg(F.max_by(value, F.struct(moment, tie)).alias(name))


def enrich(frame: DataFrame, reference: DataFrame, on: Mapping[str, str], columns: Mapping[str, str]) -> DataFrame:
    """Left join the allow-listed reference columns (output name to reference column)."""
    names = list(on)
    side = reference.select(
        *[F.col(r).alias(s) for s, r in on.items()], *[F.col(c).alias(name) for name, c in columns.items()]
    )
    return lookup(frame, side, names)


def approved_projection(frame: DataFrame, allowed: Sequence[str], denied: Sequence[str]) -> DataFrame:
    """Only allow-listed columns; refuses an allow list that names a denied one."""
    clash = set(allowed) & set(denied)
    if clash:
        raise ValueError(f"columns may not leave the governed layer: {', '.join(sorted(clash))}")
    return frame.select(*allowed)


def private(frame: DataFrame, handling: Mapping[str, str], key: bytes | None = None) -> DataFrame:
    return apply_handling(frame, handling, key)


def translated(
    frame: DataFrame, column: str, mapping: Mapping[str, str], name: str, excluded: Sequence[str] = ()
) -> DataFrame:
    """Replace internal codes by approved text. Excluded and unknown codes give null.

    The mapping is contract configuration of a few entries, so it is a literal map.
    """
    pairs = [F.lit(x) for code, text in mapping.items() if code not in excluded for x in (code, text)]
    return frame.withColumn(name, F.try_element_at(F.create_map(*pairs), F.col(column)))


def with_lineage(frame: DataFrame, dataset: str, keys: Sequence[str]) -> DataFrame:
    """File and record lineage. The record id depends on the data set and keys only."""
    record = F.concat_ws("|", F.lit(dataset), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    columns = {"_source_dataset": F.lit(dataset), "_record_hash": F.sha2(record, 256)}
    return frame.withColumns(columns)


def with_file_lineage(frame: DataFrame) -> DataFrame:
    """File columns of a frame that is read directly from files."""
    return frame.withColumns(
        {
            "_source_file": F.col("_metadata.file_path"),
            "_source_file_size": F.col("_metadata.file_size"),
            "_source_file_modified_at": F.col("_metadata.file_modification_time"),
        }
    )


def routed(
    frame: DataFrame, rules: Mapping[str, str | Column], actions: Mapping[str, str], default: str = "QUARANTINE"
) -> DataFrame:
    """Add the failed rules and the strictest of their declared actions (null where none failed)."""
    unknown = {a for a in actions.values() if a not in ACTIONS}
    if unknown:
        raise ValueError(f"unknown rule actions: {', '.join(sorted(unknown))}")
    severity = (
        "REJECT_FILE QUARANTINE QUARANTINE_CHILD_RECORD BLOCK_AI_OUTPUT DEDUPLICATE_TRANSPORT_COPY"
        " SKIP_DUPLICATE_DELIVERY ALLOW_WITH_WARNING"
    ).split()
    action = F.lit(None).cast("string")
    for name in reversed(severity):
        ids = [r for r in rules if actions.get(r, default) == name]
        if ids:
            hit = F.arrays_overlap("failed_rule_ids", F.array(*[F.lit(i) for i in ids]))
            action = F.when(hit, F.lit(name)).otherwise(action)
    return frame.withColumn("failed_rule_ids", failed_rules(rules)).withColumn("rule_action", action)


def accepted_files(frame: DataFrame, file_column: str, action_column: str = "rule_action") -> DataFrame:
    """Rows of files in which no row asks to reject the whole file."""
    rejected = frame.where(F.col(action_column) == "REJECT_FILE").select(file_column).distinct()
    return frame.join(rejected, file_column, "left_anti")


def reference_frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small contract-owned reference list as a frame."""
    return spark.createDataFrame(list(rows), schema)
