"""Rules that judge rows together: uniqueness and sequence. Violations come back as keys.

Uniqueness is a count per key, which combines on the map side. Sequences use the
chunked neighbours, so one long history is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerstone.operators.ordered import time_chunk, with_neighbours
from ledgerstone.operators.rules.rows import condition

Spec = Mapping[str, Any]
GROUP_RULES: dict[str, Callable[..., DataFrame]] = {}


def _type(*names: str):
    def add(function):
        for name in names:
            GROUP_RULES[name] = function
        return function

    return add


def keyed(columns: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def found(frame: DataFrame, spec: Spec, key: Column, observed: Column) -> DataFrame:
    return frame.select(
        F.lit(spec["type"]).alias("rule_type"), key.alias("record_key"), observed.cast("bigint").alias("observed")
    )


def _complete(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    return reduce(lambda f, c: f.where(F.col(c).isNotNull()), columns, frame)


@_type(
    "UNIQUE_IF_PRESENT",
    "UNIQUE_WITHIN_GROUP",
    "COMPOSITE_UNIQUE_IF_PRESENT",
    "COMPOSITE_UNIQUE_WHEN",
    "COMPOSITE_DUPLICATE_DETECTION",
    "UNIQUE_EVENT_ENVELOPE_POSITION",
)
def unique(frame: DataFrame, spec: Spec) -> DataFrame:
    """Keys (complete ones, within the optional condition) that occur more than once."""
    columns = spec["columns"]
    rows = _complete(frame, columns)
    if "when" in spec:
        rows = rows.where(condition(spec["when"]))
    return found(rows.groupBy(*columns).count().where("count > 1"), spec, keyed(columns), F.col("count"))


@_type("CONDITIONAL_UNIQUE_PER_GROUP")
def one_per_group(frame: DataFrame, spec: Spec) -> DataFrame:
    """Groups in which the condition holds for more than one row."""
    rows = _complete(frame, spec["group"]).where(condition(spec["when"]))
    return found(rows.groupBy(*spec["group"]).count().where("count > 1"), spec, keyed(spec["group"]), F.col("count"))


def _steps(frame: DataFrame, spec: Spec, carried: Sequence[str]) -> DataFrame:
    order = spec["order"]
    chunk = time_chunk(F.col(order[0]), spec.get("chunk", "month")) if spec.get("timed", True) else F.lit(0).cast("timestamp")
    if "chunk_by" in spec:
        chunk = F.expr(spec["chunk_by"])
    return with_neighbours(_complete(frame, spec["group"]), spec["group"], order, chunk, previous=carried)


@_type("MONOTONIC_EVENT_TIME_PER_GROUP")
def monotonic(frame: DataFrame, spec: Spec) -> DataFrame:
    """Rows whose time lies before that of the row that arrived before them."""
    steps = _steps(frame, spec, [spec["time"]])
    return found(steps.where(F.col(spec["time"]) < F.col(f"_previous.{spec['time']}")), spec, keyed(spec["key"]), F.lit(1))


@_type("NON_OVERLAPPING_INTERVALS_PER_GROUP")
def no_overlap(frame: DataFrame, spec: Spec) -> DataFrame:
    """Intervals that start before the previous one ended; touching is allowed."""
    steps = _steps(frame, spec, [spec["end"]])
    return found(steps.where(F.col(spec["start"]) < F.col(f"_previous.{spec['end']}")), spec, keyed(spec["key"]), F.lit(1))


@_type("ORDERED_TRANSITION_GRAPH")
def transitions(frame: DataFrame, spec: Spec) -> DataFrame:
    """Rows whose value may not follow the previous one."""
    value = spec["value"]
    steps = _steps(frame, spec, [value])
    move = F.concat(F.col(f"_previous.{value}"), F.lit("->"), F.col(value))
    return found(steps.where(~move.isin(*spec["allowed"])), spec, keyed(spec["key"]), F.lit(1))


@_type("PREVIOUS_NEXT_VALUE_CONTINUITY")
def continuity(frame: DataFrame, spec: Spec) -> DataFrame:
    """Rows whose old value is not the previous row's new value."""
    steps = _steps(frame, spec, [spec["new"]])
    broken = F.col("_previous").isNotNull() & ~F.col(spec["old"]).eqNullSafe(F.col(f"_previous.{spec['new']}"))
    return found(steps.where(broken), spec, keyed(spec["key"]), F.lit(1))


@_type("CROSS_EVENT_TRANSITION_ALIGNMENT")
def aligned(frame: DataFrame, spec: Spec, other: DataFrame) -> DataFrame:
    """Transitions with no matching entry of the same group and value in the other log, near in time.

    Both logs meet on (group, value, time slot). A slot is as wide as the
    tolerance, so a match lies in the same or a neighbouring slot: three copies
    of the other log's slots, never all pairs of a group.
    """
    width = spec["tolerance_seconds"]

    def slotted(rows: DataFrame, group: str, value: str, time: str, prefix: str) -> DataFrame:
        at = F.unix_micros(F.col(time).cast("timestamp"))
        slot = F.floor(at / (max(width, 1) * 1_000_000)).cast("bigint")
        return rows.select(
            F.col(group).alias("_group"), F.col(value).alias("_value"), at.alias(f"{prefix}_at"), slot.alias("_slot"),
            *([F.col(c) for c in spec["key"]] if prefix == "_a" else []),
        )

    ours = slotted(frame, spec["group"], spec["value"], spec["time"], "_a")
    theirs = slotted(other, spec["other_group"], spec["other_value"], spec["other_time"], "_b")
    # The earliest and latest time of a slot are enough to tell whether any is near enough to a
    # row in a neighbouring slot; within the same slot every entry is near enough.
    bounds = theirs.groupBy("_group", "_value", "_slot").agg(F.min("_b_at").alias("_low"), F.max("_b_at").alias("_high"))
    spread = bounds.withColumn("_shift", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))).withColumn(
        "_slot", F.col("_slot") + F.col("_shift")
    )
    limit = F.lit(width * 1_000_000)
    near = (
        F.when(F.col("_shift") == 0, F.lit(True))
        .when(F.col("_shift") == 1, F.col("_a_at") - F.col("_high") <= limit)
        .otherwise(F.col("_low") - F.col("_a_at") <= limit)
    )
    joined = ours.join(spread, ["_group", "_value", "_slot"], "left")
    judged = joined.groupBy(*spec["key"]).agg(F.max(F.coalesce(near & F.col("_low").isNotNull(), F.lit(False))).alias("_met"))
    return found(judged.where(~F.col("_met")), spec, keyed(spec["key"]), F.lit(1))


@_type("IDENTIFIER_SEQUENCE_COMPLETE")
def sequence_gaps(frame: DataFrame, spec: Spec) -> DataFrame:
    """Runs of missing numbers (first..last) between the smallest and largest identifier, with their lengths.

    Each number meets its follower within a block of numbers; blocks then shrink to
    their ends and meet the next ones in blocks of blocks, so no task holds more
    than ``block`` rows and a gap of any width is one row.
    """
    block = spec.get("block", 100_000)
    number = F.regexp_extract(F.col(spec["column"]).cast("string"), spec["pattern"], 1).try_cast("bigint")
    ends = frame.select(number.alias("_low")).where(F.col("_low").isNotNull()).distinct().withColumn("_high", F.col("_low"))
    gaps, width = [], 1
    while width < 2**63:
        width *= block
        group = F.floor(F.col("_low") / F.lit(width)).cast("bigint") if width < 2**63 else F.lit(0).cast("bigint")
        grouped = ends.withColumn("_group", group)
        follower = F.lead("_low").over(Window.partitionBy("_group").orderBy("_low"))
        apart = grouped.withColumn("_next", follower).where(F.col("_next") > F.col("_high") + 1)
        gaps.append(apart.select((F.col("_high") + 1).alias("_from"), (F.col("_next") - 1).alias("_to")))
        ends = grouped.groupBy("_group").agg(F.min("_low").alias("_low"), F.max("_high").alias("_high")).drop("_group")
    missing = reduce(DataFrame.unionByName, gaps)
    return found(missing, spec, F.concat_ws("..", F.col("_from").cast("string"), F.col("_to").cast("string")), F.col("_to") - F.col("_from") + 1)

