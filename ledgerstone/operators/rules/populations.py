"""Rules about a whole data set: ratios, distributions and counts, as one row per measure.

All ratio and count rules of a data set share one aggregate (``ratios``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerstone.operators.rules.rows import condition

Spec = Mapping[str, Any]
POPULATION_RULES: dict[str, Callable[[Spec], tuple[Column, Column | None]]] = {}


def _type(*names: str):
    def add(function):
        for name in names:
            POPULATION_RULES[name] = function
        return function

    return add


def _test(spec: Spec) -> Column:
    return F.expr(spec["condition"]) if "condition" in spec else condition(spec["when"])


@_type("POPULATION_RATIO_RANGE", "POPULATION_RATIO_MAX")
def _ratio(s):
    return F.coalesce(_test(s), F.lit(False)), None


@_type("NULL_RATIO_RANGE")
def _nulls(s):
    return F.col(s["column"]).isNull(), None


@_type("CONDITIONAL_CATEGORY_RATIO_RANGE")
def _within(s):
    return F.col(s["column"]).isin(*s["values"]), condition(s["when"])


@_type("TIMESTAMP_HOUR_POPULATION_RATIO")
def _hours(s):
    return F.hour(F.col(s["column"]).try_cast("timestamp")).between(s["from_hour"], s["to_hour"]), None


@_type("TIMESTAMP_WEEKDAY_POPULATION_RATIO")
def _weekdays(s):
    return F.dayofweek(F.col(s["column"]).try_cast("timestamp")).isin(*s["days"]), None


@_type("IDENTIFIER_RANGE_POPULATION_RATIO")
def _id_range(s):
    number = F.regexp_extract(F.col(s["column"]).cast("string"), s["pattern"], 1).try_cast("bigint")
    return number.between(s["from_id"], s["to_id"]), None


@_type("RECORD_COUNT_EXACT", "RECORD_COUNT_EXPECTATION")
def _count(s):
    return F.lit(True), None


def ratios(frame: DataFrame, specs: Sequence[Spec]) -> DataFrame:
    """Every ratio and count rule of a data set, from one scan."""
    counts = []
    for i, spec in enumerate(specs):
        hit, within = POPULATION_RULES[spec["type"]](spec)
        base = F.lit(True) if within is None else within
        counts += [F.count_if(base & hit).alias(f"hit{i}"), F.count_if(base).alias(f"all{i}")]
    rows = []
    for i, spec in enumerate(specs):
        counting = spec["type"].startswith("RECORD_COUNT")
        actual = (
            F.col(f"hit{i}").cast("double")
            if counting
            else F.round(F.try_divide(F.col(f"hit{i}"), F.col(f"all{i}")), 6)
        )
        low, high = (F.lit(spec.get(k)).cast("double") for k in ("min", "max"))
        good = (low.isNull() | (actual >= low)) & (high.isNull() | (actual <= high))
        rows.append(
            F.struct(
                F.lit(spec["type"]).alias("rule_type"),
                F.lit(spec["measure"]).alias("measure"),
                actual.alias("actual"),
                F.coalesce(good, F.lit(False)).alias("passed"),
            )
        )
    return frame.agg(*counts).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _beside(frame: DataFrame, one_row: DataFrame) -> DataFrame:
    """Put the columns of a one-row aggregate next to every row."""
    one = F.lit(1)
    return frame.withColumn("_one", one).join(one_row.withColumn("_one", one), "_one").drop("_one")


def categories(frame: DataFrame, column: str, expected: Mapping[str, float], tolerance: float) -> DataFrame:
    """CATEGORICAL_DISTRIBUTION_TOLERANCE: share of each category against the expected share.

    The counts per category are few; shares come from their sum.
    """
    rule = "CATEGORICAL_DISTRIBUTION_TOLERANCE"
    shares = F.create_map(*[F.lit(x) for pair in expected.items() for x in pair])
    counted = frame.groupBy(column).agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n").alias("total"))
    known = frame.sparkSession.createDataFrame([(k,) for k in expected], f"{column} string")
    both = _beside(known.join(counted, column, "full"), total)
    actual = F.round(F.coalesce("n", F.lit(0)) / F.col("total"), 6)
    wanted = F.coalesce(F.try_element_at(shares, F.col(column)), F.lit(0.0))
    return both.select(
        F.lit(rule).alias("rule_type"),
        F.col(column).alias("measure"),
        actual.alias("actual"),
        (F.abs(actual - wanted) <= tolerance).alias("passed"),
    )


def moments(frame: DataFrame, column: str, selector: str | None = None, logarithm: bool = False) -> DataFrame:
    """Mean and deviation, reported without limits; per selector and of ln(value) if asked."""
    rule = "CONDITIONAL_LOGNORMAL_DISTRIBUTION_MONITORING" if logarithm else "NUMERIC_DISTRIBUTION_MONITORING"
    value = F.col(column).try_cast("double")
    value = F.when(value > 0, F.ln(value)) if logarithm else value
    name = F.col(selector) if selector else F.lit(column)
    return (
        frame.groupBy(name.alias("measure"))
        .agg(F.round(F.avg(value), 6).alias("mean"), F.round(F.stddev_samp(value), 6).alias("deviation"))
        .select(F.lit(rule).alias("rule_type"), "measure", "mean", "deviation")
    )


def concentration(frame: DataFrame, column: str, top: float = 0.1) -> DataFrame:
    """CONCENTRATION_DISTRIBUTION_MONITORING: share of rows held by the largest tenth of the groups.

    Groups are counted by size. There are at most about sqrt(2 x rows) different
    sizes, so the running sum over sizes is small, however many groups there are.
    """
    sizes = frame.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("size"))
    histogram = sizes.groupBy("size").agg(F.count("*").alias("groups"))
    totals = histogram.agg(F.sum("groups").alias("all_groups"), F.sum(F.col("size") * F.col("groups")).alias("all_rows"))
    above = Window.orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranked = _beside(histogram.withColumn("before", F.coalesce(F.sum("groups").over(above), F.lit(0))), totals)
    room = F.ceil(F.col("all_groups") * top) - F.col("before")
    taken = F.greatest(F.lit(0), F.least("groups", room))
    return ranked.groupBy("all_rows").agg(F.sum(taken * F.col("size")).alias("held")).select(
        F.lit("CONCENTRATION_DISTRIBUTION_MONITORING").alias("rule_type"),
        F.lit(column).alias("measure"),
        F.round(F.col("held") / F.col("all_rows"), 6).alias("actual"),
    )


POPULATION_FRAMES = {
    "CATEGORICAL_DISTRIBUTION_TOLERANCE": categories,
    "NUMERIC_DISTRIBUTION_MONITORING": moments,
    "CONDITIONAL_LOGNORMAL_DISTRIBUTION_MONITORING": moments,
    "CONCENTRATION_DISTRIBUTION_MONITORING": concentration,
}
