"""Audits that return their violations as rows of one shape: audit, entity, key, count.

An empty result is a pass. Counts combine on the map side, and only keys that
break an audit travel further.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce
from types import MappingProxyType

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerstone.operators.joins import salted_join

# Columns that must not appear, by scope.
FORBIDDEN_IN_CONTEXT = (
    "email phone_number full_name tfn card_number risk_rating pep_status sanctions_check raw_payload"
).split()
FORBIDDEN_IN_PARTIES = "first_name last_name email phone_number tfn abn acn".split()
RESTRICTED_COMPLIANCE = "risk_rating pep_status sanctions_check".split()


def _key(columns: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def _rows(frame: DataFrame, audit: str, entity: str, key: Column, observed: Column) -> DataFrame:
    return frame.select(
        F.lit(audit).alias("audit_id"),
        F.lit(entity).alias("entity_name"),
        key.alias("record_key"),
        observed.cast("bigint").alias("observed"),
    )


def together(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def duplicate_keys(frame: DataFrame, entity: str, keys: Sequence[str]) -> DataFrame:
    repeated = frame.groupBy(*keys).count().where(F.col("count") > 1)
    return _rows(repeated, "DUPLICATE_KEY", entity, _key(keys), F.col("count"))


def null_keys(frame: DataFrame, entity: str, keys: Sequence[str]) -> DataFrame:
    """One row per key column that is ever null, with its number of null rows."""
    counts = frame.agg(*[F.count_if(F.col(k).isNull()).alias(k) for k in keys])
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("column"), F.col(k).alias("nulls")) for k in keys]))
    broken = counts.select(each.alias("k")).where("k.nulls > 0")
    return _rows(broken, "NULL_KEY", entity, F.col("k.column"), F.col("k.nulls"))


def profile(frame: DataFrame, entity: str, keys: Sequence[str], required: Sequence[str] = (), accepted: Mapping[str, Sequence[str]] = MappingProxyType({})) -> DataFrame:
    """Repeated keys, null ``required`` columns and values that are not ``accepted``, in one scan.

    Each row is repeated for what it adds to: its key, its null columns, its unexpected values; one
    count, combined on the map side, then answers all checks. What names a key or a value is built after
    that, so a reader of some checks only does not pay for the others. Letters' case does not matter
    to accepted values; nulls are not judged there.
    """
    checks = [("DUPLICATE_KEY", F.to_json(F.struct(*keys)), _key(keys), F.lit(True))] if keys else []
    checks += [("NULL_KEY", F.lit(c), F.lit(c), F.col(c).isNull()) for c in required]
    for c, values in accepted.items():
        shown = F.concat_ws("=", F.lit(c), F.col(c))
        checks.append(("UNEXPECTED_VALUE", shown, shown, F.col(c).isNotNull() & ~F.upper(c).isin(*[v.upper() for v in values])))
    hits = F.array_compact(F.array(*[F.when(hit, F.lit(i)) for i, (*_, hit) in enumerate(checks)]))

    def of_check(values: Sequence[str | Column]) -> Column:
        return F.coalesce(*[F.when(F.col("_check") == i, v) for i, v in enumerate(values)])

    names = ("audit", "ident", "record_key")
    named = frame.select("*", F.explode(hits).alias("_check")).select(*[of_check(v).alias(n) for n, v in zip(names, zip(*checks))])
    counted = named.groupBy("audit", "ident", "record_key").count().where("audit <> 'DUPLICATE_KEY' OR count > 1")
    return counted.select(F.col("audit").alias("audit_id"), F.lit(entity).alias("entity_name"), "record_key", F.col("count").alias("observed"))


def hard_failed(frame: DataFrame, entity: str, keys: Sequence[str]) -> DataFrame:
    bad = frame.where(~F.coalesce(F.col("dq_status") == "PASSED", F.lit(False)))
    return _rows(bad, "HARD_FAILED_ROW", entity, _key(keys), F.lit(1))


def orphan_keys(child: DataFrame, entity: str, parent: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Foreign keys without a parent, with the number of child rows that hold them."""
    names = [c for c, _ in pairs]
    complete = reduce(lambda f, c: f.where(F.col(c).isNotNull()), names, child)
    held = complete.groupBy(*names).count()
    parents = parent.select(*[F.col(p).alias(c) for c, p in pairs]).distinct()
    return _rows(held.join(parents, names, "left_anti"), "ORPHAN_KEY", entity, _key(names), F.col("count"))


def unreconciled(
    source: DataFrame, target: DataFrame, entity: str, pairs: Sequence[tuple[str, str]], as_of: datetime,
    lag_minutes: int = 30,
) -> DataFrame:
    """Source rows older than the lag that never reached the target.

    Only the distinct keys of the target count, so Spark leaves out of its plan what merely adds columns to them.
    """
    due = source.where(F.col("processed_at") < F.lit(as_of - timedelta(minutes=lag_minutes)).cast("timestamp"))
    names = [s for s, _ in pairs]
    arrived = target.select(*[F.col(t).alias(s) for s, t in pairs]).distinct()
    return _rows(due.join(arrived, names, "left_anti"), "NOT_RECONCILED", entity, _key(names), F.lit(1))


def out_of_order(frame: DataFrame, entity: str, keys: Sequence[str], earlier: str, later: str) -> DataFrame:
    return _rows(frame.where(F.col(later) < F.col(earlier)), "TIME_ORDER", entity, _key(keys), F.lit(1))


def lost_records(parts: Mapping[str, tuple[DataFrame, str]], merged: DataFrame, entity: str) -> DataFrame:
    """Records of the parts of a union (frame, id column by source table) that the union lacks."""
    expected = together(
        frame.select(F.lit(name).alias("source_table"), F.col(key).alias("source_record_id"))
        for name, (frame, key) in parts.items()
    )
    names = ["source_table", "source_record_id"]
    missing = expected.join(merged.select(*names), names, "left_anti")
    return _rows(missing, "LOST_RECORD", entity, _key(names), F.lit(1))


def several_open(frame: DataFrame, entity: str, keys: Sequence[str], is_open: Column) -> DataFrame:
    """Keys with more than one open row, such as two open versions or two current stages."""
    held = frame.where(is_open).groupBy(*keys).count().where(F.col("count") > 1)
    return _rows(held, "SEVERAL_OPEN", entity, _key(keys), F.col("count"))


def unexpected_values(frame: DataFrame, entity: str, column: str, accepted: Sequence[str]) -> DataFrame:
    held = frame.where(F.col(column).isNotNull() & ~F.col(column).isin(*accepted)).groupBy(column).count()
    return _rows(held, "UNEXPECTED_VALUE", entity, F.concat_ws("=", F.lit(column), column), F.col("count"))


def context_identity(frame: DataFrame) -> DataFrame:
    """Context rows that do not name exactly one subject or lack their trust columns."""
    one = F.col("customer_id").isNull() != F.col("organisation_id").isNull()
    trusted = reduce(
        lambda a, b: a & b,
        [F.col(c).isNotNull() for c in ("snapshot_id", "entity_id", "entity_type", "source_max_processed_at")],
    )
    return _rows(
        frame.where(~(one & trusted)), "CONTEXT_IDENTITY", "fact_subject_context_snapshot", F.col("entity_id"), F.lit(1)
    )


def context_codes(frame: DataFrame, entity_type: str, code: str) -> DataFrame:
    """Context rows of a type that lack a mandatory warning code."""
    bare = frame.where((F.col("entity_type") == entity_type) & ~F.array_contains("warning_codes", code))
    return _rows(bare, "MISSING_WARNING_CODE", "fact_subject_context_snapshot", F.col("entity_id"), F.lit(1))


def invented_policy(policy: DataFrame) -> DataFrame:
    """Policy rows with a code or wording that no policy owner has supplied."""
    text = F.coalesce("banker_action_text", "customer_safe_action_text")
    made_up = policy.where((F.col("next_action_code") != "POLICY_NOT_CONFIGURED") | text.isNotNull())
    return _rows(made_up, "INVENTED_POLICY", "dim_stage_action_policy", _key(["stage", "pending_action_party"]), F.lit(1))


def schema_rows(spark: SparkSession, frames: Mapping[str, DataFrame]) -> DataFrame:
    """Column names and types of many frames as a small frame."""
    rows = [(name, f.name, f.dataType.simpleString()) for name, frame in frames.items() for f in frame.schema.fields]
    return spark.createDataFrame(rows, "entity_name string, column_name string, data_type string")


def forbidden_columns(schemas: DataFrame, denied: Sequence[str]) -> DataFrame:
    held = schemas.where(F.lower("column_name").isin(*denied))
    return held.select(
        F.lit("FORBIDDEN_COLUMN").alias("audit_id"),
        "entity_name",
        F.col("column_name").alias("record_key"),
        F.lit(1).cast("bigint").alias("observed"),
    )


def missing_columns(schemas: DataFrame, spark: SparkSession, required: Mapping[str, Mapping[str, str | None]]) -> DataFrame:
    """Required columns that an entity lacks or holds in another type."""
    wanted = spark.createDataFrame(
        [(entity, column, kind) for entity, columns in required.items() for column, kind in columns.items()],
        "entity_name string, column_name string, wanted string",
    )
    names = ["entity_name", "column_name"]
    found = wanted.join(schemas, names, "left")
    wrong = found.where(F.col("data_type").isNull() | (F.col("data_type") != F.col("wanted")))
    return wrong.select(
        F.lit("MISSING_COLUMN").alias("audit_id"),
        "entity_name",
        F.col("column_name").alias("record_key"),
        F.lit(1).cast("bigint").alias("observed"),
    )


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    return together(
        _rows(frame.agg(F.count("*").alias("n")), "ROW_COUNT", name, F.lit(name), F.col("n")) for name, frame in frames.items()
    )


def child_rows_of(child: DataFrame, broken: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full child rows behind a set of broken keys; a frequent key is split over many tasks."""
    return salted_join(child, broken.select(*keys).distinct(), keys, "left_semi")
