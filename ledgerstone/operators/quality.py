"""Declared rules: compile, evaluate, split, quarantine and measure.

All row rules of an entity are evaluated in one projection (one array column) or
one filter, all counts in one aggregate. The same predicates feed both branches
of a split, so passed plus quarantined is always the input. A rule that evaluates to null has
failed.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, functions as F

ERROR, WARNING = "error", "warning"
PRE_TRANSFORM, POST_TRANSFORM = "PRE_TRANSFORM", "POST_TRANSFORM"


class ContractError(ValueError):
    """A contract that cannot be turned into rules."""


@dataclass(frozen=True)
class Rule:
    """One row rule. ``expression`` may use ``{today}`` for the explicit clock."""

    id: str
    severity: str
    dimension: str
    expression: str


@dataclass(frozen=True)
class Contract:
    """Identity, keys, required source fields and rules of one data set."""

    name: str
    keys: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = ()
    required: tuple[str, ...] = ()
    version: str = "1.0.0"
    limitations: tuple[str, ...] = ()
    tolerances: Mapping[str, float] = field(default_factory=dict)

    @property
    def fingerprint(self) -> str:
        """SHA-256 of the contract's canonical JSON."""
        text = json.dumps(asdict(self), sort_keys=True, separators=(",", ":"))
        return hashlib.sha256(text.encode("utf-8")).hexdigest()


def compile_rules(contract: Contract, severity: str, as_of: datetime | None = None) -> dict[str, str]:
    """Rule id to SQL predicate for one severity. Malformed rules are refused, never skipped."""
    today = "DATE'{:%Y-%m-%d}'".format(as_of) if as_of else None
    compiled: dict[str, str] = {}
    for rule in contract.rules:
        if rule.severity not in (ERROR, WARNING):
            raise ContractError(f"{contract.name}: unknown severity {rule.severity!r}")
        if not rule.id or not rule.expression:
            raise ContractError(f"{contract.name}: every rule needs an id and an expression")
        if rule.severity != severity:
            continue
        if rule.id in compiled:
            raise ContractError(f"{contract.name}: rule {rule.id} is declared twice")
        expression = rule.expression
        if "{today}" in expression:
            if today is None:
                raise ContractError(f"{contract.name}: rule {rule.id} needs a clock")
            expression = expression.replace("{today}", today)
        compiled[rule.id] = expression
    return compiled


def required_rules(contract: Contract) -> dict[str, str]:
    """Not-null rules for the required fields of a source contract."""
    return {f"SOURCE_{name.upper()}_REQUIRED": f"`{name}` IS NOT NULL" for name in contract.required}


def _verdict(predicate: str | Column) -> Column:
    return F.expr(predicate) if isinstance(predicate, str) else predicate


def failed_rules(rules: Mapping[str, str | Column]) -> Column:
    """Array of the ids of all rules a row breaks, in declaration order."""
    if not rules:
        return F.array().cast("array<string>")
    return F.array_compact(
        F.array(
            *[
                F.when(~F.coalesce(_verdict(predicate), F.lit(False)), F.lit(name))
                for name, predicate in rules.items()
            ]
        )
    )


def with_status(frame: DataFrame, errors: Mapping[str, str], warnings: Mapping[str, str]) -> DataFrame:
    """Add the failed rule ids per severity and PASSED, WARNING or QUARANTINED."""
    return frame.withColumns(
        {"failed_hard_rules": failed_rules(errors), "failed_warning_rules": failed_rules(warnings)}
    ).withColumn(
        "quality_status",
        F.when(F.size("failed_hard_rules") > 0, "QUARANTINED")
        .when(F.size("failed_warning_rules") > 0, "WARNING")
        .otherwise("PASSED"),
    )


def passed(frame: DataFrame, rules: Mapping[str, str | Column]) -> DataFrame:
    """Rows that break no rule: one filter that stops at the first broken rule."""
    for predicate in rules.values():
        frame = frame.where(F.coalesce(_verdict(predicate), F.lit(False)))
    return frame


def quarantined(
    frame: DataFrame,
    contract: Contract,
    rules: Mapping[str, str | Column],
    stage: str = POST_TRANSFORM,
    as_of: datetime | None = None,
) -> DataFrame:
    """Failed rows in one fixed envelope, whatever their schema; ids are stable across replays."""
    has = set(frame.columns)
    moment = F.col("processed_at") if "processed_at" in has else F.lit(as_of)
    source = F.col("source_table") if "source_table" in has else F.lit(None)
    key = F.concat_ws("|", *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for k in contract.keys])
    failed = F.col("_failed")
    return (
        frame.withColumn("_failed", failed_rules(rules))
        .where(F.size(failed) > 0)
        .select(
            F.lit(stage).alias("validation_stage"),
            F.lit(contract.name).alias("contract_id"),
            F.lit(contract.version).alias("contract_version"),
            F.lit(contract.name).alias("entity_name"),
            key.alias("record_key"),
            failed.alias("failed_rule_ids"),
            F.to_json(F.struct(*[F.col(f"`{c}`") for c in frame.columns])).alias("record_payload"),
            source.cast("string").alias("source_reference"),
            moment.cast("timestamp").alias("processed_at"),
            F.lit(contract.fingerprint).alias("contract_hash"),
        )
        .select(
            F.sha2(
                F.concat_ws(
                    "|",
                    "entity_name",
                    "record_key",
                    F.array_join(F.sort_array("failed_rule_ids"), ","),
                    F.col("processed_at").cast("string"),
                ),
                256,
            ).alias("failure_id"),
            "*",
        )
    )


def _rule_counts(compiled: Mapping[str, str | Column]) -> list[Column]:
    """How many rows there are and how many pass each rule, as aggregates."""
    passing = [F.count_if(F.coalesce(_verdict(p), F.lit(False))).alias(f"p{i}") for i, p in enumerate(compiled.values())]
    return [F.count("*").alias("total"), *passing]


def observed(frame: DataFrame, contract: Contract, as_of: datetime | None = None) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """The frame, and its rule metrics once it has been written: counted on the way, without a scan of their own.

    Works on a batch and on a micro-batch of a stream. The metrics wait for the write;
    ask for them after it.
    """
    counts = Observation()
    compiled = compile_rules(contract, ERROR, as_of) | compile_rules(contract, WARNING, as_of)

    def metrics() -> DataFrame:
        totals = counts.get
        names = ["total", *[f"p{i}" for i in range(len(compiled))]]
        row = frame.sparkSession.range(1).select(*[F.lit(totals[n]).cast("bigint").alias(n) for n in names])
        return _metric_rows(row, contract, compiled)

    return frame.observe(counts, *_rule_counts(compiled)), metrics


def rule_metrics(frame: DataFrame, contract: Contract, as_of: datetime | None = None) -> DataFrame:
    """Passed and failed rows per rule, in one scan and one small aggregate."""
    compiled = compile_rules(contract, ERROR, as_of) | compile_rules(contract, WARNING, as_of)
    return _metric_rows(frame.agg(*_rule_counts(compiled)), contract, compiled)


def _metric_rows(totals: DataFrame, contract: Contract, compiled: Mapping[str, str | Column]) -> DataFrame:
    rules = {r.id: r for r in contract.rules}
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(contract.name).alias("entity_name"),
                    F.lit(name).alias("rule_id"),
                    F.lit(rules[name].severity).alias("severity"),
                    F.lit(rules[name].dimension).alias("dimension"),
                    F.col(f"p{i}").alias("passed_count"),
                    (F.col("total") - F.col(f"p{i}")).alias("failed_count"),
                )
                for i, name in enumerate(compiled)
            ]
        )
    )
    return totals.select(rows.alias("m")).select("m.*")


def quality_by_dimension(metrics: DataFrame) -> DataFrame:
    """Share of passed checks per entity and quality dimension."""
    return (
        metrics.groupBy("entity_name", "dimension")
        .agg(F.sum("passed_count").alias("passed_count"), F.sum("failed_count").alias("failed_count"))
        .withColumn(
            "pass_rate",
            F.round(F.try_divide("passed_count", F.col("passed_count") + F.col("failed_count")), 6),
        )
    )


def tolerance_check(
    frame: DataFrame,
    contract: Contract,
    as_of: datetime,
    late: Column | None = None,
    hard_limit: float = 0.01,
    late_limit: float = 0.05,
) -> DataFrame:
    """Hard-failure and freshness-breach rates of a data set against their limits."""
    broken = F.size(failed_rules(compile_rules(contract, ERROR, as_of))) > 0
    checks = [("hardFailureRate", broken, contract.tolerances.get("hardFailureRate", hard_limit))]
    if late is not None:
        checks.append(
            ("freshnessBreachRate", late, contract.tolerances.get("freshnessBreachRate", late_limit))
        )
    rates = frame.agg(
        F.count("*").alias("n"), *[F.count_if(test).alias(name) for name, test, _ in checks]
    )
    verdicts = [
        F.struct(
            F.lit(contract.name).alias("entity_name"),
            F.lit(name).alias("metric"),
            F.col(name).alias("breach_count"),
            F.round(F.try_divide(F.col(name), F.col("n")), 6).alias("rate"),
            F.lit(limit).alias("tolerance"),
            (F.try_divide(F.col(name), F.col("n")) <= limit).alias("within_tolerance"),
        )
        for name, _, limit in checks
    ]
    return rates.select(F.explode(F.array(*verdicts)).alias("v")).select("v.*")


def freshness_lag(frame: DataFrame, moment: str, as_of: datetime, limit_minutes: int = 30) -> DataFrame:
    """Minutes since the newest row, and whether that is within the limit."""
    newest = F.max(F.col(moment).cast("timestamp"))
    lag = (F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp("latest_processed_at")) / 60
    return (
        frame.agg(newest.alias("latest_processed_at"))
        .withColumn("lag_minutes", F.floor(lag).cast("bigint"))
        .withColumn("is_fresh", F.coalesce(F.col("lag_minutes") <= limit_minutes, F.lit(False)))
    )


def library_metrics(frame: DataFrame, checks: Iterable[tuple[str, str, Mapping]]) -> DataFrame:
    """Null, invalid and duplicate value counts for many columns in one aggregate.

    ``checks`` holds (metric, column, arguments); arguments of ``invalidValues``
    are ``pattern`` or ``values``. Every metric must be 0. Duplicates are found by
    a count per value first, which combines on the map side.
    """
    checks = list(checks)
    plain, results = [], []
    for i, (metric, column, args) in enumerate(checks):
        value = F.col(column)
        if metric == "nullValues":
            plain.append(F.count_if(value.isNull()).alias(f"m{i}"))
        elif metric == "invalidValues":
            ok = value.rlike(args["pattern"]) if "pattern" in args else value.isin(*args["values"])
            plain.append(F.count_if(value.isNotNull() & ~ok).alias(f"m{i}"))
        elif metric != "duplicateValues":
            raise ContractError(f"unknown library metric {metric!r}")

    def row(i: int, actual: Column) -> Column:
        metric, column, _ = checks[i]
        return F.struct(
            F.lit(metric).alias("metric"),
            F.lit(column).alias("column_name"),
            actual.cast("bigint").alias("actual"),
            (actual == 0).alias("passed"),
        )

    single = [i for i, c in enumerate(checks) if c[0] != "duplicateValues"]
    if single:
        results.append(
            frame.agg(*plain)
            .select(F.explode(F.array(*[row(i, F.col(f"m{i}")) for i in single])).alias("r"))
            .select("r.*")
        )
    for i, (metric, column, _) in enumerate(checks):
        if metric == "duplicateValues":
            repeats = frame.where(F.col(column).isNotNull()).groupBy(column).count()
            extra = F.coalesce(F.sum(F.col("count") - 1), F.lit(0))
            results.append(repeats.agg(extra.alias("d")).select(row(i, F.col("d")).alias("r")).select("r.*"))
    merged = results[0]
    for part in results[1:]:
        merged = merged.unionByName(part)
    return merged


def with_contract_metadata(frame: DataFrame, contract: Contract, as_of: datetime) -> DataFrame:
    """Add which contract judged the rows, its known limits and when."""
    limits = F.array(*[F.lit(text) for text in contract.limitations]).cast("array<string>")
    return frame.withColumns(
        {
            "contract_name": F.lit(contract.name),
            "contract_version": F.lit(contract.version),
            "contract_hash": F.lit(contract.fingerprint),
            "known_limitations": limits,
            "quality_evaluated_at": F.lit(as_of).cast("timestamp"),
        }
    )
