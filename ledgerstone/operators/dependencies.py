"""Checks between entities: missing parents, incomplete lifecycles, forbidden transitions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerstone.operators.joins import lookup, orphans
from ledgerstone.operators.ordered import time_chunk, with_neighbours
from ledgerstone.session import settle

GRACE_HOURS = 24

# The lifecycle an application must follow.
CORE_STAGES = ("SUBMITTED", "DOCUMENT_VERIFICATION", "ASSESSMENT")
TERMINAL_STAGE = {
    "ACCEPTED": "APPROVED",
    "APPROVED": "APPROVED",
    "DENIED": "DENIED",
    "REJECTED": "DENIED",
    "CANCELLED": "CANCELLED",
    "WITHDRAWN": "WITHDRAWN",
}
TRANSITIONS = (
    "SUBMITTED->DOCUMENT_VERIFICATION",
    "DOCUMENT_VERIFICATION->ASSESSMENT",
    "ASSESSMENT->CREDIT_CHECK",
    "ASSESSMENT->CONDITIONALLY_APPROVED",
    "ASSESSMENT->WITHDRAWN",
    "ASSESSMENT->CANCELLED",
    "CREDIT_CHECK->APPROVED",
    "CREDIT_CHECK->DENIED",
    "CONDITIONALLY_APPROVED->DOCUMENT_VERIFICATION",
    "DOCUMENT_VERIFICATION->APPROVED",
)


@dataclass(frozen=True)
class Relation:
    rule_id: str
    child: str
    child_key: str
    parent: str
    pairs: tuple[tuple[str, str], ...]


# The five relations that are checked after their grace period.
RELATIONS = (
    Relation("STAGE_APPLICATION_EXISTS", "app_stage_history", "history_id", "app_application", (("application_id", "application_id"),)),
    Relation("STATUS_APPLICATION_EXISTS", "app_status_change", "change_id", "app_application", (("application_id", "application_id"),)),
    Relation("DOCUMENT_APPLICATION_EXISTS", "app_missing_document", "document_id", "app_application", (("application_id", "application_id"),)),
    Relation("LIFECYCLE_APPLICATION_EXISTS", "app_lifecycle_event", "event_id", "app_application", (("application_id", "application_id"),)),
    Relation("CASE_EVENT_PARENT_EXISTS", "evt_case_event", "event_id", "evt_service_case", (("case_id", "case_id"),)),
)


def grace_hours(text: str) -> int:
    """Hours of a grace period such as ``24 hours``; other units are refused."""
    amount, _, unit = text.strip().lower().partition(" ")
    if not unit.strip().startswith("hour"):
        raise ValueError(f"grace period must be given in hours: {text!r}")
    return int(amount)


def _due(as_of: datetime, hours: int) -> Column:
    """Processed long enough ago for the other side to have arrived."""
    return F.col("processed_at") < F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(hours))


def _violations(
    frame: DataFrame, rule_id: str, child: str, child_key: Column, parent: str, parent_key: Column,
    details: Column, as_of: datetime, hours: int,
) -> DataFrame:
    return frame.select(
        F.sha2(F.concat_ws("|", F.lit(rule_id), child_key), 256).alias("violation_id"),
        F.lit(rule_id).alias("rule_id"),
        F.lit(child).alias("child_entity"),
        child_key.alias("child_key"),
        F.lit(parent).alias("parent_entity"),
        parent_key.alias("parent_key"),
        F.lit("OPEN").alias("violation_status"),
        (F.col("processed_at") + F.make_dt_interval(F.lit(0), F.lit(hours))).alias("grace_expires_at"),
        F.lit(as_of).cast("timestamp").alias("detected_at"),
        details.alias("details"),
    )


def _joined_key(columns: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def all_missing_parents(relations: Sequence[Relation], current: Callable[[str], DataFrame], as_of: datetime) -> DataFrame:
    """``missing_parents`` of many relations; the keys of a parent that several share are computed once."""
    columns = {r.parent: sorted({p for o in relations if o.parent == r.parent for _, p in o.pairs}) for r in relations}
    shared = [p for p in columns if sum(r.parent == p for r in relations) > 1]
    parents = {p: current(p).select(*c).distinct() for p, c in columns.items()}
    parents |= {p: settle(parents[p]) for p in shared}
    return reduce(DataFrame.unionByName, [missing_parents(r, current(r.child), parents[r.parent], as_of) for r in relations])


def missing_parents(
    relation: Relation, child: DataFrame, parent: DataFrame, as_of: datetime, hours: int = GRACE_HOURS
) -> DataFrame:
    """Child rows past their grace period whose parent does not exist."""
    late = child.where(_due(as_of, hours))
    columns = [c for c, _ in relation.pairs]
    reason = F.to_json(F.struct(F.lit("parent_not_found").alias("reason")))
    return _violations(
        orphans(late, parent, relation.pairs), relation.rule_id, relation.child, _joined_key([relation.child_key]),
        relation.parent, _joined_key(columns), reason, as_of, hours,
    )


def incomplete_lifecycles(
    applications: DataFrame, stages: DataFrame, as_of: datetime, hours: int = GRACE_HOURS,
    core: Sequence[str] = CORE_STAGES, terminal: Mapping[str, str] = TERMINAL_STAGE,
) -> DataFrame:
    """Finished applications that skipped a core stage or ended in the wrong one.

    Stages are made distinct per application before they are collected, so a
    set is as small as the stage vocabulary however long the history is.
    """
    seen = (
        stages.select("application_id", F.upper("stage").alias("stage"))
        .distinct()
        .groupBy("application_id")
        .agg(F.sort_array(F.collect_set("stage")).alias("observed_stages"))
    )
    outcome = F.upper("final_outcome")
    finished = applications.where(outcome.isin(*terminal) & _due(as_of, hours)).select(
        "application_id", "processed_at", "final_outcome"
    )
    expected = F.element_at(F.create_map(*[F.lit(x) for pair in terminal.items() for x in pair]), outcome)
    judged = (
        lookup(finished, seen, ["application_id"])
        .withColumn("observed_stages", F.coalesce("observed_stages", F.array().cast("array<string>")))
        .withColumns(
            {
                "missing_core_stages": F.array_except(F.array(*[F.lit(s) for s in core]), "observed_stages"),
                "expected_terminal_stage": expected,
            }
        )
        .where(
            (F.size("missing_core_stages") > 0)
            | F.col("expected_terminal_stage").isNull()
            | ~F.array_contains(F.col("observed_stages"), F.col("expected_terminal_stage"))
        )
    )
    details = F.to_json(F.struct("missing_core_stages", "expected_terminal_stage", "observed_stages"))
    key = F.col("application_id")
    return _violations(
        judged, "APPLICATION_STAGE_COMPLETENESS", "app_stage_history", key, "app_application", key, details, as_of, hours
    )


def forbidden_transitions(
    stages: DataFrame, as_of: datetime, hours: int = GRACE_HOURS, allowed: Sequence[str] = TRANSITIONS
) -> DataFrame:
    """Steps from one stage to the next that the lifecycle does not allow."""
    steps = with_neighbours(
        stages.select("history_id", "application_id", "processed_at", "entered_at", F.upper("stage").alias("stage")),
        ["application_id"],
        ["entered_at", "history_id"],
        time_chunk(F.col("entered_at")),
        previous=["stage"],
    ).withColumn("previous_stage", F.col("_previous.stage"))
    step = F.concat("previous_stage", F.lit("->"), "stage")
    wrong = steps.where(F.col("previous_stage").isNotNull() & _due(as_of, hours) & ~step.isin(*allowed))
    details = F.to_json(F.struct("previous_stage", F.col("stage").alias("current_stage")))
    return _violations(
        wrong, "APPLICATION_STAGE_TRANSITION", "app_stage_history", F.col("history_id"), "app_application",
        F.col("application_id"), details, as_of, hours,
    )
