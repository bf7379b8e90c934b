"""Ordered listings of business objects with all that happened to them.

An object meets every row of each log beside it, as a reader of the sources would join
them, so a listing holds stages times changes rows of an application. The order is a
range sort: no task holds more than its range.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, functions as F

from ledgerstone.operators.joins import lookup

if TYPE_CHECKING:
    from ledgerstone.plans.warehouse import Warehouse


def application_lifecycle(w: Warehouse) -> DataFrame:
    """Applications with their stages and status changes, by application and time of entry.

    Equal status changes of an application are one row with their number until all is in order: the
    join and the sort handle distinct changes, and the listing repeats each as often as it stands there.
    """
    stages = w.silver("app_stage_history").select("application_id", "stage", "entered_at", "exited_at", "assigned_team", "pending_action_party")
    changes = w.silver("app_status_change").groupBy("application_id", "old_status", "new_status", "reason").agg(F.count("*").alias("_times"))
    listed = lookup(w.silver("app_application").select("application_id", "final_outcome"), stages, ["application_id"])
    ordered = lookup(listed, changes, ["application_id"]).orderBy("application_id", "entered_at", "old_status", "new_status")
    return ordered.withColumn("_times", F.explode(F.sequence(F.lit(1), F.coalesce("_times", F.lit(1)).cast("bigint")))).drop("_times")


def case_events(w: Warehouse) -> DataFrame:
    """Service cases with their organisation and events, by case and time."""
    cases = w.silver("evt_service_case").select("case_id", "case_type", "priority", "sla_deadline", "organisation_id")
    names = w.silver("ip_organisation").select("organisation_id", "business_name")
    events = w.silver("evt_case_event").select("case_id", "event_type", "event_timestamp", "description")
    listed = lookup(cases, names, ["organisation_id"])
    return lookup(listed, events, ["case_id"]).orderBy("case_id", "event_timestamp", "event_type")
