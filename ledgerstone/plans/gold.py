"""The 15 consumer-facing products: dimensions, facts, bridges and subject context.

Each builder takes a ``Warehouse`` (current governed rows and other products by
name) and its explicit clock. Every product reduces to its join key before it
joins, and joins through ``lookup`` so that rows without a party do not pile up
in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, functions as F

from ledgerstone.functions import age_band
from ledgerstone.operators.joins import lookup, salted_join
from ledgerstone.operators.ordered import time_chunk, top_by, with_neighbours, with_ordinal

if TYPE_CHECKING:
    from ledgerstone.plans.warehouse import Warehouse

# Fixed values.
PUBLISHABLE = ("MASKED", "CLEAN")
MISSING_STATES = ("PENDING", "MISSING", "REQUIRED")
RECEIVED_STATES = ("RECEIVED", "VERIFIED")
REJECTED_STATES = ("REJECTED", "INVALID")
TERMINAL_STAGES = ("APPROVED", "DENIED", "CANCELLED", "WITHDRAWN")
CLOSED_OUTCOMES = ("ACCEPTED", "APPROVED", "DENIED", "REJECTED", "CANCELLED", "WITHDRAWN")
OPEN_CASE_STATES = ("OPEN", "IN_PROGRESS", "PENDING")
FOLLOW_UP_PATTERN = "FOLLOW.?UP|CALL.?BACK|PENDING"
ESCALATION_PATTERN = "ESCALAT"
DEFAULT_CURRENCY = "AUD"
UNASSIGNED = "UNASSIGNED"
NO_POLICY = "POLICY_NOT_CONFIGURED"
DERIVED_AUTHORITY = "ORGANISATION_PARTY_ROLE_LOOKUP"
AUTHORITY_LIMIT = "APPLICATION_SPECIFIC_MANDATE_UNAVAILABLE"

# Business dates of each entity that bound the calendar.
BUSINESS_DATES = {
    "ip_individual": ("customer_since", "last_updated_at"),
    "ip_organisation": ("establishment_date", "last_updated_at"),
    "ip_kyc": ("verification_date", "last_review_date", "next_review_date"),
    "ip_party_relationship": ("start_date", "end_date"),
    "ip_org_relationship": ("start_date",),
    "arr_banking_arrangement": ("open_date",),
    "arr_loan": ("start_date", "maturity_date"),
    "arr_mortgage": ("start_date",),
    "arr_credit_card": ("issued_date",),
    "app_application": ("submitted_at", "last_updated_at"),
    "app_stage_history": ("entered_at", "exited_at", "sla_deadline"),
    "app_status_change": ("changed_at",),
    "app_lifecycle_event": ("event_timestamp",),
    "app_missing_document": ("requested_at", "received_at", "expiry_date", "last_reminder_at"),
    "app_accepted_loan": ("issued_at",),
    "app_rejected_application": ("application_date",),
    "evt_service_case": ("sla_deadline", "created_at", "resolved_at"),
    "evt_support_interaction": ("interaction_timestamp",),
    "evt_case_event": ("event_timestamp",),
}


def _null(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


def _publishable(frame: DataFrame) -> DataFrame:
    return frame.where(F.col("masking_status").isin(*PUBLISHABLE))


def _governed(w: Warehouse, name: str) -> DataFrame:
    return _publishable(w.silver(name))


def _with_customer(w: Warehouse, frame: DataFrame) -> DataFrame:
    """Add ``customer_id`` of the party, null where the party is unknown."""
    return lookup(frame, w.gold("dim_customer").select("global_id", "customer_id"), ["global_id"])


def _passed(frame: DataFrame) -> DataFrame:
    return frame.withColumn("dq_status", F.lit("PASSED"))


def dim_customer(w: Warehouse) -> DataFrame:
    kept = (
        "global_id customer_id customer_type name_token state occupation_code email_masked phone_masked"
        " preferred_contact_channel preferred_language marketing_opt_in satisfaction_score customer_since"
        " masking_status pipeline_run_id processed_at"
    ).split()
    return _passed(
        _governed(w, "ip_individual").select(
            *kept,
            age_band(F.col("age")).alias("age_band"),
            F.col("last_updated_at").alias("profile_last_updated_at"),
        )
    )


def dim_organisation(w: Warehouse) -> DataFrame:
    kept = (
        "global_id organisation_id business_name legal_name short_name organisation_type industry_code"
        " industry_code_version abn_masked acn_masked establishment_date masking_status pipeline_run_id"
        " processed_at"
    ).split()
    return _passed(
        _governed(w, "ip_organisation").select(
            *kept, F.col("last_updated_at").alias("profile_last_updated_at")
        )
    )


def calendar(bounds: DataFrame) -> DataFrame:
    """One row per day between ``first_day`` and ``last_day`` of a one-row frame."""
    day = F.col("full_date")
    return bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("full_date")).select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        day,
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.weekofyear(day).alias("week_of_year"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        (~F.dayofweek(day).isin(1, 7)).alias("is_business_day"),
    )


def dim_date(w: Warehouse) -> DataFrame:
    """Calendar over all business dates of all entities.

    Each entity gives its own minimum and maximum in one aggregate; the union
    holds one row per entity, never the dates themselves.
    """
    bounds = []
    for name, columns in BUSINESS_DATES.items():
        days = [F.col(c).cast("date") for c in columns]
        low, high = (F.least(*days), F.greatest(*days)) if len(days) > 1 else (days[0], days[0])
        bounds.append(w.dated(name).agg(F.min(low).alias("low"), F.max(high).alias("high")))
    return calendar(
        reduce(DataFrame.unionByName, bounds).agg(
            F.min("low").alias("first_day"), F.max("high").alias("last_day")
        )
    )


def dim_stage_action_policy(w: Warehouse) -> DataFrame:
    """Observed stage and party combinations; approved wording is not known yet."""
    party = F.coalesce("pending_action_party", F.lit(UNASSIGNED)).alias("pending_action_party")
    return (
        w.silver("app_stage_history")
        .where(F.col("stage").isNotNull())
        .select("stage", party)
        .distinct()
        .select(
            "stage",
            "pending_action_party",
            F.lit(NO_POLICY).alias("next_action_code"),
            _null().alias("banker_action_text"),
            _null().alias("customer_safe_action_text"),
            _null("int").alias("default_sla_days"),
            F.upper("stage").isin(*TERMINAL_STAGES).alias("is_terminal_stage"),
            F.lit("1970-01-01").cast("date").alias("effective_from"),
            _null("date").alias("effective_to"),
            F.lit(UNASSIGNED).alias("policy_owner"),
        )
    )


def _flagged_documents(w: Warehouse) -> DataFrame:
    """Documents with the flags of their state."""
    state = F.upper("document_status")
    past = F.col("expiry_date") < w.today
    documents = _governed(w, "app_missing_document").withColumnRenamed("status", "document_status")
    return documents.select(
        *"document_id application_id global_id document_type document_status requested_at received_at".split(),
        *"expiry_date reminders_sent last_reminder_at rejection_reason processed_at pipeline_run_id".split(),
        state.isin(*MISSING_STATES).alias("is_missing"),
        state.isin(*RECEIVED_STATES).alias("is_received"),
        state.isin(*REJECTED_STATES).alias("is_rejected"),
        (past | (state == "EXPIRED")).alias("is_expired"),
        (F.col("is_invalid_or_expired") | state.isin("INVALID", "EXPIRED") | past).alias("is_invalid_or_expired"),
    )


def fact_application_document(w: Warehouse) -> DataFrame:
    return _passed(_with_customer(w, _flagged_documents(w)))


def fact_application_timeline_event(w: Warehouse) -> DataFrame:
    """Stage, status and lifecycle events of each application in one sequence."""
    entered = ["entered_at", "history_id"]
    stages = with_neighbours(
        _governed(w, "app_stage_history"),
        ["application_id"],
        entered,
        time_chunk(F.col("entered_at")),
        previous=["stage"],
    )
    shared = ["global_id", "application_id", "masking_status"]
    lineage = F.col("pipeline_run_id").alias("source_pipeline_run_id")
    branches = [
        stages.select(
            *shared,
            lineage,
            F.lit("app_stage_history").alias("source_table"),
            F.col("history_id").alias("source_record_id"),
            F.col("entered_at").alias("event_timestamp"),
            F.lit("STAGE").alias("event_family"),
            F.lit("STAGE_TRANSITION").alias("event_type"),
            F.col("_previous.stage").alias("from_value"),
            F.col("stage").alias("to_value"),
            "stage",
            "assigned_team",
            "pending_action_party",
        ),
        _governed(w, "app_status_change").select(
            *shared,
            lineage,
            F.lit("app_status_change").alias("source_table"),
            F.col("change_id").alias("source_record_id"),
            F.col("changed_at").alias("event_timestamp"),
            F.lit("STATUS").alias("event_family"),
            F.lit("STATUS_CHANGE").alias("event_type"),
            F.col("old_status").alias("from_value"),
            F.col("new_status").alias("to_value"),
            F.col("new_status").alias("status"),
            F.col("reason").alias("recorded_reason"),
        ),
        _governed(w, "app_lifecycle_event").select(
            *shared,
            lineage,
            F.lit("app_lifecycle_event").alias("source_table"),
            F.col("event_id").alias("source_record_id"),
            "event_timestamp",
            F.lit("APPLICATION").alias("event_family"),
            F.coalesce("concept_name", F.lit("APPLICATION_EVENT")).alias("event_type"),
            "concept_name",
            "lifecycle_transition",
            "event_origin",
            "action",
        ),
    ]
    events = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), branches)
    numbered = with_ordinal(
        events,
        ["application_id"],
        ["event_timestamp", "event_family", "source_record_id"],
        time_chunk(F.col("event_timestamp")),
        "event_sequence",
    )
    named = numbered.withColumn("timeline_event_id", F.concat_ws(":", "source_table", "source_record_id"))
    return _passed(_with_customer(w, named))


def _stage_summary(w: Warehouse) -> tuple[DataFrame, DataFrame]:
    """Current and previous stage (two rows per application at most), and activity times."""
    stages = _governed(w, "app_stage_history")
    order = [F.col(c).desc() for c in ("is_current_stage", "entered_at", "history_id")]
    first, second = F.col("_rank") == 1, F.col("_rank") == 2
    now = {
        "current_stage": "stage",
        "current_stage_entered_at": "entered_at",
        "assigned_team": "assigned_team",
        "pending_action_party": "pending_action_party",
        "stage_sla_deadline": "sla_deadline",
    }
    ranked = (
        top_by(stages, ["application_id"], order, 2)
        .groupBy("application_id")
        .agg(
            *[F.max(F.when(first, F.col(c))).alias(name) for name, c in now.items()],
            F.max(F.when(second, F.col("stage"))).alias("previous_stage"),
            F.bool_or(F.when(first, F.col("is_sla_breached")).otherwise(F.lit(False))).alias("breached"),
        )
    )
    activity = stages.groupBy("application_id").agg(
        F.max("entered_at").alias("stage_activity_at"), F.max("processed_at").alias("stage_processed_at")
    )
    return ranked, activity


def _status_summary(w: Warehouse) -> tuple[DataFrame, DataFrame]:
    changes = _governed(w, "app_status_change")
    latest = top_by(
        changes, ["application_id"], [F.col("changed_at").desc(), F.col("change_id").desc()], 1
    ).select(
        "application_id",
        F.col("new_status").alias("changed_to"),
        F.col("changed_at").alias("status_last_changed_at"),
        F.col("reason").alias("recorded_reason"),
    )
    loads = changes.groupBy("application_id").agg(F.max("processed_at").alias("status_processed_at"))
    return latest, loads


def _document_summary(w: Warehouse) -> DataFrame:
    """Counts per application. A customer's name adds and drops no document, so it is not looked up to count them."""
    documents = w.gold("fact_application_document") if w.holds("gold", "fact_application_document") else _flagged_documents(w)
    flags = {
        "missing_document_count": "is_missing",
        "received_document_count": "is_received",
        "rejected_document_count": "is_rejected",
        "expired_document_count": "is_expired",
    }
    return (
        documents.groupBy("application_id")
        .agg(
            F.count("*").alias("required_document_count"),
            *[F.count_if(c).alias(name) for name, c in flags.items()],
            F.sum(F.coalesce("reminders_sent", F.lit(0))).alias("total_reminders_sent"),
            F.greatest(F.max("received_at"), F.max("requested_at"), F.max("last_reminder_at")).alias(
                "document_activity_at"
            ),
            F.max("processed_at").alias("document_processed_at"),
        )
    )


def fact_application_current(w: Warehouse) -> DataFrame:
    """One row per application with stage, status, documents and inactivity."""
    lifecycle = (
        _governed(w, "app_lifecycle_event")
        .groupBy("application_id")
        .agg(
            F.max("event_timestamp").alias("lifecycle_activity_at"),
            F.max("processed_at").alias("lifecycle_processed_at"),
        )
    )
    applications = _governed(w, "app_application").select(
        *"global_id application_id is_business_application loan_goal application_type submitted_at".split(),
        *"last_updated_at requested_amount_masked final_outcome masking_status processed_at".split(),
        "pipeline_run_id",
    )
    sides = [*_stage_summary(w), *_status_summary(w), _document_summary(w), lifecycle]
    star = reduce(lambda a, b: a.join(b, "application_id", "left"), sides, applications)

    activity = F.greatest(
        "last_updated_at",
        "stage_activity_at",
        "status_last_changed_at",
        "document_activity_at",
        "lifecycle_activity_at",
    )
    refreshed = F.greatest(
        "processed_at",
        "stage_processed_at",
        "status_processed_at",
        "document_processed_at",
        "lifecycle_processed_at",
    )
    counts = [
        f"{kind}_document_count" for kind in ("required", "missing", "received", "rejected", "expired")
    ] + ["total_reminders_sent"]
    party = F.upper("pending_action_party")
    shaped = star.withColumns(
        {
            "days_in_current_stage": F.datediff(w.today, F.col("current_stage_entered_at").cast("date")),
            "is_stage_sla_breached": F.coalesce("breached", F.lit(False)),
            "latest_status": F.coalesce("changed_to", "final_outcome"),
            "customer_action_required_flag": F.col("pending_action_party").isNotNull()
            & (party != "INTERNAL_TEAM"),
            "internal_action_required_flag": party == "INTERNAL_TEAM",
            "latest_activity_at": activity,
            "is_inactive_over_14_days": activity < w.before(days=14),
            "last_refreshed_at": refreshed,
            **{c: F.coalesce(c, F.lit(0)) for c in counts},
        }
    ).drop(
        "breached",
        "changed_to",
        "processed_at",
        *[c for c in star.columns if c.endswith(("_processed_at", "_activity_at"))],
    )
    return _passed(_with_customer(w, shaped))


def fact_arrangement_current(w: Warehouse) -> DataFrame:
    """Accounts, loans, mortgages and cards in one shape."""
    accounts = w.silver("arr_banking_arrangement")
    parents = accounts.select("account_id", "organisation_id", "currency")
    held = ["global_id", "masking_status", "processed_at"]
    parent = F.col("account_id").alias("parent_account_id")
    owner = [
        F.col("organisation_id"),
        F.col("organisation_id").isNotNull().alias("is_business_arrangement"),
        F.coalesce("currency", F.lit(DEFAULT_CURRENCY)).alias("currency"),
    ]
    bank = _publishable(accounts).select(
        *held,
        F.col("account_id").alias("arrangement_id"),
        F.lit("BANK_ACCOUNT").alias("arrangement_type"),
        "organisation_id",
        "is_business_arrangement",
        F.col("account_type").alias("arrangement_subtype"),
        F.when(F.col("is_active"), "ACTIVE").otherwise("INACTIVE").alias("arrangement_status"),
        "is_active",
        F.col("open_date").alias("start_date"),
        F.col("current_balance_masked").alias("balance_band"),
        F.col("available_balance_masked").alias("available_balance_band"),
        "currency",
    )
    loans = lookup(_governed(w, "arr_loan"), parents, ["account_id"]).select(
        *held,
        F.col("loan_id").alias("arrangement_id"),
        F.lit("LOAN").alias("arrangement_type"),
        parent,
        *owner,
        F.col("loan_type").alias("arrangement_subtype"),
        F.col("status").alias("arrangement_status"),
        (F.upper("status") == "ACTIVE").alias("is_active"),
        "start_date",
        "maturity_date",
        F.datediff("maturity_date", w.today).alias("days_to_maturity"),
        "interest_type",
        "repayment_frequency",
        "term_months",
        F.col("current_balance_masked").alias("balance_band"),
        F.col("original_amount_masked").alias("original_amount_band"),
    )
    months = F.col("loan_term") * 12
    end = F.add_months("start_date", months)
    running = (F.col("start_date") <= w.today) & (w.today < end)
    mortgages = lookup(_governed(w, "arr_mortgage"), parents, ["account_id"]).select(
        *held,
        F.col("mortgage_id").alias("arrangement_id"),
        F.lit("MORTGAGE").alias("arrangement_type"),
        parent,
        *owner,
        F.lit("MORTGAGE").alias("arrangement_subtype"),
        F.when(running, "ACTIVE_INFERRED").otherwise("INACTIVE_INFERRED").alias("arrangement_status"),
        running.alias("is_active"),
        "start_date",
        end.alias("maturity_date"),
        F.datediff(end, w.today).alias("days_to_maturity"),
        "interest_type",
        "repayment_frequency",
        months.alias("term_months"),
        F.col("loan_amount_masked").alias("loan_amount_band"),
    )
    cards = _governed(w, "arr_credit_card").select(
        *held,
        F.col("credit_card_id").alias("arrangement_id"),
        F.lit("CREDIT_CARD").alias("arrangement_type"),
        "organisation_id",
        "is_business_arrangement",
        F.col("card_type").alias("arrangement_subtype"),
        F.col("status").alias("arrangement_status"),
        (F.upper("status") == "ACTIVE").alias("is_active"),
        F.col("issued_date").alias("start_date"),
        F.col("credit_limit_masked").alias("credit_limit_band"),
        F.lit(DEFAULT_CURRENCY).alias("currency"),
        F.col("card_number_masked").alias("masked_identifier"),
    )
    merged = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [bank, loans, mortgages, cards]
    )
    return _passed(_with_customer(w, merged))


def bridge_organisation_party_role(w: Warehouse) -> DataFrame:
    kept = (
        "global_id relationship_id organisation_id party_role authority_level is_active start_date end_date"
        " pipeline_run_id processed_at"
    ).split()
    return _passed(_with_customer(w, _governed(w, "ip_party_relationship").select(*kept)))


def bridge_organisation_relationship(w: Warehouse) -> DataFrame:
    return _passed(
        _governed(w, "ip_org_relationship").select(
            "relationship_id",
            F.col("source_org_id").alias("source_organisation_id"),
            F.col("target_org_id").alias("target_organisation_id"),
            "relationship_type",
            "is_active",
            "start_date",
            "pipeline_run_id",
            "processed_at",
        )
    )


def bridge_application_party_authority(w: Warehouse) -> DataFrame:
    """Who may act on an application, derived from roles in its organisation.

    Roles are reduced to one row per (organisation, customer, role) before the
    join, so the join fans out by distinct roles only. The start date that wins
    is the latest; equal dates fall to the greater authority text.
    """
    dated = F.when(F.col("start_date").isNotNull(), F.struct("start_date", "authority_level"))
    roles = (
        w.gold("bridge_organisation_party_role")
        .groupBy("organisation_id", "customer_id", "party_role")
        .agg(
            F.max_by("authority_level", dated).alias("authority_level"),
            F.bool_or("is_active").alias("is_active"),
        )
    )
    applications = (
        _governed(w, "app_application")
        .where(F.col("organisation_id").isNotNull())
        .select("application_id", "organisation_id")
    )
    return salted_join(applications, roles, ["organisation_id"]).select(
        "application_id",
        "organisation_id",
        "customer_id",
        "party_role",
        "authority_level",
        "is_active",
        F.lit(DERIVED_AUTHORITY).alias("derivation_method"),
        F.lit(AUTHORITY_LIMIT).alias("limitation_code"),
    )


def fact_verification_current(w: Warehouse) -> DataFrame:
    kept = (
        "global_id kyc_id organisation_id record_type verification_status verification_method"
        " verification_date last_review_date next_review_date document_types abn_verified asic_check_status"
        " beneficial_ownership_verified risk_rating pep_status sanctions_check masking_status processed_at"
    ).split()
    rows = _governed(w, "ip_kyc").select(
        *kept, (F.col("next_review_date") < w.today).alias("review_overdue_flag")
    )
    return _passed(_with_customer(w, rows).drop("global_id"))


def fact_service_case_current(w: Warehouse) -> DataFrame:
    seconds = F.unix_timestamp("resolved_at") - F.unix_timestamp("created_at")
    cases = _governed(w, "evt_service_case").select(
        *"global_id case_id organisation_id application_id is_business_case case_type priority".split(),
        *"assigned_team created_at resolved_at resolution_summary sla_deadline is_sla_breached".split(),
        *"masking_status processed_at".split(),
        F.col("subject").alias("case_subject"),
        F.col("status").alias("case_status"),
        F.upper("status").isin(*OPEN_CASE_STATES).alias("is_open"),
        F.datediff(
            F.coalesce(F.col("resolved_at").cast("date"), w.today), F.col("created_at").cast("date")
        ).alias("case_age_days"),
        (seconds / F.lit("3600.0").cast("decimal(5,1)")).cast("decimal(27,6)").alias("resolution_duration_hours"),
        F.col("application_id").isNotNull().alias("application_related_flag"),
    )
    return _passed(_with_customer(w, cases))


def _service_flags(*columns: str) -> list[Column]:
    words = F.upper(F.concat_ws(" ", *columns))
    return [
        words.rlike(FOLLOW_UP_PATTERN).alias("follow_up_required_flag"),
        words.rlike(ESCALATION_PATTERN).alias("escalated_flag"),
    ]


def fact_service_activity(w: Warehouse) -> DataFrame:
    """Support interactions and case events in one stream of activity."""
    shared = ["global_id", "source_table", "masking_status", "processed_at"]
    interactions = _governed(w, "evt_support_interaction").select(
        *shared,
        F.col("interaction_id").alias("source_record_id"),
        F.col("interaction_timestamp").alias("activity_timestamp"),
        F.lit("SUPPORT_INTERACTION").alias("activity_type"),
        *"channel topic resolution duration_minutes".split(),
        F.lit(True).alias("is_customer_contact"),
        F.lit(False).alias("is_internal_activity"),
        *_service_flags("topic", "resolution"),
        F.concat(F.lit("SUPPORT_INTERACTION:"), "interaction_id").alias("service_activity_id"),
    )
    contacted = F.upper("event_type") == "CUSTOMER_CONTACTED"
    events = _governed(w, "evt_case_event").select(
        *shared,
        F.col("event_id").alias("source_record_id"),
        F.col("event_timestamp").alias("activity_timestamp"),
        F.lit("SERVICE_CASE_EVENT").alias("activity_type"),
        F.col("event_type").alias("case_event_type"),
        "description",
        contacted.alias("is_customer_contact"),
        (~contacted).alias("is_internal_activity"),
        *_service_flags("event_type", "description"),
        F.concat(F.lit("CASE_EVENT:"), "event_id").alias("service_activity_id"),
        F.col("case_id").alias("_case"),
    )
    cases = w.gold("fact_service_case_current").select(
        F.col("case_id").alias("_case"), "case_id", "application_id"
    )
    linked = lookup(events, cases, ["_case"]).drop("_case")
    return _passed(_with_customer(w, interactions.unionByName(linked, allowMissingColumns=True)))


# --- subject context ---------------------------------------------------------


def _latest(column: str, when: Column, tie: str) -> Column:
    """Value at the latest ``when``; equal times fall to the greater ``tie``."""
    return F.max_by(column, F.when(when.isNotNull(), F.struct(when.alias("at"), F.col(tie).alias("tie"))))


def _top_case_type(w: Warehouse, subject: str) -> DataFrame:
    recent = w.gold("fact_service_case_current").where(
        F.col(subject).isNotNull() & (F.col("created_at") >= w.before(days=90))
    )
    counted = recent.groupBy(subject, "case_type").agg(F.count("*").alias("cases"))
    return counted.groupBy(subject).agg(
        F.max_by("case_type", F.struct("cases", "case_type")).alias("top_case_type_90d")
    )


def _case_counts(w: Warehouse, subject: str, *extra: Column) -> DataFrame:
    return (
        w.gold("fact_service_case_current")
        .where(F.col(subject).isNotNull())
        .groupBy(subject)
        .agg(
            F.count_if("is_open").alias("open_case_count"),
            F.count_if("is_sla_breached").alias("sla_breached_case_count"),
            F.max("processed_at").alias("case_processed_at"),
            *extra,
        )
    )


def _application_counts(applications: DataFrame, subject: str) -> DataFrame:
    updated = F.coalesce("last_updated_at", "submitted_at")
    outcome = F.upper(F.coalesce("final_outcome", "latest_status", F.lit("PENDING")))
    latest = {
        "latest_application_id": "application_id",
        "latest_application_status": "latest_status",
        "latest_application_stage": "current_stage",
        "latest_pending_action_party": "pending_action_party",
        "latest_assigned_team": "assigned_team",
    }
    sums = [
        "missing_document_count",
        "rejected_document_count",
        "expired_document_count",
        "total_reminders_sent",
    ]
    return (
        applications.where(F.col(subject).isNotNull())
        .groupBy(subject)
        .agg(
            F.count_if(~outcome.isin(*CLOSED_OUTCOMES)).alias("open_application_count"),
            *[_latest(c, updated, "application_id").alias(name) for name, c in latest.items()],
            *[F.sum(c).alias(c) for c in sums],
            F.max("last_refreshed_at").alias("application_processed_at"),
        )
    )


def _arrangement_counts(w: Warehouse, subject: str) -> DataFrame:
    kinds = {
        "active_account_count": "BANK_ACCOUNT",
        "active_loan_count": "LOAN",
        "active_mortgage_count": "MORTGAGE",
        "active_credit_card_count": "CREDIT_CARD",
    }
    kind = F.col("arrangement_type")
    return (
        w.gold("fact_arrangement_current")
        .where(F.col(subject).isNotNull())
        .groupBy(subject)
        .agg(
            F.count_if("is_active").alias("active_arrangement_count"),
            *[F.count_if(F.col("is_active") & (kind == v)).alias(name) for name, v in kinds.items()],
            F.bool_or(kind == "MORTGAGE").alias("has_inferred_mortgage"),
            F.max("processed_at").alias("arrangement_processed_at"),
        )
    )


def _verification(w: Warehouse, subject: str, of_organisations: bool) -> DataFrame:
    rows = w.gold("fact_verification_current").where(F.col(subject).isNotNull())
    if not of_organisations:
        rows = rows.where(F.col("organisation_id").isNull())
    at = F.col("processed_at")
    return rows.groupBy(subject).agg(
        _latest("verification_status", at, "kyc_id").alias("verification_status"),
        _latest("review_overdue_flag", at, "kyc_id").alias("verification_review_overdue_flag"),
        F.max(at).alias("verification_processed_at"),
    )


def _roles(w: Warehouse, subject: str) -> DataFrame:
    active, role = F.col("is_active"), F.col("party_role")
    return (
        w.gold("bridge_organisation_party_role")
        .where(F.col(subject).isNotNull())
        .groupBy(subject)
        .agg(
            F.count_if(active & (role == "AUTHORISED_REPRESENTATIVE")).alias(
                "active_authorised_representative_count"
            ),
            F.count_if(active & (role == "DIRECTOR")).alias("active_director_count"),
            F.max("processed_at").alias("role_processed_at"),
        )
    )


CONTEXT_COUNTS = (
    "recent_support_interaction_count_30d open_case_count sla_breached_case_count open_application_count"
    " missing_document_count rejected_document_count expired_document_count total_reminders_sent"
    " active_arrangement_count active_account_count active_loan_count active_mortgage_count"
    " active_credit_card_count active_authorised_representative_count active_director_count"
).split()

CONTEXT_COLUMNS = (
    "snapshot_id entity_id entity_type customer_id organisation_id snapshot_timestamp"
    " preferred_contact_channel preferred_language marketing_opt_in satisfaction_score_current"
    " last_support_contact_at last_support_channel recent_support_interaction_count_30d top_case_type_90d"
    " open_case_count sla_breached_case_count open_application_count latest_application_id"
    " latest_application_status latest_application_stage latest_pending_action_party latest_assigned_team"
    " missing_document_count rejected_document_count expired_document_count total_reminders_sent"
    " active_arrangement_count active_account_count active_loan_count active_mortgage_count"
    " active_credit_card_count verification_status verification_review_overdue_flag"
    " active_authorised_representative_count active_director_count warning_codes source_max_processed_at"
).split()


def _context(
    w: Warehouse, subject: str, entity_type: str, base: DataFrame, sides: Sequence[DataFrame], codes: Sequence[Column]
) -> DataFrame:
    star = reduce(lambda a, b: a.join(b, subject, "left"), sides, base)
    clocks = [c for c in star.columns if c.endswith("processed_at")]
    newest = F.greatest(*clocks)
    stale = F.when(newest < w.before(hours=24), "STALE_CONTEXT")
    return star.withColumns(
        {
            "entity_id": F.col(subject),
            "entity_type": F.lit(entity_type),
            "source_max_processed_at": newest,
            "warning_codes": F.array_compact(F.array(*codes, stale)),
            **{c: F.coalesce(F.col(c), F.lit(0)) for c in CONTEXT_COUNTS if c in star.columns},
        }
    ).drop(*clocks, "has_inferred_mortgage")


def _code(condition: Column, name: str) -> Column:
    return F.when(condition, name)


def fact_subject_context_snapshot(w: Warehouse) -> DataFrame:
    """One context row per customer and per organisation.

    Every side is aggregated to the subject first, with subject-less rows left
    out, so the star joins are one row to one row.
    """
    unverified = _code(F.col("verification_status").isNull(), "VERIFICATION_CONTEXT_UNAVAILABLE")
    inferred = _code(F.col("has_inferred_mortgage"), "MORTGAGE_STATUS_INFERRED")
    no_policy = _code(F.col("latest_application_id").isNotNull(), "ACTION_POLICY_NOT_CONFIGURED")
    derived = _code(F.col("latest_application_id").isNotNull(), "APPLICATION_AUTHORITY_DERIVED")

    activity = w.gold("fact_service_activity").where(F.col("customer_id").isNotNull())
    contact = F.col("is_customer_contact")
    at = F.col("activity_timestamp")
    support = (
        activity.withColumn("_channel", F.when(contact, F.col("channel")))
        .groupBy("customer_id")
        .agg(
            F.max(F.when(contact, at)).alias("last_support_contact_at"),
            _latest("_channel", at, "service_activity_id").alias("last_support_channel"),
            F.count_if(
                (F.col("activity_type") == "SUPPORT_INTERACTION") & (at >= w.before(days=30))
            ).alias("recent_support_interaction_count_30d"),
            F.max("processed_at").alias("support_processed_at"),
        )
    )
    applications = w.gold("fact_application_current")
    customers = _context(
        w,
        "customer_id",
        "CUSTOMER",
        w.gold("dim_customer").select(
            "customer_id",
            *"preferred_contact_channel preferred_language marketing_opt_in processed_at".split(),
            F.col("satisfaction_score").alias("satisfaction_score_current"),
        ),
        [
            support,
            _top_case_type(w, "customer_id"),
            _case_counts(w, "customer_id"),
            _application_counts(applications, "customer_id"),
            _arrangement_counts(w, "customer_id"),
            _verification(w, "customer_id", False),
            _roles(w, "customer_id"),
        ],
        [unverified, inferred, no_policy],
    )
    links = w.gold("bridge_application_party_authority").select("application_id", "organisation_id").distinct()
    organisations = _context(
        w,
        "organisation_id",
        "ORGANISATION",
        w.gold("dim_organisation").select("organisation_id", "processed_at"),
        [
            _top_case_type(w, "organisation_id"),
            _case_counts(w, "organisation_id", F.max("created_at").alias("last_support_contact_at")),
            _application_counts(links.join(applications, "application_id"), "organisation_id"),
            _arrangement_counts(w, "organisation_id"),
            _verification(w, "organisation_id", True),
            _roles(w, "organisation_id"),
        ],
        [
            F.lit("ORGANISATION_CONTACT_PREFERENCE_UNAVAILABLE"),
            derived,
            no_policy,
            unverified,
            inferred,
        ],
    ).withColumn("recent_support_interaction_count_30d", F.lit(0).cast("bigint"))
    both = customers.unionByName(organisations, allowMissingColumns=True)
    identity = F.concat_ws("|", "entity_type", "entity_id", F.col("source_max_processed_at").cast("string"))
    return both.withColumns(
        {"snapshot_id": F.sha2(identity, 256), "snapshot_timestamp": F.col("source_max_processed_at")}
    ).select(*CONTEXT_COLUMNS)


PRODUCTS: dict[str, Callable[[Warehouse], DataFrame]] = {
    f.__name__: f
    for f in (
        dim_customer,
        dim_organisation,
        dim_date,
        dim_stage_action_policy,
        fact_application_document,
        fact_application_timeline_event,
        fact_application_current,
        fact_arrangement_current,
        bridge_organisation_party_role,
        bridge_organisation_relationship,
        bridge_application_party_authority,
        fact_verification_current,
        fact_service_case_current,
        fact_service_activity,
        fact_subject_context_snapshot,
    )
}
