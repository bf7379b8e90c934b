"""Which audits run on which products: natural keys, foreign keys, reconciliation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from types import MappingProxyType
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, functions as F

from ledgerstone.operators import audit

if TYPE_CHECKING:
    from ledgerstone.plans.warehouse import Warehouse

# Natural key of each product.
NATURAL_KEYS = {
    "dim_customer": ("customer_id",),
    "dim_organisation": ("organisation_id",),
    "dim_date": ("date_key",),
    "dim_stage_action_policy": ("stage", "pending_action_party", "effective_from"),
    "fact_application_document": ("document_id",),
    "fact_application_timeline_event": ("timeline_event_id",),
    "fact_application_current": ("application_id",),
    "fact_arrangement_current": ("arrangement_type", "arrangement_id"),
    "bridge_organisation_party_role": ("relationship_id",),
    "bridge_organisation_relationship": ("relationship_id",),
    "bridge_application_party_authority": ("application_id", "organisation_id", "customer_id", "party_role"),
    "fact_verification_current": ("kyc_id",),
    "fact_service_case_current": ("case_id",),
    "fact_service_activity": ("service_activity_id",),
    "fact_subject_context_snapshot": ("snapshot_id",),
}

_APP, _CUST, _ORG, _CASE = (
    ("application_id", "fact_application_current", "application_id"),
    ("customer_id", "dim_customer", "customer_id"),
    ("organisation_id", "dim_organisation", "organisation_id"),
    ("case_id", "fact_service_case_current", "case_id"),
)
# The 24 relations (child column, parent product, parent column) by child product.
FOREIGN_KEYS = {
    "fact_application_current": (_CUST,),
    "fact_application_document": (_APP, _CUST),
    "fact_application_timeline_event": (_APP, _CUST),
    "fact_arrangement_current": (_CUST, _ORG),
    "bridge_organisation_party_role": (_ORG, _CUST),
    "bridge_organisation_relationship": (
        ("source_organisation_id", "dim_organisation", "organisation_id"),
        ("target_organisation_id", "dim_organisation", "organisation_id"),
    ),
    "bridge_application_party_authority": (_APP, _ORG, _CUST),
    "fact_verification_current": (_CUST, _ORG),
    "fact_service_case_current": (_CUST, _ORG, _APP),
    "fact_service_activity": (_CUST, _CASE, _APP),
    "fact_subject_context_snapshot": (_CUST, _ORG),
}

# Columns of a product that the builders of other products name.
READ_BY_PRODUCTS = {
    name: tuple(columns.split())
    for name, columns in {
        "dim_customer": "global_id customer_id preferred_contact_channel preferred_language marketing_opt_in satisfaction_score processed_at",
        "dim_organisation": "organisation_id processed_at",
        "fact_application_document": "application_id is_missing is_received is_rejected is_expired reminders_sent received_at requested_at"
        " last_reminder_at processed_at",
        "fact_application_current": "application_id customer_id last_updated_at submitted_at final_outcome latest_status current_stage"
        " pending_action_party assigned_team missing_document_count rejected_document_count expired_document_count"
        " total_reminders_sent last_refreshed_at",
        "fact_arrangement_current": "customer_id organisation_id is_active arrangement_type processed_at",
        "bridge_organisation_party_role": "organisation_id customer_id party_role start_date authority_level is_active processed_at",
        "bridge_application_party_authority": "application_id organisation_id",
        "fact_verification_current": "customer_id organisation_id verification_status review_overdue_flag processed_at kyc_id",
        "fact_service_case_current": "case_id application_id customer_id organisation_id created_at case_type is_open is_sla_breached"
        " processed_at",
        "fact_service_activity": "customer_id is_customer_contact activity_timestamp channel service_activity_id activity_type processed_at",
    }.items()
}
# Entities whose current rows several products read, each after a sort of all their columns.
READ_ENTITIES = ("app_stage_history", "app_status_change", "app_lifecycle_event")


def key_columns(products: Iterable[str], read: Mapping[str, Sequence[str]]) -> dict[str, Sequence[str] | None]:
    """What to store of each product for an audit that reads the columns ``read``: these and what other products read; entities are whole."""
    return {p: tuple(dict.fromkeys([*READ_BY_PRODUCTS.get(p, ()), *read.get(p, ())])) for p in products} | dict.fromkeys(READ_ENTITIES)


def foreign_columns() -> dict[str, list[str]]:
    """Columns of each product that its relations name, as child or as parent."""
    found: dict[str, list[str]] = {}
    for child, relations in FOREIGN_KEYS.items():
        for column, parent, parent_column in relations:
            found.setdefault(child, []).append(column)
            found.setdefault(parent, []).append(parent_column)
    return found


# Governed entity, product and key columns that must meet within the refresh lag.
RECONCILED = (
    ("app_application", "fact_application_current", "application_id", "application_id"),
    ("app_missing_document", "fact_application_document", "document_id", "document_id"),
    ("evt_service_case", "fact_service_case_current", "case_id", "case_id"),
)

# What coded columns may hold, whatever the case of their letters.
ACCEPTED_VALUES = {
    "app_application": {"final_outcome": ("ACCEPTED", "APPROVED", "CANCELLED", "DENIED", "PENDING", "REJECTED", "WITHDRAWN")},
    "evt_service_case": {"status": ("OPEN", "IN_PROGRESS", "RESOLVED", "CLOSED")},
}

TIMELINE_PARTS = {
    "app_stage_history": "history_id",
    "app_status_change": "change_id",
    "app_lifecycle_event": "event_id",
}


def duplicates(w: Warehouse, products=tuple(NATURAL_KEYS)) -> DataFrame:
    return audit.together(audit.duplicate_keys(w.gold(p), p, NATURAL_KEYS[p]) for p in products)


def profiles(w: Warehouse, products=tuple(NATURAL_KEYS), required: Mapping[str, Sequence[str]] = MappingProxyType({})) -> DataFrame:
    """Repeated natural keys, null key columns and null ``required`` columns, one scan of each product."""
    return audit.together(audit.profile(w.gold(p), p, NATURAL_KEYS[p], [*NATURAL_KEYS[p], *required.get(p, ())]) for p in products)


def null_keys(w: Warehouse, products=tuple(NATURAL_KEYS)) -> DataFrame:
    return audit.together(audit.null_keys(w.gold(p), p, NATURAL_KEYS[p]) for p in products)


def hard_failures(w: Warehouse, products) -> DataFrame:
    return audit.together(audit.hard_failed(w.gold(p), p, NATURAL_KEYS[p]) for p in products)


def orphans(w: Warehouse) -> DataFrame:
    return audit.together(
        audit.orphan_keys(w.gold(child), f"{child}.{column}", w.gold(parent), [(column, parent_column)])
        for child, relations in FOREIGN_KEYS.items()
        for column, parent, parent_column in relations
    )


def reconciliation(w: Warehouse) -> DataFrame:
    return audit.together(
        audit.unreconciled(w.silver(entity), w.gold(product), entity, [(key, product_key)], w.as_of)
        for entity, product, key, product_key in RECONCILED
    )


def time_order(w: Warehouse) -> DataFrame:
    return audit.together(
        [
            audit.out_of_order(
                w.gold("fact_application_document"), "fact_application_document", ["document_id"], "requested_at", "received_at"
            ),
            audit.out_of_order(
                w.gold("fact_arrangement_current"), "fact_arrangement_current", ["arrangement_id"], "start_date", "maturity_date"
            ),
        ]
    )


def lost_events(w: Warehouse) -> DataFrame:
    parts = {name: (w.silver(name), key) for name, key in TIMELINE_PARTS.items()}
    return audit.lost_records(parts, w.gold("fact_application_timeline_event"), "fact_application_timeline_event")


def context(w: Warehouse) -> DataFrame:
    snapshot = w.gold("fact_subject_context_snapshot")
    return audit.together(
        [
            audit.duplicate_keys(snapshot, "fact_subject_context_snapshot", ["entity_type", "entity_id"]),
            audit.context_identity(snapshot),
            audit.context_codes(snapshot, "ORGANISATION", "ORGANISATION_CONTACT_PREFERENCE_UNAVAILABLE"),
            audit.invented_policy(w.gold("dim_stage_action_policy")),
        ]
    )


def leaked_columns(w: Warehouse, products) -> DataFrame:
    """Forbidden columns in context, parties and, for compliance fields, anywhere but verification."""
    spark = w.gold(products[0]).sparkSession
    gold = {p: w.gold(p) for p in products}
    parties = {p: w.silver(p) for p in ("ip_individual", "ip_organisation")}
    snapshot = {p: f for p, f in gold.items() if p == "fact_subject_context_snapshot"}
    others = {p: f for p, f in gold.items() if p != "fact_verification_current"}
    checks = [
        (snapshot, audit.FORBIDDEN_IN_CONTEXT),
        (parties, audit.FORBIDDEN_IN_PARTIES),
        (others, audit.RESTRICTED_COMPLIANCE),
    ]
    return audit.together(audit.forbidden_columns(audit.schema_rows(spark, f), d) for f, d in checks if f)


def open_rows(w: Warehouse, histories) -> DataFrame:
    """Keys with several open versions, and applications with several current stages."""
    parts = [
        audit.several_open(w.history(e), e, w_keys, F.col("__END_AT").isNull()) for e, w_keys in histories.items()
    ]
    stages = w.silver("app_stage_history")
    return audit.together(
        [*parts, audit.several_open(stages, "app_stage_history", ["application_id"], F.col("is_current_stage"))]
    )
