"""The 19 governed entities: how each is built from its sources and kept.

An entity is a list of columns (name, kind, source column) plus a few derived
ones. ``typed`` turns the list into one projection; batch and streaming use the
same builder.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ledgerstone.functions import (
    amount_band,
    lower_text,
    mask_card,
    mask_email,
    mask_identifier,
    mask_phone,
    name_token,
    safe_bool,
    safe_date,
    safe_int,
    safe_timestamp,
    trimmed,
    upper_text,
)
from ledgerstone.operators.history import (
    OPERATION,
    SEQUENCE,
    TIE_BREAKS,
    current_snapshot,
    run_id,
    scd2,
    with_audit_columns,
    with_sequence,
)
from ledgerstone.operators.ordered import top_by
from ledgerstone.operators.quality import ERROR, compile_rules, passed
from ledgerstone.plans.contracts import SILVER_CONTRACTS, SOURCE_CONTRACTS

KINDS: dict[str, Callable[[Column], Column]] = {
    "text": lambda c: c.cast("string"),
    "trim": trimmed,
    "upper": upper_text,
    "lower": lower_text,
    "ts": safe_timestamp,
    "date": safe_date,
    "int": safe_int,
    "bool": safe_bool,
    "band": amount_band,
    "email": mask_email,
    "phone": mask_phone,
    "ident": mask_identifier,
    "card": mask_card,
    "present": lambda c: c.isNotNull(),
}

SCD2, APPEND, JOINED = "scd2", "append", "joined_scd2"


@dataclass(frozen=True)
class Entity:
    name: str
    mode: str
    source: str
    columns: tuple[tuple[str, str, str], ...]
    masked: bool = False
    derived: Mapping[str, Callable[[], Column]] = field(default_factory=dict)

    @property
    def keys(self) -> tuple[str, ...]:
        return SILVER_CONTRACTS[self.name].keys

    @property
    def bronze_table(self) -> str:
        prefix = "cdc" if self.mode != APPEND else ("file" if self.source in FILE_SOURCES else "event")
        return f"{prefix}_{self.source}"


FILE_SOURCES = ("accepted_loans", "rejected_applications")


def camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(part.capitalize() for part in rest)


def _columns(table: str) -> tuple[tuple[str, str, str], ...]:
    """One line per column: name, kind and, unless it is the camel-case name, the source column."""
    rows = [line.split() for line in table.strip().splitlines()]
    return tuple((r[0], r[1], r[2] if len(r) > 2 else camel(r[0])) for r in rows)


def _stage_days() -> Column:
    return F.datediff(safe_date(F.col("exitedAt")), safe_date(F.col("enteredAt")))


def _late(done: str, deadline: str) -> Column:
    """Null until both times are known."""
    return safe_timestamp(F.col(done)) > safe_timestamp(F.col(deadline))


ENTITIES: dict[str, Entity] = {
    e.name: e
    for e in (
        Entity(
            "app_application",
            SCD2,
            "loan_applications",
            _columns(
                """
                global_id text global_id
                application_id text
                organisation_id text
                is_business_application present organisationId
                num_offers trim
                loan_goal trim
                application_type upper
                final_outcome upper
                submitted_at ts
                last_updated_at ts
                requested_amount_masked band requestedAmount
                credit_score int
                """
            ),
            masked=True,
        ),
        Entity(
            "app_stage_history",
            APPEND,
            "application_stage_history",
            _columns(
                """
                history_id text
                application_id text
                global_id text global_id
                stage upper
                entered_at ts
                exited_at ts
                assigned_team trim
                sla_deadline ts
                pending_action_party upper
                """
            ),
            derived={
                "duration_days": _stage_days,
                "is_current_stage": lambda: F.col("exitedAt").isNull(),
                "is_sla_breached": lambda: _late("exitedAt", "slaDeadline"),
            },
        ),
        Entity(
            "app_status_change",
            APPEND,
            "status_change_history",
            _columns(
                """
                change_id text
                application_id text
                global_id text global_id
                old_status upper
                new_status upper
                changed_at ts
                reason trim
                """
            ),
        ),
        Entity(
            "app_missing_document",
            SCD2,
            "missing_documents",
            _columns(
                """
                document_id text
                application_id text
                global_id text global_id
                document_type trim
                status upper
                requested_at ts
                received_at ts
                expiry_date date
                reminders_sent int
                last_reminder_at ts
                rejection_reason trim
                """
            ),
            derived={"is_invalid_or_expired": lambda: upper_text(F.col("status")).isin("INVALID", "EXPIRED")},
        ),
        Entity(
            "app_lifecycle_event",
            APPEND,
            "loan_application_events",
            _columns(
                """
                event_id text
                application_id text
                global_id text global_id
                concept_name trim
                lifecycle_transition trim
                event_timestamp ts timestamp
                event_origin upper
                action trim
                """
            ),
        ),
        Entity(
            "app_accepted_loan",
            APPEND,
            "accepted_loans",
            _columns(
                """
                global_id text global_id
                loan_id text
                loan_status upper
                purpose trim
                term trim
                grade trim
                issued_at date
                loan_amount_masked band loanAmount
                """
            ),
            masked=True,
        ),
        Entity(
            "app_rejected_application",
            APPEND,
            "rejected_applications",
            _columns(
                """
                global_id text global_id
                loan_id text
                application_title trim
                application_date date
                rejection_reason trim
                """
            ),
        ),
        Entity("arr_banking_arrangement", JOINED, "banking_accounts", (), masked=True),
        Entity(
            "arr_loan",
            SCD2,
            "loan_accounts",
            _columns(
                """
                global_id text global_id
                loan_id text
                account_id text
                loan_type upper
                status upper
                repayment_frequency upper
                term_months int
                start_date date
                maturity_date date
                original_amount_masked band originalAmount
                current_balance_masked band currentBalance
                """
            ),
            masked=True,
            derived={"interest_type": lambda: F.lit(None).cast("string")},
        ),
        Entity(
            "arr_mortgage",
            SCD2,
            "mortgage_accounts",
            _columns(
                """
                global_id text global_id
                mortgage_id text
                account_id text
                interest_type upper
                repayment_frequency upper
                loan_term int
                start_date date
                lvr_percent trim
                loan_amount_masked band loanAmount
                """
            ),
            masked=True,
        ),
        Entity(
            "arr_credit_card",
            SCD2,
            "credit_cards",
            _columns(
                """
                global_id text global_id
                credit_card_id text
                organisation_id text
                is_business_arrangement present organisationId
                card_type upper
                status upper
                reward_program trim
                issued_date date
                card_number_masked card cardNumber
                credit_limit_masked band creditLimit
                """
            ),
            masked=True,
        ),
        Entity(
            "evt_service_case",
            SCD2,
            "service_cases",
            _columns(
                """
                case_id text
                global_id text global_id
                organisation_id text
                application_id text
                sla_deadline ts
                is_business_case present organisationId
                case_type upper
                subject trim
                status lower
                priority upper
                assigned_team trim
                created_at ts
                resolved_at ts
                resolution_summary trim
                """
            ),
            derived={"is_sla_breached": lambda: _late("resolvedAt", "slaDeadline")},
        ),
        Entity(
            "evt_support_interaction",
            APPEND,
            "support_interactions",
            _columns(
                """
                interaction_id text
                global_id text global_id
                channel upper
                interaction_timestamp ts timestamp
                topic trim
                resolution trim
                duration_minutes int
                """
            ),
        ),
        Entity(
            "evt_case_event",
            APPEND,
            "service_case_events",
            _columns(
                """
                event_id text
                case_id text
                global_id text global_id
                event_type upper
                event_timestamp ts
                description trim
                """
            ),
        ),
        Entity("ip_individual", JOINED, "customers", (), masked=True),
        Entity(
            "ip_kyc",
            SCD2,
            "kyc_records",
            _columns(
                """
                global_id text global_id
                kyc_id text
                organisation_id text
                verification_status upper
                verification_date date
                verification_method upper
                risk_rating upper
                pep_status bool
                sanctions_check upper
                last_review_date date
                next_review_date date
                document_types trim
                abn_verified bool
                asic_check_status upper
                beneficial_ownership_verified bool
                """
            ),
            derived={
                "record_type": lambda: F.when(F.col("organisationId").isNull(), "KYC").otherwise("KYB")
            },
        ),
        Entity(
            "ip_organisation",
            SCD2,
            "organisations",
            _columns(
                """
                global_id text global_id
                organisation_id text
                business_name trim
                legal_name trim
                short_name trim
                organisation_type upper
                industry_code trim
                industry_code_version trim
                registered_country upper
                is_acnc_registered bool isACNCRegistered
                agent_role upper
                abn_masked ident abn
                acn_masked ident acn
                establishment_date date
                last_updated_at ts lastUpdateTime
                """
            ),
            masked=True,
        ),
        Entity(
            "ip_party_relationship",
            SCD2,
            "organisation_party_relationships",
            _columns(
                """
                relationship_id text
                global_id text global_id
                organisation_id text
                party_role upper
                authority_level upper
                is_active bool
                start_date date
                end_date date
                """
            ),
        ),
        Entity(
            "ip_org_relationship",
            SCD2,
            "organisation_relationships",
            _columns(
                """
                relationship_id text
                source_org_id text
                target_org_id text
                relationship_type upper
                is_active bool
                start_date date
                """
            ),
        ),
    )
}

# Columns of the two joined entities, by side of the join.
INDIVIDUAL_CUSTOMER = _columns(
    """
    global_id text global_id
    customer_id text
    customer_type upper
    prefix trim
    middle_names trim
    gender upper
    age int
    state upper
    occupation_code trim
    email_masked email email
    phone_masked phone phoneNumber
    customer_since ts createdAt
    last_updated_at ts lastUpdateTime
    """
)
INDIVIDUAL_PREFERENCE = _columns(
    """
    preferred_contact_channel upper
    preferred_language trim
    marketing_opt_in bool
    satisfaction_score trim
    """
)
INDIVIDUAL_ADDRESS = _columns(
    """
    address_suburb trim suburb
    address_state upper state
    address_postcode trim postcode
    """
)
BANKING_ACCOUNT = _columns(
    """
    global_id text global_id
    account_id text
    organisation_id text
    is_business_arrangement present organisationId
    account_type upper
    is_active bool
    is_owner bool
    open_date date
    """
)
BANKING_BALANCE = _columns(
    """
    current_balance_masked band currentBalance
    available_balance_masked band availableBalance
    currency upper
    """
)


def projection(columns: Sequence[tuple[str, str, str]]) -> list[Column]:
    return [KINDS[kind](F.col(f"`{source}`")).alias(name) for name, kind, source in columns]


BATCH = "_batch_id"


def typed(entity: Entity, source: DataFrame, with_batch: bool = False) -> DataFrame:
    """Typed, cleaned and masked rows with audit columns; works on a batch or a stream.

    ``with_batch`` keeps the batch that a row came in, so that who picks few of the rows can name their run afterwards.
    """
    control = [SEQUENCE, OPERATION, *TIE_BREAKS] if entity.mode == SCD2 else []
    if entity.mode == SCD2:
        source = with_sequence(source)
    selected = source.select(
        *projection(entity.columns),
        *[build().alias(name) for name, build in entity.derived.items()],
        *[c for c in control if c in source.columns],
        BATCH,
        "_ingested_at",
    )
    audited = with_audit_columns(
        selected,
        [entity.bronze_table],
        [F.col(BATCH)],
        [F.col("_ingested_at")],
        "MASKED" if entity.masked else "CLEAN",
    )
    return audited.drop("_ingested_at") if with_batch else audited.drop(BATCH, "_ingested_at")


def _snapshot(sources: Callable[[str], DataFrame], name: str, keys: Sequence[str]) -> DataFrame:
    return current_snapshot(sources(name), keys, SOURCE_CONTRACTS[name].required)


def _side(frame: DataFrame, key: str, columns, prefix: str, extra: Sequence[Column] = ()) -> DataFrame:
    """One join side reduced to its key, its output columns and its load columns, before the join."""
    return frame.select(
        F.col(key).alias("_key"),
        *projection(columns),
        *extra,
        F.col("_batch_id").alias(f"_{prefix}_batch"),
        F.col("_ingested_at").alias(f"_{prefix}_at"),
    )


def _audited(joined: DataFrame, tables: Sequence[str], sides: Sequence[str]) -> DataFrame:
    out = with_audit_columns(
        joined,
        tables,
        [F.col(f"_{s}_batch") for s in sides],
        [F.col(f"_{s}_at") for s in sides],
        "MASKED",
    )
    return out.drop(*[c for c in out.columns if c.startswith("_")])


def banking_arrangement(sources: Callable[[str], DataFrame]) -> DataFrame:
    """Current accounts with their current balance."""
    accounts = _side(_snapshot(sources, "banking_accounts", ["accountId"]), "accountId", BANKING_ACCOUNT, "account")
    balances = _side(_snapshot(sources, "banking_balances", ["accountId"]), "accountId", BANKING_BALANCE, "balance")
    return _audited(
        accounts.join(balances, "_key", "left"),
        ["cdc_banking_accounts", "cdc_banking_balances"],
        ["account", "balance"],
    )


def individual(sources: Callable[[str], DataFrame], key: bytes) -> DataFrame:
    """Current customers with preferences and their best address; the home address wins."""
    full_name = F.concat_ws(" ", trimmed(F.col("firstName")), trimmed(F.col("lastName")))
    customers = _side(
        _snapshot(sources, "customers", ["global_id"]),
        "customerId",
        INDIVIDUAL_CUSTOMER,
        "customer",
        [full_name.alias("full_name"), name_token(full_name, key).alias("name_token")],
    )
    preferences = _side(
        _snapshot(sources, "customer_preferences", ["customerId"]),
        "customerId",
        INDIVIDUAL_PREFERENCE,
        "preference",
    )
    other = (~F.upper("purpose").isin("PRIMARY", "HOME", "RESIDENTIAL")).cast("int")
    best = top_by(
        _snapshot(sources, "physical_addresses", ["addressId"]),
        ["global_id"],
        [F.coalesce(other, F.lit(1)).asc(), F.col("_commit_ts").desc_nulls_last(), F.col("addressId").asc()],
        1,
    )
    addresses = _side(best, "global_id", INDIVIDUAL_ADDRESS, "address").withColumnRenamed("_key", "global_id")
    return _audited(
        customers.join(preferences, "_key", "left").join(addresses, "global_id", "left"),
        ["cdc_customers", "cdc_customer_preferences", "cdc_physical_addresses"],
        ["customer", "preference", "address"],
    )


def build(name: str, sources: Callable[[str], DataFrame], key: bytes, with_batch: bool = False) -> DataFrame:
    """Unvalidated rows of an entity: a change log, immutable records or a joined snapshot."""
    if name == "arr_banking_arrangement":
        return banking_arrangement(sources)
    if name == "ip_individual":
        return individual(sources, key)
    entity = ENTITIES[name]
    return typed(entity, source_passed(sources(entity.source), entity.source), with_batch)


def source_passed(frame: DataFrame, source: str) -> DataFrame:
    """Drop rows that lack a required source field. A plain conjunction, so it reaches the scan."""
    for name in SOURCE_CONTRACTS[source].required:
        frame = frame.where(F.col(f"`{name}`").isNotNull())
    return frame


def validated(name: str, frame: DataFrame, as_of: datetime) -> DataFrame:
    return passed(frame, compile_rules(SILVER_CONTRACTS[name], ERROR, as_of))


def deduplicated(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First delivery of each immutable record; ties broken by content, so replays agree."""
    rest = sorted(c for c in frame.columns if c not in keys and c != "processed_at")
    order = [F.col(c).asc_nulls_first() for c in ["processed_at", *rest]]
    return top_by(frame, keys, order, 1).drop("_rank")


def publish(name: str, changes: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """The stored form of validated rows: full history or deduplicated records.

    ``counted`` may give the rows before their rules, whose keys are cheaper to count.
    """
    entity = ENTITIES[name]
    if entity.mode == APPEND:
        return deduplicated(changes, entity.keys)
    return scd2(changes, entity.keys, counted=counted)


def current_rows(name: str, changes: DataFrame) -> DataFrame:
    """Open versions straight from validated changes, without building the history.

    The open version equals the latest change of each key that is no delete,
    which takes one top-1 step instead of the full history. Changes that keep their
    batch get the id of their run, a digest longer than the batch, after that step.
    """
    entity = ENTITIES[name]
    if entity.mode == APPEND:
        return deduplicated(changes, entity.keys)
    if entity.mode == JOINED:
        return changes
    order = [F.col(SEQUENCE), *[F.col(c) for c in TIE_BREAKS if c in changes.columns]]
    latest = top_by(changes, entity.keys, [c.desc_nulls_last() for c in order], 1)
    if BATCH in latest.columns:
        latest = latest.withColumn("pipeline_run_id", run_id([entity.bronze_table], [F.col(BATCH)])).drop(BATCH)
    return latest.where(F.col(OPERATION) != "DELETE").drop("_rank", SEQUENCE, OPERATION, *TIE_BREAKS)
