"""DuckDB statements for the governed entities and products, composed from named parts.

Parts are named ``src_``, ``raw_`` (typed), ``chg_`` (rules passed), ``cur_``
(current rows), ``his_`` (history) and ``gold_``. ``compose`` collects the parts
a statement mentions into one WITH clause.
"""

from __future__ import annotations

import hashlib
import re

from checks.estate import AS_OF, CHECK_KEY, oracle_source
from ledgerstone.operators.quality import ERROR, compile_rules
from checks.required import REQUIRED
from ledgerstone.plans.contracts import SILVER_CONTRACTS
from ledgerstone.plans.silver import (
    APPEND,
    BANKING_ACCOUNT,
    BANKING_BALANCE,
    ENTITIES,
    INDIVIDUAL_ADDRESS,
    INDIVIDUAL_CUSTOMER,
    INDIVIDUAL_PREFERENCE,
    JOINED,
    SCD2,
)

TODAY = f"DATE '{AS_OF:%Y-%m-%d}'"
NOW = f"TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}'"


def trim(x: str) -> str:
    return f"nullif(trim(CAST({x} AS VARCHAR)), '')"


def strip(x: str, pattern: str) -> str:
    return f"regexp_replace({trim(x)}, '{pattern}', '', 'g')"


def band(x: str) -> str:
    return band_of(f"TRY_CAST({strip(x, '[^0-9.-]')} AS DECIMAL(18,2))")


def band_of(v: str) -> str:
    return (
        f"CASE WHEN {v} IS NULL THEN NULL WHEN {v} >= 1000000 THEN '$1M+' WHEN {v} >= 500000 THEN '$500K-$999,999'"
        f" WHEN {v} >= 100000 THEN '$100K-$499,999' WHEN {v} >= 50000 THEN '$50K-$99,999'"
        f" WHEN {v} >= 10000 THEN '$10K-$49,999' WHEN {v} >= 5000 THEN '$5K-$9,999'"
        f" WHEN {v} >= 1000 THEN '$1K-$4,999' WHEN {v} >= 0 THEN '$0-$999' ELSE 'NEGATIVE' END"
    )


def age(x: str) -> str:
    return (
        f"CASE WHEN {x} >= 65 THEN '65_PLUS' WHEN {x} >= 55 THEN '55_64' WHEN {x} >= 45 THEN '45_54'"
        f" WHEN {x} >= 35 THEN '35_44' WHEN {x} >= 25 THEN '25_34' WHEN {x} >= 18 THEN '18_24'"
        f" WHEN {x} < 18 THEN 'UNDER_18' ELSE 'UNKNOWN' END"
    )


def email(x: str) -> str:
    v = f"lower({trim(x)})"
    return f"CASE WHEN regexp_full_match({v}, '[^@]+@[^@]+') THEN left({v}, 1) || '***@' || split_part({v}, '@', 2) END"


def phone(x: str) -> str:
    d = strip(x, r"\D")
    return f"CASE WHEN length({d}) > 1 THEN left({d}, 2) || 'XX XXX XXX' END"


def identifier(x: str) -> str:
    d = strip(x, r"\s")
    return f"CASE WHEN length({d}) > 2 THEN '********' || right({d}, 3) END"


def card(x: str) -> str:
    d = strip(x, r"\D")
    return f"CASE WHEN length({d}) > 3 THEN '**** **** **** ' || right({d}, 4) END"


def hmac(message: str, key: bytes = CHECK_KEY) -> str:
    block = key.ljust(64, b"\0")
    inner, outer = (bytes(b ^ p for b in block).hex() for p in (0x36, 0x5C))
    return f"sha256(from_hex('{outer}') || from_hex(sha256(from_hex('{inner}') || encode({message}))))"


def token(x: str) -> str:
    return hmac(rf"trim(regexp_replace(lower({x}), '\s+', ' ', 'g'))")


KINDS = {
    "text": lambda x: f"CAST({x} AS VARCHAR)",
    "trim": trim,
    "upper": lambda x: f"upper({trim(x)})",
    "lower": lambda x: f"lower({trim(x)})",
    "ts": lambda x: f"TRY_CAST({x} AS TIMESTAMP)",
    "date": lambda x: f"TRY_CAST({x} AS DATE)",
    "int": lambda x: f"TRY_CAST({x} AS INTEGER)",
    "bool": lambda x: f"TRY_CAST({x} AS BOOLEAN)",
    "band": band,
    "email": email,
    "phone": phone,
    "ident": identifier,
    "card": card,
    "present": lambda x: f"({x} IS NOT NULL)",
}

_LATE = "TRY_CAST({0} AS TIMESTAMP) > TRY_CAST({1} AS TIMESTAMP)"
DERIVED = {
    "app_stage_history": {
        "duration_days": "CAST(date_diff('day', TRY_CAST(enteredAt AS DATE), TRY_CAST(exitedAt AS DATE)) AS INTEGER)",
        "is_current_stage": "exitedAt IS NULL",
        "is_sla_breached": _LATE.format("exitedAt", "slaDeadline"),
    },
    "app_missing_document": {"is_invalid_or_expired": "upper(trim(status)) IN ('EXPIRED', 'INVALID')"},
    "arr_loan": {"interest_type": "CAST(NULL AS VARCHAR)"},
    "evt_service_case": {"is_sla_breached": _LATE.format("resolvedAt", "slaDeadline")},
    "ip_kyc": {"record_type": "if(organisationId IS NULL, 'KYC', 'KYB')"},
}


def fields(columns, alias: str = "") -> str:
    return ", ".join(f'{KINDS[kind](alias + chr(34) + src + chr(34))} AS {name}' for name, kind, src in columns)


def predicate(expression: str) -> str:
    """A declared rule in DuckDB's dialect."""
    sql = re.sub(r"(\w+) RLIKE ('[^']*')", r"regexp_matches(\1, \2)", expression)
    return re.sub(r"date_sub\((DATE'[^']*'), (\d+)\)", r"(\1 - \2)", sql)


def hard_rules(name: str) -> dict[str, str]:
    return {k: predicate(v) for k, v in compile_rules(SILVER_CONTRACTS[name], ERROR, AS_OF).items()}


def complete(source: str) -> str:
    need = [f'"{c}" IS NOT NULL' for c in REQUIRED[source][1].split()]
    return " AND ".join(need) or "true"


def audit(tables: str, batches: str, at: str, status: str) -> str:
    return (
        f"sha256(concat_ws('|', '{tables}', {batches})) AS pipeline_run_id, '{tables}' AS source_table,"
        f" {at} AS processed_at, '{status}' AS masking_status"
    )


def _snapshot(source: str, key: str) -> str:
    return f"""(SELECT * FROM (SELECT * FROM src_{source} WHERE {complete(source)}
      QUALIFY row_number() OVER (PARTITION BY "{key}" ORDER BY _source_lsn DESC, _commit_ts DESC, _kafka_offset DESC) = 1)
      WHERE _operation <> 'DELETE')"""


def _individual() -> str:
    full = f"concat_ws(' ', {trim('c.firstName')}, {trim('c.lastName')})"
    batches = "coalesce(c._batch_id, ''), coalesce(p._batch_id, ''), coalesce(a._batch_id, '')"
    return f"""
    SELECT {fields(INDIVIDUAL_CUSTOMER, 'c.')}, {full} AS full_name, {token(full)} AS name_token,
      {fields(INDIVIDUAL_PREFERENCE, 'p.')}, {fields(INDIVIDUAL_ADDRESS, 'a.')},
      {audit('cdc_customer_preferences,cdc_customers,cdc_physical_addresses', batches,
             'greatest(c._ingested_at, p._ingested_at, a._ingested_at)', 'MASKED')}
    FROM {_snapshot('customers', 'global_id')} c
    LEFT JOIN {_snapshot('customer_preferences', 'customerId')} p ON p.customerId = c.customerId
    LEFT JOIN (SELECT * FROM {_snapshot('physical_addresses', 'addressId')} QUALIFY row_number() OVER (
        PARTITION BY global_id
        ORDER BY (upper(purpose) IN ('PRIMARY', 'HOME', 'RESIDENTIAL')) DESC, _commit_ts DESC, addressId) = 1) a
      ON a.global_id = c.global_id"""


def _arrangement() -> str:
    return f"""
    SELECT {fields(BANKING_ACCOUNT, 'a.')}, {fields(BANKING_BALANCE, 'b.')},
      {audit('cdc_banking_accounts,cdc_banking_balances', "coalesce(a._batch_id, ''), coalesce(b._batch_id, '')",
             'greatest(a._ingested_at, b._ingested_at)', 'MASKED')}
    FROM {_snapshot('banking_accounts', 'accountId')} a
    LEFT JOIN {_snapshot('banking_balances', 'accountId')} b ON b.accountId = a.accountId"""


def raw(name: str) -> str:
    if name == "ip_individual":
        return _individual()
    if name == "arr_banking_arrangement":
        return _arrangement()
    e = ENTITIES[name]
    control = ""
    if e.mode == SCD2:
        control = "coalesce(_commit_ts, _captured_at, _ingested_at) AS _sequence_ts, _operation, _source_lsn, _kafka_offset,"
    derived = "".join(f"{sql} AS {col}, " for col, sql in DERIVED.get(name, {}).items())
    status = "MASKED" if e.masked else "CLEAN"
    return f"""
    SELECT {fields(e.columns)}, {derived}{control}
      {audit(e.bronze_table, "coalesce(_batch_id, '')", '_ingested_at', status)}
    FROM src_{e.source} WHERE {complete(e.source)}"""


def columns_of(name: str) -> list[str]:
    e = ENTITIES[name]
    return [c for c, _, _ in e.columns] + list(e.derived)


def chg(name: str) -> str:
    return f"SELECT * FROM raw_{name} WHERE " + " AND ".join(f"coalesce({p}, false)" for p in hard_rules(name).values())


def cur(name: str) -> str:
    e, key = ENTITIES[name], ENTITIES[name].keys[0]
    if e.mode == JOINED:
        return f"SELECT * FROM chg_{name}"
    if e.mode == APPEND:
        rest = sorted([c for c in columns_of(name) if c != key] + ["pipeline_run_id", "source_table", "masking_status"])
        order = ", ".join(f"{c} ASC NULLS FIRST" for c in ["processed_at", *rest])
        return f"SELECT * FROM chg_{name} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"
    return f"""SELECT * EXCLUDE (_sequence_ts, _operation, _source_lsn, _kafka_offset) FROM (
      SELECT * FROM chg_{name} QUALIFY row_number() OVER (
        PARTITION BY {key} ORDER BY _sequence_ts DESC, _source_lsn DESC, _kafka_offset DESC) = 1)
      WHERE _operation <> 'DELETE'"""


def scd2_sql(source: str, key: str, tracked: list[str], untracked: list[str], order: str, gone: str, seq: str) -> str:
    """Type 2 history by run numbering: mark starts, number runs, take each run's last row."""
    state = "row(" + ", ".join(["__gone", *[f"CASE WHEN NOT __gone THEN {c} END" for c in tracked]]) + ")"
    kept = ", ".join([key, *tracked, *untracked])
    return f"""
    SELECT {kept}, __START_AT, __END_AT FROM (
      SELECT *, lead(__START_AT) OVER (PARTITION BY {key} ORDER BY __run) AS __END_AT FROM (
        SELECT *, min({seq}) OVER (PARTITION BY {key}, __run) AS __START_AT FROM (
          SELECT *, sum(__starts) OVER (PARTITION BY {key} ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS __run FROM (
            SELECT *, CASE WHEN lag(__one) OVER w IS NULL OR lag({state}) OVER w IS DISTINCT FROM {state} THEN 1 ELSE 0 END AS __starts
            FROM (SELECT *, 1 AS __one, ({gone}) AS __gone FROM {source})
            WINDOW w AS (PARTITION BY {key} ORDER BY {order})))
        QUALIFY row_number() OVER (PARTITION BY {key}, __run ORDER BY {', '.join(o + ' DESC' for o in order.split(', '))}) = 1))
    WHERE NOT __gone"""


def his(name: str) -> str:
    e = ENTITIES[name]
    if e.mode != SCD2:
        return f"SELECT * FROM cur_{name}"
    key = e.keys[0]
    tracked = [c for c in columns_of(name) if c != key]
    audits = ["pipeline_run_id", "source_table", "processed_at", "masking_status"]
    return scd2_sql(
        f"chg_{name}", key, tracked, audits, "_sequence_ts, _source_lsn, _kafka_offset", "_operation = 'DELETE'", "_sequence_ts"
    )


CUSTOMER = "LEFT JOIN (SELECT global_id AS gid, customer_id FROM gold_dim_customer) party ON party.gid = {0}.global_id"
_OK = "masking_status IN ('CLEAN', 'MASKED')"


def _dates() -> str:
    from ledgerstone.plans.gold import BUSINESS_DATES

    parts = []
    for name, cols in BUSINESS_DATES.items():
        parts += [f"SELECT CAST({c} AS DATE) AS d FROM his_{name}" for c in cols]
    return " UNION ALL ".join(parts)


def _subject_counts(subject: str) -> dict[str, str]:
    """The aggregates that both halves of the context share, by subject column."""
    live = f"{subject} IS NOT NULL"
    apps = (
        "gold_fact_application_current"
        if subject == "customer_id"
        else "(SELECT f.*, l.organisation_id FROM (SELECT DISTINCT application_id, organisation_id FROM"
        " gold_bridge_application_party_authority) l JOIN gold_fact_application_current f USING (application_id))"
    )
    moment = "coalesce(last_updated_at, submitted_at)"

    def last(c: str) -> str:
        return f"arg_max_null({c}, CASE WHEN {moment} IS NOT NULL THEN row({moment}, application_id) END)"

    kyc = f"{live} AND organisation_id IS NULL" if subject == "customer_id" else live
    return {
        "types": f"""SELECT {subject}, arg_max_null(case_type, row(n, case_type)) AS top_case_type_90d FROM (
            SELECT {subject}, case_type, count(*) AS n FROM gold_fact_service_case_current
            WHERE {live} AND created_at >= {NOW} - INTERVAL 90 DAY GROUP BY ALL) GROUP BY ALL""",
        "cases": f"""SELECT {subject}, count(*) FILTER (WHERE is_open) AS open_case_count,
            count(*) FILTER (WHERE is_sla_breached) AS sla_breached_case_count, max(created_at) AS last_case_at,
            max(processed_at) AS at FROM gold_fact_service_case_current WHERE {live} GROUP BY ALL""",
        "apps": f"""SELECT {subject}, count(*) FILTER (WHERE upper(coalesce(final_outcome, latest_status, 'PENDING'))
              NOT IN ('ACCEPTED', 'APPROVED', 'DENIED', 'REJECTED', 'CANCELLED', 'WITHDRAWN')) AS open_application_count,
            {last('application_id')} AS latest_application_id, {last('latest_status')} AS latest_application_status,
            {last('current_stage')} AS latest_application_stage, {last('pending_action_party')} AS latest_pending_action_party,
            {last('assigned_team')} AS latest_assigned_team,
            CAST(sum(missing_document_count) AS BIGINT) AS missing_document_count,
            CAST(sum(rejected_document_count) AS BIGINT) AS rejected_document_count,
            CAST(sum(expired_document_count) AS BIGINT) AS expired_document_count,
            CAST(sum(total_reminders_sent) AS BIGINT) AS total_reminders_sent, max(last_refreshed_at) AS at
            FROM {apps} WHERE {live} GROUP BY {subject}""",
        "arrs": f"""SELECT {subject}, count(*) FILTER (WHERE is_active) AS active_arrangement_count,
            count(*) FILTER (WHERE is_active AND arrangement_type = 'BANK_ACCOUNT') AS active_account_count,
            count(*) FILTER (WHERE is_active AND arrangement_type = 'LOAN') AS active_loan_count,
            count(*) FILTER (WHERE is_active AND arrangement_type = 'MORTGAGE') AS active_mortgage_count,
            count(*) FILTER (WHERE is_active AND arrangement_type = 'CREDIT_CARD') AS active_credit_card_count,
            bool_or(arrangement_type = 'MORTGAGE') AS inferred, max(processed_at) AS at
            FROM gold_fact_arrangement_current WHERE {live} GROUP BY ALL""",
        "kyc": f"""SELECT {subject}, arg_max_null(verification_status, row(processed_at, kyc_id)) AS verification_status,
            arg_max_null(review_overdue_flag, row(processed_at, kyc_id)) AS verification_review_overdue_flag,
            max(processed_at) AS at FROM gold_fact_verification_current WHERE {kyc} GROUP BY {subject}""",
        "roles": f"""SELECT {subject},
            count(*) FILTER (WHERE is_active AND party_role = 'AUTHORISED_REPRESENTATIVE') AS active_authorised_representative_count,
            count(*) FILTER (WHERE is_active AND party_role = 'DIRECTOR') AS active_director_count, max(processed_at) AS at
            FROM gold_bridge_organisation_party_role WHERE {live} GROUP BY ALL""",
    }


_SHARED_CONTEXT = """types.top_case_type_90d, coalesce(cases.open_case_count, 0) AS open_case_count,
      coalesce(cases.sla_breached_case_count, 0) AS sla_breached_case_count,
      coalesce(apps.open_application_count, 0) AS open_application_count, apps.latest_application_id,
      apps.latest_application_status, apps.latest_application_stage, apps.latest_pending_action_party,
      apps.latest_assigned_team, coalesce(apps.missing_document_count, 0) AS missing_document_count,
      coalesce(apps.rejected_document_count, 0) AS rejected_document_count,
      coalesce(apps.expired_document_count, 0) AS expired_document_count,
      coalesce(apps.total_reminders_sent, 0) AS total_reminders_sent,
      coalesce(arrs.active_arrangement_count, 0) AS active_arrangement_count,
      coalesce(arrs.active_account_count, 0) AS active_account_count,
      coalesce(arrs.active_loan_count, 0) AS active_loan_count,
      coalesce(arrs.active_mortgage_count, 0) AS active_mortgage_count,
      coalesce(arrs.active_credit_card_count, 0) AS active_credit_card_count, kyc.verification_status,
      kyc.verification_review_overdue_flag,
      coalesce(roles.active_authorised_representative_count, 0) AS active_authorised_representative_count,
      coalesce(roles.active_director_count, 0) AS active_director_count"""


def _half(subject: str, kind: str, base: str, head: str, codes: list[str], extra_join: str, clocks: str) -> str:
    parts = _subject_counts(subject)
    joins = " ".join(f"LEFT JOIN ({sql}) {name} ON {name}.{subject} = b.{subject}" for name, sql in parts.items())
    newest = f"greatest(b.processed_at, {clocks})"
    stale = f"CASE WHEN {newest} < {NOW} - INTERVAL 24 HOUR THEN 'STALE_CONTEXT' END"
    return f"""
    SELECT b.{subject} AS entity_id, '{kind}' AS entity_type, {head}, {_SHARED_CONTEXT},
      concat_ws(',', {', '.join([*codes, stale])}) AS warning_codes, {newest} AS source_max_processed_at
    FROM {base} b {joins} {extra_join}"""


def _context() -> str:
    unverified = "CASE WHEN kyc.verification_status IS NULL THEN 'VERIFICATION_CONTEXT_UNAVAILABLE' END"
    inferred = "CASE WHEN arrs.inferred THEN 'MORTGAGE_STATUS_INFERRED' END"
    policy = "CASE WHEN apps.latest_application_id IS NOT NULL THEN 'ACTION_POLICY_NOT_CONFIGURED' END"
    derived = "CASE WHEN apps.latest_application_id IS NOT NULL THEN 'APPLICATION_AUTHORITY_DERIVED' END"
    support = f"""LEFT JOIN (SELECT customer_id, max(activity_timestamp) FILTER (WHERE is_customer_contact) AS last_support_contact_at,
        arg_max_null(CASE WHEN is_customer_contact THEN channel END, row(activity_timestamp, service_activity_id)) AS last_support_channel,
        count(*) FILTER (WHERE activity_type = 'SUPPORT_INTERACTION' AND activity_timestamp >= {NOW} - INTERVAL 30 DAY) AS recent,
        max(processed_at) AS at FROM gold_fact_service_activity WHERE customer_id IS NOT NULL GROUP BY customer_id) sup
        ON sup.customer_id = b.customer_id"""
    customers = _half(
        "customer_id",
        "CUSTOMER",
        "gold_dim_customer",
        "b.customer_id, CAST(NULL AS VARCHAR) AS organisation_id, b.preferred_contact_channel, b.preferred_language,"
        " b.marketing_opt_in, b.satisfaction_score AS satisfaction_score_current, sup.last_support_contact_at,"
        " sup.last_support_channel, coalesce(sup.recent, 0) AS recent_support_interaction_count_30d",
        [unverified, inferred, policy],
        support,
        "sup.at, cases.at, apps.at, arrs.at, kyc.at, roles.at",
    )
    organisations = _half(
        "organisation_id",
        "ORGANISATION",
        "gold_dim_organisation",
        "CAST(NULL AS VARCHAR) AS customer_id, b.organisation_id, NULL, NULL, NULL, NULL, cases.last_case_at, NULL, 0",
        ["'ORGANISATION_CONTACT_PREFERENCE_UNAVAILABLE'", derived, policy, unverified, inferred],
        "",
        "cases.at, apps.at, arrs.at, kyc.at, roles.at",
    )
    return f"""
    SELECT sha256(concat_ws('|', entity_type, entity_id, CAST(source_max_processed_at AS VARCHAR))) AS snapshot_id, *,
      source_max_processed_at AS snapshot_timestamp
    FROM ({customers} UNION ALL {organisations})"""


def _arrangements() -> str:
    parent = f"LEFT JOIN cur_arr_banking_arrangement a ON a.account_id = x.account_id"
    end = "CAST(x.start_date + to_months(x.loan_term * 12) AS DATE)"
    running = f"(x.start_date <= {TODAY} AND {TODAY} < {end})"
    cols = (
        "global_id arrangement_id arrangement_type parent_account_id organisation_id is_business_arrangement"
        " arrangement_subtype arrangement_status is_active start_date maturity_date days_to_maturity interest_type"
        " repayment_frequency term_months balance_band available_balance_band original_amount_band loan_amount_band"
        " credit_limit_band currency masked_identifier masking_status processed_at"
    ).split()

    def branch(source: str, values: dict[str, str]) -> str:
        picks = ", ".join(f"{values.get(c, 'NULL')} AS {c}" for c in cols)
        return f"SELECT {picks} FROM {source} WHERE x.{_OK}"

    same = {c: f"x.{c}" for c in ("global_id", "masking_status", "processed_at")}
    owned = {
        "parent_account_id": "x.account_id",
        "organisation_id": "a.organisation_id",
        "is_business_arrangement": "a.organisation_id IS NOT NULL",
        "currency": "coalesce(a.currency, 'AUD')",
        "interest_type": "x.interest_type",
        "repayment_frequency": "x.repayment_frequency",
    }
    union = " UNION ALL ".join(
        [
            branch(
                "cur_arr_banking_arrangement x",
                same
                | {c: f"x.{c}" for c in ("organisation_id", "is_business_arrangement", "is_active", "currency")}
                | {
                    "arrangement_id": "x.account_id",
                    "arrangement_type": "'BANK_ACCOUNT'",
                    "arrangement_subtype": "x.account_type",
                    "arrangement_status": "if(x.is_active, 'ACTIVE', 'INACTIVE')",
                    "start_date": "x.open_date",
                    "balance_band": "x.current_balance_masked",
                    "available_balance_band": "x.available_balance_masked",
                },
            ),
            branch(
                f"cur_arr_loan x {parent}",
                same
                | owned
                | {
                    "arrangement_id": "x.loan_id",
                    "arrangement_type": "'LOAN'",
                    "arrangement_subtype": "x.loan_type",
                    "arrangement_status": "x.status",
                    "is_active": "upper(x.status) = 'ACTIVE'",
                    "start_date": "x.start_date",
                    "maturity_date": "x.maturity_date",
                    "days_to_maturity": f"CAST(x.maturity_date - {TODAY} AS INTEGER)",
                    "term_months": "x.term_months",
                    "balance_band": "x.current_balance_masked",
                    "original_amount_band": "x.original_amount_masked",
                },
            ),
            branch(
                f"cur_arr_mortgage x {parent}",
                same
                | owned
                | {
                    "arrangement_id": "x.mortgage_id",
                    "arrangement_type": "'MORTGAGE'",
                    "arrangement_subtype": "'MORTGAGE'",
                    "arrangement_status": f"if({running}, 'ACTIVE_INFERRED', 'INACTIVE_INFERRED')",
                    "is_active": running,
                    "start_date": "x.start_date",
                    "maturity_date": end,
                    "days_to_maturity": f"CAST({end} - {TODAY} AS INTEGER)",
                    "term_months": "x.loan_term * 12",
                    "loan_amount_band": "x.loan_amount_masked",
                },
            ),
            branch(
                "cur_arr_credit_card x",
                same
                | {c: f"x.{c}" for c in ("organisation_id", "is_business_arrangement")}
                | {
                    "arrangement_id": "x.credit_card_id",
                    "arrangement_type": "'CREDIT_CARD'",
                    "arrangement_subtype": "x.card_type",
                    "arrangement_status": "x.status",
                    "is_active": "upper(x.status) = 'ACTIVE'",
                    "start_date": "x.issued_date",
                    "credit_limit_band": "x.credit_limit_masked",
                    "currency": "'AUD'",
                    "masked_identifier": "x.card_number_masked",
                },
            ),
        ]
    )
    return f"SELECT u.*, party.customer_id, 'PASSED' AS dq_status FROM ({union}) u {CUSTOMER.format('u')}"


def _timeline() -> str:
    shared = "global_id, application_id, masking_status, pipeline_run_id AS source_pipeline_run_id"
    return f"""
    SELECT t.*, source_table || ':' || source_record_id AS timeline_event_id, party.customer_id, 'PASSED' AS dq_status
    FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY application_id
        ORDER BY event_timestamp, event_family, source_record_id) AS INTEGER) AS event_sequence
      FROM (
        SELECT {shared}, 'app_stage_history' AS source_table, history_id AS source_record_id, entered_at AS event_timestamp,
          'STAGE' AS event_family, 'STAGE_TRANSITION' AS event_type,
          lag(stage) OVER (PARTITION BY application_id ORDER BY entered_at, history_id) AS from_value,
          stage AS to_value, stage, NULL AS status, NULL AS concept_name, NULL AS lifecycle_transition,
          NULL AS event_origin, NULL AS action, assigned_team, pending_action_party, NULL AS recorded_reason
        FROM cur_app_stage_history
        UNION ALL BY NAME
        SELECT {shared}, 'app_status_change' AS source_table, change_id AS source_record_id, changed_at AS event_timestamp,
          'STATUS' AS event_family, 'STATUS_CHANGE' AS event_type, old_status AS from_value, new_status AS to_value,
          new_status AS status, reason AS recorded_reason
        FROM cur_app_status_change
        UNION ALL BY NAME
        SELECT {shared}, 'app_lifecycle_event' AS source_table, event_id AS source_record_id, event_timestamp,
          'APPLICATION' AS event_family, coalesce(concept_name, 'APPLICATION_EVENT') AS event_type, concept_name,
          lifecycle_transition, event_origin, action
        FROM cur_app_lifecycle_event)) t {CUSTOMER.format('t')}"""


def _application_current() -> str:
    def nth(c: str, n: int) -> str:
        return f"max({c}) FILTER (WHERE rk = {n})"

    act = "greatest(a.last_updated_at, s.act, st.at, d.act, l.act)"
    return f"""
    SELECT a.global_id, a.application_id, party.customer_id, a.is_business_application, a.loan_goal, a.application_type,
      a.submitted_at, a.last_updated_at, a.requested_amount_masked, a.final_outcome, s.current_stage,
      s.entered AS current_stage_entered_at, s.previous_stage, s.team AS assigned_team, s.party AS pending_action_party,
      s.deadline AS stage_sla_deadline, CAST({TODAY} - CAST(s.entered AS DATE) AS INTEGER) AS days_in_current_stage,
      coalesce(s.breached, false) AS is_stage_sla_breached, coalesce(st.status, a.final_outcome) AS latest_status,
      st.at AS status_last_changed_at, st.reason AS recorded_reason,
      s.party IS NOT NULL AND s.party <> 'INTERNAL_TEAM' AS customer_action_required_flag,
      s.party = 'INTERNAL_TEAM' AS internal_action_required_flag,
      coalesce(d.n, 0) AS required_document_count, coalesce(d.missing, 0) AS missing_document_count,
      coalesce(d.received, 0) AS received_document_count, coalesce(d.rejected, 0) AS rejected_document_count,
      coalesce(d.expired, 0) AS expired_document_count, coalesce(d.reminders, 0) AS total_reminders_sent,
      {act} AS latest_activity_at, {act} < {NOW} - INTERVAL 14 DAY AS is_inactive_over_14_days, 'PASSED' AS dq_status,
      a.masking_status, greatest(a.processed_at, s.loaded, st.loaded, d.loaded, l.loaded) AS last_refreshed_at, a.pipeline_run_id
    FROM cur_app_application a {CUSTOMER.format('a')}
    LEFT JOIN (
      SELECT application_id, {nth('stage', 1)} AS current_stage, {nth('entered_at', 1)} AS entered, {nth('stage', 2)} AS previous_stage,
        {nth('assigned_team', 1)} AS team, {nth('pending_action_party', 1)} AS party, {nth('sla_deadline', 1)} AS deadline,
        bool_or(is_sla_breached) FILTER (WHERE rk = 1) AS breached, max(entered_at) AS act, max(processed_at) AS loaded
      FROM (SELECT *, row_number() OVER (PARTITION BY application_id
              ORDER BY is_current_stage DESC, entered_at DESC, history_id DESC) AS rk FROM cur_app_stage_history)
      GROUP BY application_id) s ON s.application_id = a.application_id
    LEFT JOIN (
      SELECT application_id, arg_max_null(new_status, row(changed_at, change_id)) AS status, max(changed_at) AS at,
        arg_max_null(reason, row(changed_at, change_id)) AS reason, max(processed_at) AS loaded
      FROM cur_app_status_change GROUP BY application_id) st ON st.application_id = a.application_id
    LEFT JOIN (
      SELECT application_id, count(*) AS n, count(*) FILTER (WHERE is_missing) AS missing, count(*) FILTER (WHERE is_received) AS received,
        count(*) FILTER (WHERE is_rejected) AS rejected, count(*) FILTER (WHERE is_expired) AS expired,
        CAST(sum(coalesce(reminders_sent, 0)) AS BIGINT) AS reminders,
        greatest(max(received_at), max(requested_at), max(last_reminder_at)) AS act, max(processed_at) AS loaded
      FROM gold_fact_application_document GROUP BY application_id) d ON d.application_id = a.application_id
    LEFT JOIN (
      SELECT application_id, max(event_timestamp) AS act, max(processed_at) AS loaded
      FROM cur_app_lifecycle_event GROUP BY application_id) l ON l.application_id = a.application_id"""


def _case_current() -> str:
    return f"""
    SELECT x.global_id, case_id, party.customer_id, organisation_id, application_id, is_business_case, case_type,
      subject AS case_subject, status AS case_status, priority, assigned_team, created_at, resolved_at, resolution_summary,
      sla_deadline, is_sla_breached, status IN ('open', 'in_progress', 'pending') AS is_open,
      CAST(coalesce(CAST(resolved_at AS DATE), {TODAY}) - CAST(created_at AS DATE) AS INTEGER) AS case_age_days,
      CAST(CAST(date_diff('second', created_at, resolved_at) AS DECIMAL(18,0)) / 3600 AS DECIMAL(27,6)) AS resolution_duration_hours,
      application_id IS NOT NULL AS application_related_flag, 'PASSED' AS dq_status, masking_status, processed_at
    FROM cur_evt_service_case x {CUSTOMER.format('x')}"""


def _activity() -> str:
    def flags(words: str) -> str:
        return (
            f"regexp_matches(upper({words}), 'FOLLOW.?UP|CALL.?BACK|PENDING') AS follow_up_required_flag,"
            f" regexp_matches(upper({words}), 'ESCALAT') AS escalated_flag"
        )

    return f"""
    SELECT u.*, party.customer_id, 'PASSED' AS dq_status FROM (
      SELECT global_id, NULL AS case_id, 'SUPPORT_INTERACTION:' || interaction_id AS service_activity_id,
        NULL AS application_id, interaction_timestamp AS activity_timestamp, 'SUPPORT_INTERACTION' AS activity_type, channel,
        topic, resolution, duration_minutes, NULL AS case_event_type, NULL AS description, true AS is_customer_contact,
        false AS is_internal_activity, {flags("concat_ws(' ', topic, resolution)")}, source_table,
        interaction_id AS source_record_id, masking_status, processed_at
      FROM cur_evt_support_interaction
      UNION ALL BY NAME
      SELECT e.global_id, c.case_id, 'CASE_EVENT:' || event_id AS service_activity_id, c.application_id,
        event_timestamp AS activity_timestamp, 'SERVICE_CASE_EVENT' AS activity_type, event_type AS case_event_type, description,
        event_type = 'CUSTOMER_CONTACTED' AS is_customer_contact, event_type <> 'CUSTOMER_CONTACTED' AS is_internal_activity,
        {flags("concat_ws(' ', event_type, description)")}, source_table, event_id AS source_record_id, e.masking_status, e.processed_at
      FROM cur_evt_case_event e LEFT JOIN gold_fact_service_case_current c ON c.case_id = e.case_id) u {CUSTOMER.format('u')}"""


def gold(name: str) -> str:
    past = f"(expiry_date < {TODAY})"
    sql = {
        "dim_customer": lambda: f"""SELECT global_id, customer_id, customer_type, name_token, {age('age')} AS age_band, state,
            occupation_code, email_masked, phone_masked, preferred_contact_channel, preferred_language, marketing_opt_in,
            satisfaction_score, customer_since, last_updated_at AS profile_last_updated_at, 'PASSED' AS dq_status,
            masking_status, pipeline_run_id, processed_at FROM cur_ip_individual WHERE {_OK}""",
        "dim_organisation": lambda: f"""SELECT global_id, organisation_id, business_name, legal_name, short_name,
            organisation_type, industry_code, industry_code_version, abn_masked, acn_masked, establishment_date,
            last_updated_at AS profile_last_updated_at, 'PASSED' AS dq_status, masking_status, pipeline_run_id, processed_at
            FROM cur_ip_organisation WHERE {_OK}""",
        "dim_date": lambda: f"""SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
            dayname(d) AS day_of_week, CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(month(d) AS INTEGER) AS month,
            CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year, isodow(d) < 6 AS is_business_day
            FROM (SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS d FROM ({_dates()}))""",
        "dim_stage_action_policy": lambda: """SELECT stage, party AS pending_action_party,
            'POLICY_NOT_CONFIGURED' AS next_action_code, CAST(NULL AS VARCHAR) AS banker_action_text,
            CAST(NULL AS VARCHAR) AS customer_safe_action_text, CAST(NULL AS INTEGER) AS default_sla_days,
            stage IN ('APPROVED', 'CANCELLED', 'DENIED', 'WITHDRAWN') AS is_terminal_stage,
            DATE '1970-01-01' AS effective_from, CAST(NULL AS DATE) AS effective_to, 'UNASSIGNED' AS policy_owner
            FROM (SELECT stage, coalesce(pending_action_party, 'UNASSIGNED') AS party FROM cur_app_stage_history
                  WHERE stage IS NOT NULL GROUP BY ALL)""",
        "fact_application_document": lambda: f"""SELECT document_id, application_id, party.customer_id, x.global_id, document_type,
            status AS document_status, requested_at, received_at, expiry_date,
            status IN ('REQUIRED', 'MISSING', 'PENDING') AS is_missing, status IN ('VERIFIED', 'RECEIVED') AS is_received,
            status IN ('INVALID', 'REJECTED') AS is_rejected, {past} OR status = 'EXPIRED' AS is_expired,
            is_invalid_or_expired OR status IN ('EXPIRED', 'INVALID') OR {past} AS is_invalid_or_expired, reminders_sent,
            last_reminder_at, rejection_reason, 'PASSED' AS dq_status, processed_at, pipeline_run_id
            FROM cur_app_missing_document x {CUSTOMER.format('x')}""",
        "fact_application_timeline_event": _timeline,
        "fact_application_current": _application_current,
        "fact_arrangement_current": _arrangements,
        "bridge_organisation_party_role": lambda: f"""SELECT x.global_id, relationship_id, organisation_id, party.customer_id,
            party_role, authority_level, is_active, start_date, end_date, 'PASSED' AS dq_status, pipeline_run_id, processed_at
            FROM cur_ip_party_relationship x {CUSTOMER.format('x')}""",
        "bridge_organisation_relationship": lambda: """SELECT relationship_id, source_org_id AS source_organisation_id,
            target_org_id AS target_organisation_id, relationship_type, is_active, start_date, 'PASSED' AS dq_status,
            pipeline_run_id, processed_at FROM cur_ip_org_relationship""",
        "bridge_application_party_authority": lambda: """SELECT a.application_id, a.organisation_id, r.customer_id, r.party_role,
            arg_max_null(r.authority_level, CASE WHEN r.start_date IS NOT NULL THEN row(r.start_date, r.authority_level) END)
              AS authority_level, bool_or(r.is_active) AS is_active, 'ORGANISATION_PARTY_ROLE_LOOKUP' AS derivation_method,
            'APPLICATION_SPECIFIC_MANDATE_UNAVAILABLE' AS limitation_code
            FROM gold_bridge_organisation_party_role r JOIN cur_app_application a USING (organisation_id)
            GROUP BY 1, 2, 3, 4""",
        "fact_verification_current": lambda: f"""SELECT kyc_id, party.customer_id, organisation_id, record_type, verification_status,
            verification_method, verification_date, last_review_date, next_review_date,
            next_review_date < {TODAY} AS review_overdue_flag, document_types, abn_verified, asic_check_status,
            beneficial_ownership_verified, risk_rating, pep_status, sanctions_check, 'PASSED' AS dq_status, masking_status,
            processed_at FROM cur_ip_kyc x {CUSTOMER.format('x')}""",
        "fact_service_case_current": _case_current,
        "fact_service_activity": _activity,
        "fact_subject_context_snapshot": _context,
    }
    return sql[name]()


_MAKERS = {"src": oracle_source, "raw": raw, "chg": chg, "cur": cur, "his": his, "gold": gold}
_PART = re.compile(r"\b(src|raw|chg|cur|his|gold)_([a-z0-9_]+)\b")


def compose(sql: str) -> str:
    """Prefix ``sql`` with every part it needs, each once, in order."""
    order: dict[str, str] = {}

    def need(text: str) -> None:
        for kind, name in dict.fromkeys(_PART.findall(text)):
            part = f"{kind}_{name}"
            if part not in order:
                body = _MAKERS[kind](name)
                need(body)
                order[part] = body

    need(sql)
    if not order:
        return sql
    return "WITH " + ", ".join(f"{name} AS ({body})" for name, body in order.items()) + " " + sql


def plain_sha(value: str) -> str:
    return hashlib.sha256(value.encode()).hexdigest()
