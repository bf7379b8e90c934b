"""Dependency violations and integrity audits."""

from __future__ import annotations

from pyspark.sql import DataFrame

from checks.catalogue import register
from checks.estate import AS_OF, TABLES, read
from checks.oracle import NOW, compose
from checks.products import SHARED, warehouse
from ledgerstone.operators import audit, dependencies
from ledgerstone.plans import audits
from ledgerstone.plans.silver import ENTITIES, SCD2

DUE = f"processed_at < {NOW} - INTERVAL 24 HOUR"
ALL = tuple(audits.NATURAL_KEYS)
# Products that others read too. Those of one reader are not stored, so it takes its key columns only.
READ_AGAIN = frozenset(ALL) - {
    "dim_date", "dim_stage_action_policy", "fact_application_timeline_event", "bridge_organisation_relationship", "fact_subject_context_snapshot",
}
GRADED = (
    "dim_customer dim_organisation fact_application_document fact_arrangement_current bridge_organisation_party_role"
    " bridge_organisation_relationship fact_verification_current fact_service_case_current fact_service_activity"
).split()


def _violation(rule, child, child_key, parent, parent_key, details, source) -> str:
    return f"""SELECT sha256(concat_ws('|', '{rule}', {child_key})) AS violation_id, '{rule}' AS rule_id,
      '{child}' AS child_entity, {child_key} AS child_key, '{parent}' AS parent_entity, {parent_key} AS parent_key,
      'OPEN' AS violation_status, processed_at + INTERVAL 24 HOUR AS grace_expires_at, {NOW} AS detected_at,
      {details} AS details FROM {source}"""


def _fk(spark, sf_dir) -> DataFrame:
    w = warehouse(spark, sf_dir)
    return dependencies.all_missing_parents(dependencies.RELATIONS, w.silver, AS_OF)


_FK_SQL = " UNION ALL ".join(
    _violation(
        r.rule_id, r.child, f"c.{r.child_key}", r.parent, f"c.{r.pairs[0][0]}", "'{\"reason\":\"parent_not_found\"}'",
        f"cur_{r.child} c WHERE c.{r.pairs[0][0]} IS NOT NULL AND c.{DUE} AND NOT EXISTS"
        f" (SELECT 1 FROM cur_{r.parent} p WHERE p.{r.pairs[0][1]} = c.{r.pairs[0][0]})",
    )
    for r in dependencies.RELATIONS
)
register("fk_violations", _fk, compose(_FK_SQL))

_SEEN = """(SELECT a.application_id, a.processed_at, upper(a.final_outcome) AS outcome,
      coalesce(list_sort(o.stages), []) AS stages FROM cur_app_application a
      LEFT JOIN (SELECT application_id, list(DISTINCT upper(stage)) AS stages FROM cur_app_stage_history GROUP BY ALL) o
      USING (application_id))"""
_JUDGED = f"""(SELECT *, list_filter(['SUBMITTED', 'DOCUMENT_VERIFICATION', 'ASSESSMENT'], lambda s: NOT list_contains(stages, s)) AS missing,
      CASE outcome WHEN 'ACCEPTED' THEN 'APPROVED' WHEN 'APPROVED' THEN 'APPROVED' WHEN 'DENIED' THEN 'DENIED'
        WHEN 'REJECTED' THEN 'DENIED' WHEN 'CANCELLED' THEN 'CANCELLED' WHEN 'WITHDRAWN' THEN 'WITHDRAWN' END AS terminal
      FROM {_SEEN})"""


def _json_list(x: str) -> str:
    return f"""'[' || array_to_string(list_transform({x}, lambda s: '"' || s || '"'), ',') || ']'"""


register(
    "lifecycle_completeness",
    lambda spark, sf_dir: (
        lambda w: dependencies.incomplete_lifecycles(w.silver("app_application"), w.silver("app_stage_history"), AS_OF)
    )(warehouse(spark, sf_dir)),
    compose(
        _violation(
            "APPLICATION_STAGE_COMPLETENESS", "app_stage_history", "application_id", "app_application", "application_id",
            f"""'{{"missing_core_stages":' || {_json_list('missing')} || ',"expected_terminal_stage":"' || terminal
            || '","observed_stages":' || {_json_list('stages')} || '}}'""",
            f"{_JUDGED} WHERE terminal IS NOT NULL AND {DUE} AND (len(missing) > 0 OR NOT list_contains(stages, terminal))",
        )
    ),
)
_ALLOWED = ", ".join(f"'{t}'" for t in dependencies.TRANSITIONS)
register(
    "lifecycle_transition",
    lambda spark, sf_dir: dependencies.forbidden_transitions(warehouse(spark, sf_dir).silver("app_stage_history"), AS_OF),
    compose(
        _violation(
            "APPLICATION_STAGE_TRANSITION", "app_stage_history", "history_id", "app_application", "application_id",
            """'{"previous_stage":"' || before || '","current_stage":"' || stage || '"}'""",
            f"""(SELECT *, lag(stage) OVER (PARTITION BY application_id ORDER BY entered_at, history_id) AS before
            FROM cur_app_stage_history) WHERE before IS NOT NULL AND {DUE} AND before || '->' || stage NOT IN ({_ALLOWED})""",
        )
    ),
)


# --- audits --------------------------------------------------------------------


def _sql(audit_id, entity, key, observed, source) -> str:
    return (
        f"SELECT '{audit_id}' AS audit_id, '{entity}' AS entity_name, CAST({key} AS VARCHAR) AS record_key,"
        f" CAST({observed} AS BIGINT) AS observed FROM {source}"
    )


def _keys(cols) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols) + ")"


def _union(parts) -> str:
    return compose(" UNION ALL ".join(parts))


def _duplicates(spark, sf_dir):
    lines = audit.duplicate_keys(read(spark, sf_dir, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"])
    w = warehouse(spark, sf_dir, audits.key_columns(READ_AGAIN, audits.NATURAL_KEYS))
    return lines.unionByName(audits.duplicates(w))


def _dup_sql(table, entity, keys):
    k = ", ".join(keys)
    return _sql("DUPLICATE_KEY", entity, _keys(keys), "n", f"(SELECT {k}, count(*) AS n FROM {table} GROUP BY {k} HAVING count(*) > 1)")


register(
    "audit_duplicate_keys",
    _duplicates,
    _union(
        [_dup_sql("lineitem", "lineitem", ["l_orderkey", "l_linenumber"])]
        + [_dup_sql(f"gold_{p}", p, audits.NATURAL_KEYS[p]) for p in ALL]
    ),
)
_NULLABLE = {"fact_application_document": ["customer_id"], "fact_arrangement_current": ["customer_id", "organisation_id"]}


def _null_keys(spark, sf_dir):
    """Natural keys of all products, and keys that may be null, from one scan of each product."""
    read = {p: [*k, *_NULLABLE.get(p, ())] for p, k in audits.NATURAL_KEYS.items()}
    w = warehouse(spark, sf_dir, audits.key_columns(READ_AGAIN, read))
    return audits.profiles(w, required=_NULLABLE).where("audit_id = 'NULL_KEY'")


register(
    "audit_null_keys",
    _null_keys,
    _union(
        [
            _sql("NULL_KEY", p, f"'{k}'", "n", f"(SELECT count(*) AS n FROM gold_{p} WHERE {k} IS NULL) WHERE n > 0")
            for p in ALL
            for k in [*audits.NATURAL_KEYS[p], *_NULLABLE.get(p, [])]
        ]
    ),
)
register(
    "audit_hard_failed",
    lambda spark, sf_dir: audits.hard_failures(warehouse(spark, sf_dir), GRADED),
    _union(
        [_sql("HARD_FAILED_ROW", p, _keys(audits.NATURAL_KEYS[p]), "1", f"gold_{p} WHERE dq_status IS DISTINCT FROM 'PASSED'") for p in GRADED]
    ),
)
_RELATED = audits.foreign_columns()
register(
    "audit_orphan_keys",
    lambda spark, sf_dir: audits.orphans(warehouse(spark, sf_dir, audits.key_columns(_RELATED, _RELATED))),
    _union(
        [
            _sql(
                "ORPHAN_KEY", f"{child}.{c}", c, "n",
                f"(SELECT {c}, count(*) AS n FROM gold_{child} WHERE {c} IS NOT NULL AND {c} NOT IN"
                f" (SELECT {pc} FROM gold_{parent} WHERE {pc} IS NOT NULL) GROUP BY {c})",
            )
            for child, relations in audits.FOREIGN_KEYS.items()
            for c, parent, pc in relations
        ]
    ),
)
register(
    "audit_reconciliation",
    lambda spark, sf_dir: audits.reconciliation(warehouse(spark, sf_dir)),
    _union(
        [
            _sql("NOT_RECONCILED", e, k, "1", f"cur_{e} WHERE processed_at < {NOW} - INTERVAL 30 MINUTE AND {k} NOT IN (SELECT {pk} FROM gold_{p})")
            for e, p, k, pk in audits.RECONCILED
        ]
    ),
)
register(
    "audit_time_order",
    lambda spark, sf_dir: audits.time_order(warehouse(spark, sf_dir)),
    _union(
        [
            _sql("TIME_ORDER", "fact_application_document", "document_id", "1", "gold_fact_application_document WHERE requested_at > received_at"),
            _sql("TIME_ORDER", "fact_arrangement_current", "arrangement_id", "1", "gold_fact_arrangement_current WHERE start_date > maturity_date"),
        ]
    ),
)
register(
    "audit_lost_events",
    lambda spark, sf_dir: audits.lost_events(warehouse(spark, sf_dir)),
    _union(
        [
            _sql(
                "LOST_RECORD", "fact_application_timeline_event", f"'{e}|' || {k}", "1",
                f"cur_{e} WHERE {k} NOT IN (SELECT source_record_id FROM gold_fact_application_timeline_event WHERE source_table = '{e}')",
            )
            for e, k in audits.TIMELINE_PARTS.items()
        ]
    ),
)
_CTX = "fact_subject_context_snapshot"
register(
    "audit_context",
    lambda spark, sf_dir: audits.context(warehouse(spark, sf_dir, SHARED | {_CTX})),
    _union(
        [
            _dup_sql(f"gold_{_CTX}", _CTX, ["entity_type", "entity_id"]),
            _sql("CONTEXT_IDENTITY", _CTX, "entity_id", "1", f"gold_{_CTX} WHERE (customer_id IS NULL) = (organisation_id IS NULL) OR source_max_processed_at IS NULL"),
            _sql("MISSING_WARNING_CODE", _CTX, "entity_id", "1", f"gold_{_CTX} WHERE entity_type = 'ORGANISATION' AND NOT contains(warning_codes, 'ORGANISATION_CONTACT_PREFERENCE_UNAVAILABLE')"),
            _sql("INVENTED_POLICY", "dim_stage_action_policy", "stage", "1", "gold_dim_stage_action_policy WHERE next_action_code <> 'POLICY_NOT_CONFIGURED' OR coalesce(banker_action_text, customer_safe_action_text) IS NOT NULL"),
        ]
    ),
)
_HIS = {n: list(e.keys) for n, e in ENTITIES.items() if e.mode == SCD2}
register(
    "audit_open_rows",
    lambda spark, sf_dir: audits.open_rows(warehouse(spark, sf_dir), _HIS),
    _union(
        [
            _sql("SEVERAL_OPEN", e, _keys(k), "n", f"(SELECT {', '.join(k)}, count(*) AS n FROM his_{e} WHERE __END_AT IS NULL GROUP BY ALL HAVING count(*) > 1)")
            for e, k in _HIS.items()
        ]
        + [_sql("SEVERAL_OPEN", "app_stage_history", "application_id", "n", "(SELECT application_id, count(*) AS n FROM cur_app_stage_history WHERE is_current_stage GROUP BY ALL HAVING count(*) > 1)")]
    ),
)
_IMMUTABLE = {
    "app_stage_history": "history_id", "app_status_change": "change_id", "app_lifecycle_event": "event_id", "app_accepted_loan": "loan_id",
    "app_rejected_application": "loan_id", "evt_support_interaction": "interaction_id", "evt_case_event": "event_id",
}
register(
    "audit_duplicate_records",
    lambda spark, sf_dir: (
        lambda w: audit.together(audit.duplicate_keys(w.changes(e), e, [k]) for e, k in _IMMUTABLE.items())
    )(warehouse(spark, sf_dir)),
    _union([_dup_sql(f"chg_{e}", e, [k]) for e, k in _IMMUTABLE.items()]),
)
_VALUES = (
    ("app_missing_document", "document_type", ("PAYSLIP", "IDENTITY")),
    ("app_stage_history", "pending_action_party", ("CUSTOMER", "INTERNAL_TEAM", "DIRECTOR")),
    ("app_status_change", "new_status", ("VIEW", "ACCEPTED")),
)


def _unexpected(spark, sf_dir):
    """Declared values on rows before and after the rules, other lists on current rows."""
    w = warehouse(spark, sf_dir)
    parts = [audit.unexpected_values(w.silver(e), e, c, ok) for e, c, ok in _VALUES]
    for e, accepted in audits.ACCEPTED_VALUES.items():
        for stage, frame in (("built", w.built(e)), ("current", w.silver(e))):
            parts.append(audit.profile(frame, f"{stage} {e}", [], accepted=accepted))
    return audit.together(parts)


_DECLARED = {
    "app_application": ("final_outcome", "ACCEPTED APPROVED CANCELLED DENIED PENDING REJECTED WITHDRAWN"),
    "evt_service_case": ("status", "OPEN IN_PROGRESS RESOLVED CLOSED"),
}
register(
    "audit_unexpected_values",
    _unexpected,
    _union(
        [_sql("UNEXPECTED_VALUE", e, f"'{c}=' || {c}", "n", f"(SELECT {c}, count(*) AS n FROM cur_{e} WHERE {c} NOT IN {ok} GROUP BY ALL)") for e, c, ok in _VALUES]
        + [
            _sql("UNEXPECTED_VALUE", f"{stage} {e}", f"'{c}=' || {c}", "n", f"(SELECT {c}, count(*) AS n FROM {view}_{e} WHERE upper({c}) NOT IN {tuple(ok.split())} GROUP BY ALL)")
            for e, (c, ok) in _DECLARED.items()
            for stage, view in (("built", "raw"), ("current", "cur"))
        ]
    ),
)
_TPCH = {
    "orders": [("o_custkey", "customer", "c_custkey")],
    "lineitem": [("l_orderkey", "orders", "o_orderkey"), ("l_partkey", "part", "p_partkey"), ("l_suppkey", "supplier", "s_suppkey")],
    "events": [("user_id", "supplier", "s_suppkey")],
}


def _all_tables(spark, sf_dir):
    frames = {t: read(spark, sf_dir, t) for t in TABLES}
    return audit.together(
        [audit.row_counts(frames)]
        + [audit.orphan_keys(frames[c], f"{c}.{k}", frames[p], [(k, pk)]) for c, rel in _TPCH.items() for k, p, pk in rel]
    )


register(
    "audit_generated_tables",
    _all_tables,
    _union(
        [_sql("ROW_COUNT", t, f"'{t}'", "n", f"(SELECT count(*) AS n FROM {t})") for t in TABLES]
        + [
            _sql("ORPHAN_KEY", f"{c}.{k}", k, "n", f"(SELECT {k}, count(*) AS n FROM {c} WHERE {k} NOT IN (SELECT {pk} FROM {p}) GROUP BY {k})")
            for c, rel in _TPCH.items()
            for k, p, pk in rel
        ]
    ),
)
