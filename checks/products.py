"""Queries for the governed entities and the products built on them."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import SparkSession, functions as F

from checks.catalogue import register
from checks.estate import AS_OF, CHECK_KEY, spark_source
from checks.oracle import compose, hard_rules, raw, scd2_sql
from ledgerstone.plans import listings
from ledgerstone.plans.audits import READ_BY_PRODUCTS
from ledgerstone.plans.gold import PRODUCTS
from ledgerstone.plans.silver import (
    BANKING_ACCOUNT,
    BANKING_BALANCE,
    ENTITIES,
    INDIVIDUAL_ADDRESS,
    INDIVIDUAL_CUSTOMER,
    INDIVIDUAL_PREFERENCE,
)
from ledgerstone.plans.warehouse import Warehouse

# Products that several other products read, computed once per run.
SHARED = frozenset({"dim_customer", "fact_application_current", "fact_service_case_current"})


def warehouse(spark: SparkSession, sf_dir: str, settled: frozenset[str] | Mapping[str, Sequence[str] | None] = frozenset()) -> Warehouse:
    return Warehouse(spark_source(spark, sf_dir), AS_OF, CHECK_KEY, settled=settled)


def _history(name):
    return lambda spark, sf_dir: warehouse(spark, sf_dir).history(name)


def _product(name):
    many = name == "fact_subject_context_snapshot"
    settled = {p: READ_BY_PRODUCTS[p] for p in SHARED} if many else frozenset()
    return lambda spark, sf_dir: warehouse(spark, sf_dir, settled).gold(name)


def _failures(name):
    def query(spark, sf_dir):
        rows = warehouse(spark, sf_dir).quarantine(name)
        return rows.select(
            "failure_id", "entity_name", "validation_stage", "record_key", "source_reference", "processed_at",
            F.sort_array("failed_rule_ids").alias("failed_rule_ids"),
        )

    return query


def _failures_sql(name):
    failed = ", ".join(f"CASE WHEN NOT coalesce({p}, false) THEN '{r}' END" for r, p in sorted(hard_rules(name).items()))
    key = f"coalesce(CAST({ENTITIES[name].keys[0]} AS VARCHAR), '')"
    return compose(
        f"""SELECT sha256(concat_ws('|', '{name}', {key}, f, CAST(processed_at AS VARCHAR))) AS failure_id,
        '{name}' AS entity_name, 'POST_TRANSFORM' AS validation_stage, {key} AS record_key, source_table AS source_reference,
        processed_at, f AS failed_rule_ids FROM (SELECT *, concat_ws(',', {failed}) AS f FROM raw_{name}) WHERE f <> ''"""
    )


for _name in ENTITIES:
    register(f"silver_{_name}", _history(_name), compose(f"SELECT * FROM his_{_name}"))
MOMENTS = [datetime(1998, 1, 1), datetime(2000, 1, 1), datetime(2024, 1, 1)]


def _joined_sql(name):
    """The rule-passing state at each moment, keys absent at a moment marked as gone, then versions."""
    key = ENTITIES[name].keys[0]
    good = " AND ".join(f"coalesce({p}, false)" for p in hard_rules(name).values())
    states = []
    for moment in MOMENTS:
        body = re.sub(r"\bsrc_(\w+)", rf"(SELECT * FROM src_\1 WHERE _ingested_at <= TIMESTAMP '{moment}')", raw(name))
        states.append(f"SELECT *, TIMESTAMP '{moment}' AS moment FROM ({body}) WHERE {good}")
    live = " UNION ALL ".join(states)
    times = ", ".join(f"(TIMESTAMP '{m}')" for m in MOMENTS)
    grid = f"(SELECT DISTINCT {key} AS k FROM ({live})) u CROSS JOIN (VALUES {times}) t(m)"
    full = f"(SELECT l.* EXCLUDE ({key}, moment), u.k AS {key}, t.m AS moment, l.{key} IS NULL AS missing FROM {grid} LEFT JOIN ({live}) l ON l.{key} = u.k AND l.moment = t.m)"
    tracked = [c for c in JOINED_COLUMNS[name] if c != key]
    audits = ["pipeline_run_id", "source_table", "processed_at", "masking_status"]
    return compose(scd2_sql(full, key, tracked, audits, "moment", "missing", "moment"))


JOINED_COLUMNS = {
    "arr_banking_arrangement": [c for c, _, _ in BANKING_ACCOUNT + BANKING_BALANCE],
    "ip_individual": [c for c, _, _ in INDIVIDUAL_CUSTOMER + INDIVIDUAL_PREFERENCE + INDIVIDUAL_ADDRESS] + ["full_name", "name_token"],
}
for _name in JOINED_COLUMNS:
    register(
        f"joined_history_{_name}",
        (lambda name: lambda spark, sf_dir: warehouse(spark, sf_dir).joined_history(name, MOMENTS))(_name),
        _joined_sql(_name),
    )
for _name in ENTITIES:
    register(f"quarantine_{_name}", _failures(_name), _failures_sql(_name))
for _name in PRODUCTS:
    register(_name, _product(_name), compose(f"SELECT * FROM gold_{_name}"))
register(
    "listing_application_lifecycle",
    lambda spark, sf_dir: listings.application_lifecycle(warehouse(spark, sf_dir)),
    compose(
        """SELECT a.application_id, a.final_outcome, s.stage, s.entered_at, s.exited_at, s.assigned_team, s.pending_action_party, c.old_status, c.new_status, c.reason
        FROM cur_app_application a LEFT JOIN cur_app_stage_history s USING (application_id) LEFT JOIN cur_app_status_change c USING (application_id)"""
    ),
)
register(
    "listing_case_events",
    lambda spark, sf_dir: listings.case_events(warehouse(spark, sf_dir)),
    compose(
        """SELECT c.case_id, c.case_type, c.priority, c.sla_deadline, c.organisation_id, o.business_name, e.event_type, e.event_timestamp, e.description
        FROM cur_evt_service_case c LEFT JOIN cur_ip_organisation o USING (organisation_id) LEFT JOIN cur_evt_case_event e USING (case_id)"""
    ),
)
