"""Each registered query next to its DuckDB statement, on the smallest scale."""

import re

import duckdb
import pytest

from checks import CHECKS
from checks.estate import TABLES
from checks.verify import rows_of

SF = "/root/testdata/sf0.001"
# The full set runs with ``python -m checks.verify``; one or two of each kind run here.
NAMES = [
    n for n in CHECKS
    if n.startswith(("rules_", "scd2_", "mask_", "dq_", "stream_", "envelope_"))
    or n in ("silver_app_application", "quarantine_ip_kyc", "fact_application_current", "fact_service_activity", "fk_violations",
             "lifecycle_transition", "mv_service_cases", "audit_time_order", "ingestion_quarantine", "manifest_reconciliation", "derived_columns")
]


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return connection


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, db, name):
    frame = CHECKS[name].query(spark, SF)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    result = db.execute(CHECKS[name].oracle)
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(frame.columns)
    assert got == rows_of(columns, result.fetchall())


def test_every_query_has_a_statement_and_a_plain_name():
    assert [n for n, c in CHECKS.items() if c.oracle is None] == []
    assert [n for n in CHECKS if re.search(r"pipeline|^op\d+_", n)] == []


def test_gaps_of_any_width_are_one_row(spark):
    from ledgerstone.operators.rules.groups import GROUP_RULES

    ids = spark.createDataFrame([(1,), (3,), (3,), (9 * 10**15,)], "id long")
    got = GROUP_RULES["IDENTIFIER_SEQUENCE_COMPLETE"](ids, {"type": "IDENTIFIER_SEQUENCE_COMPLETE", "column": "id", "pattern": "^([0-9]+)$"})
    assert {tuple(r)[1:] for r in got.collect()} == {("2..2", 1), (f"4..{9 * 10**15 - 1}", 9 * 10**15 - 4)}


def test_source_of_a_customers_timeline_is_built_once(spark):
    view = CHECKS["mv_self_application_timeline"].query(spark, "/root/testdata/sf0.001")
    assert view.count() and all("/settled-" in f for f in view.inputFiles())
