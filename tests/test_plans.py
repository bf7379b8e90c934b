from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks.estate import AS_OF, CHECK_KEY, spark_source
from ledgerstone.operators import audit, dependencies, derive
from ledgerstone.operators.metrics import metric_query
from ledgerstone.operators.rules import SCHEMA_RULES, row_rule
from ledgerstone.operators.rules.files import schema_violations
from ledgerstone.operators.rules.rows import wildcard_regex
from ledgerstone.plans import audits
from ledgerstone.plans.gold import PRODUCTS
from ledgerstone.plans.metric_views import METRIC_VIEWS
from ledgerstone.plans.publish import refresh, stored_reader, temporary_views
from ledgerstone.plans.silver import ENTITIES
from ledgerstone.plans.warehouse import Warehouse

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def w(spark):
    return Warehouse(spark_source(spark, SF), AS_OF, CHECK_KEY)


def test_counts():
    assert (len(ENTITIES), len(PRODUCTS), len(METRIC_VIEWS)) == (19, 15, 20)
    assert sum(len(r) for r in audits.FOREIGN_KEYS.values()) == 24 and len(audits.NATURAL_KEYS) == 15


@pytest.mark.parametrize("name", ["app_application", "app_stage_history", "ip_individual"])
def test_passed_plus_quarantined_is_everything(w, name):
    assert w.changes(name).count() + w.quarantine(name).count() == w.built(name).count()


@pytest.mark.parametrize("name", ["app_application", "ip_organisation"])
def test_current_rows_equal_open_versions(w, name):
    history = w.history(name)
    columns = [c for c in w.silver(name).columns]
    open_rows = history.where(F.col("__END_AT").isNull()).select(columns)
    assert open_rows.exceptAll(w.silver(name).select(columns)).count() == 0
    assert open_rows.count() == w.silver(name).count()


def test_replay_in_another_layout_gives_the_same_rows(spark, w):
    shuffled = Warehouse(lambda n: spark_source(spark, SF)(n).repartition(7).orderBy(F.desc("_batch_id")), AS_OF, CHECK_KEY)
    for name in ("app_accepted_loan", "app_missing_document"):
        a, b = w.history(name), shuffled.history(name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_customer_views_show_less_and_only_own_rows(spark):
    view = METRIC_VIEWS["mv_self_application_status"]
    banker = METRIC_VIEWS["mv_application_status"]
    assert set(view.dimensions) < set(banker.dimensions) and view.audience == "customer"
    assert {"Pending Action Party", "Assigned Team", "Recorded Reason"} & set(view.dimensions) == set()
    rows = spark.createDataFrame([("A1", "C1", 3), ("A2", "C2", 4)], "application_id string, customer_id string, days_in_current_stage int")
    got = metric_query(view, lambda n: rows, ["Application ID"], ["Application Count"], AS_OF, principal="C1").collect()
    assert [tuple(r) for r in got] == [("A1", 1)]
    with pytest.raises(KeyError):
        metric_query(view, lambda n: rows, ["Assigned Team"], [], AS_OF)
    with pytest.raises(ValueError):  # no principal, no rows
        metric_query(view, lambda n: rows, ["Application ID"], ["Application Count"], AS_OF)


def test_unused_metric_joins_are_not_made(w):
    view = METRIC_VIEWS["mv_customer_overview"]

    def tables(name):
        assert name == "dim_customer"
        return w.gold(name)

    assert metric_query(view, tables, ["State"], [], AS_OF).count() > 0


def test_grace_period():
    assert dependencies.grace_hours("2 hours") == 2
    for text in ("2 days", "2"):
        with pytest.raises(ValueError):
            dependencies.grace_hours(text)


def test_columns_do_not_leak(w):
    products = ["dim_customer", "dim_organisation", "fact_service_case_current", "fact_verification_current"]
    assert audits.leaked_columns(w, products).count() == 0
    leak = w.gold("dim_customer").withColumn("risk_rating", F.lit("x"))
    rows = audit.schema_rows(leak.sparkSession, {"d": leak})
    assert [r.record_key for r in audit.forbidden_columns(rows, audit.RESTRICTED_COMPLIANCE).collect()] == ["risk_rating"]


def test_required_columns(spark):
    rows = audit.schema_rows(spark, {"t": spark.createDataFrame([], "a int, at timestamp")})
    need = {"t": {"a": "int", "at": "date", "b": "string"}}
    assert sorted(r.record_key for r in audit.missing_columns(rows, spark, need).collect()) == ["at", "b"]


def test_audits_find_exactly_what_was_injected(spark):
    frame = spark.createDataFrame([(1, 5, "PASSED"), (1, 6, "PASSED"), (2, 7, None), (None, 8, "PASSED")], "id int, fk int, dq_status string")
    parent = spark.createDataFrame([(5,), (6,), (7,)], "p int")
    found = audit.together(
        [
            audit.duplicate_keys(frame.where("id is not null"), "t", ["id"]),
            audit.null_keys(frame, "t", ["id", "fk"]),
            audit.hard_failed(frame, "t", ["fk"]),
            audit.orphan_keys(frame, "t", parent, [("fk", "p")]),
        ]
    )
    assert sorted((r.audit_id, r.record_key, r.observed) for r in found.collect()) == [
        ("DUPLICATE_KEY", "1", 2), ("HARD_FAILED_ROW", "7", 1), ("NULL_KEY", "id", 1), ("ORPHAN_KEY", "8", 1),
    ]


def test_derivations(spark):
    with pytest.raises(ValueError):
        derive.approved_projection(spark.range(1), ["id"], ["id"])
    with pytest.raises(ValueError):
        derive.routed(spark.range(1), {"A": "id > 0"}, {"A": "EXPLODE"})
    row = derive.routed(spark.range(1), {"A": "id > 0", "B": "id > 1"}, {"A": "ALLOW_WITH_WARNING", "B": "REJECT_FILE"}).first()
    assert (row.failed_rule_ids, row.rule_action) == (["A", "B"], "REJECT_FILE")


def test_schema_rules(spark):
    schema = spark.createDataFrame([], "id int, Prompt string").schema
    want = spark.createDataFrame([], "id bigint").schema
    specs = [
        {"type": "EXACT_COLUMN_COUNT", "count": 2},
        {"type": "AUTHORITATIVE_SCHEMA_MATCH", "schema": want},
        {"type": "PROHIBITED_RAW_FIELDS_IN_AI_OUTPUT", "columns": ["prompt"]},
    ]
    got = {(r.rule_type, r.record_key) for r in schema_violations(spark, schema, specs).collect()}
    assert got == {
        ("AUTHORITATIVE_SCHEMA_MATCH", "Prompt: None -> string"), ("AUTHORITATIVE_SCHEMA_MATCH", "id: bigint -> int"),
        ("PROHIBITED_RAW_FIELDS_IN_AI_OUTPUT", "Prompt"),
    }
    assert "COLUMN_MUST_NOT_EXIST" in SCHEMA_RULES


def test_row_rule_refuses_unknown_types():
    with pytest.raises(ValueError):
        row_rule({"type": "NO_SUCH_RULE"}, AS_OF)
    assert wildcard_regex("?#-.") == "^[A-Za-z][0-9][-][.]$"


def test_stored_products_are_read_not_rebuilt(spark, w, tmp_path):
    fresh = Warehouse(spark_source(spark, SF), AS_OF, CHECK_KEY)
    refresh(fresh, str(tmp_path), 1, ["dim_customer"], audits.NATURAL_KEYS)

    def refuse(name):
        raise AssertionError("sources must not be read")

    reader = Warehouse(refuse, AS_OF, CHECK_KEY, stored=stored_reader(spark, str(tmp_path), ["dim_customer"]))
    assert reader.gold("dim_customer").count() == w.gold("dim_customer").count()
    temporary_views(reader, ["dim_customer"], "tmp_")
    assert spark.table("tmp_dim_customer").count() == reader.gold("dim_customer").count()


def test_context_codes(spark):
    context = spark.createDataFrame(
        [("c", None, "c", "CUSTOMER", [], "s", datetime(2024, 1, 1)), (None, None, "x", "ORGANISATION", ["A"], "s", None)],
        "customer_id string, organisation_id string, entity_id string, entity_type string, warning_codes array<string>,"
        " snapshot_id string, source_max_processed_at timestamp",
    )
    assert [r.record_key for r in audit.context_identity(context).collect()] == ["x"]
    assert audit.context_codes(context, "ORGANISATION", "B").count() == 1 and audit.context_codes(context, "ORGANISATION", "A").count() == 0


def test_overdue(spark):
    rows = spark.createDataFrame([("2024-01-01", None), ("2024-03-01", None), ("2024-01-01", "2024-01-05")], "due string, done string")
    got = rows.select(derive.overdue(F.col("due").cast("timestamp"), F.col("done"), datetime(2024, 2, 1)).alias("o")).collect()
    assert [r.o for r in got] == [True, False, False]
