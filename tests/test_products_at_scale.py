"""Products at scale: what is computed once, and what never enters a plan."""

import pytest
from pyspark.sql import functions as F

from checks import CHECKS
from checks.estate import AS_OF, CHECK_KEY, spark_source
from ledgerstone.operators.audit import profile, unreconciled
from ledgerstone.operators.joins import lookup, orphans
from ledgerstone.plans import gold, listings
from ledgerstone.plans.warehouse import Warehouse

SF = "/root/testdata/sf0.001"


@pytest.fixture
def w(spark):
    return Warehouse(spark_source(spark, SF), AS_OF, CHECK_KEY)


def _plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_orphans_compute_the_child_once_and_keep_repeated_rows(spark, tmp_path):
    rows = [("a", "k1"), ("a", "k1"), ("b", None), ("c", "k2"), ("d", "k3")]
    spark.createDataFrame(rows, "id string, k string").write.parquet(str(tmp_path / "child"))
    child = spark.read.parquet(str(tmp_path / "child"))
    parent = spark.createDataFrame([("k2",), ("k2",), (None,)], "key string")
    found = orphans(child, parent, [("k", "key")])
    assert sorted(r.id for r in found.collect()) == ["a", "a", "d"]
    assert _plan(found).count("parquet") == 1


def test_document_counts_look_up_no_customer(w):
    summary = gold._document_summary(w)
    assert "c_custkey" not in _plan(summary)
    # a document product that is kept is read, and its counts are the same
    other = Warehouse(w.sources, AS_OF, CHECK_KEY)
    other.keep("gold", "fact_application_document", w.gold("fact_application_document"))
    kept = gold._document_summary(other)
    assert "c_custkey" in _plan(kept)
    assert summary.exceptAll(kept).count() == 0 and kept.exceptAll(summary).count() == 0


def test_reconciliation_plans_no_join_that_only_adds_columns(spark):
    source = spark.createDataFrame([("A",), ("B",), ("B",)], "id string").withColumn("processed_at", F.lit(AS_OF) - F.expr("INTERVAL 1 DAY"))
    sides = spark.createDataFrame([("A", 1)], "id string, n int").groupBy("id").agg(F.sum("n").alias("n"))
    names = spark.createDataFrame([("A", "x")], "id string, name string")
    target = lookup(spark.createDataFrame([("A",), ("A",)], "id string").join(sides, "id", "left"), names, ["id"])
    lost = unreconciled(source, target, "e", [("id", "id")], AS_OF)
    assert sorted(r.record_key for r in lost.collect()) == ["B", "B"]
    assert "LeftOuter" not in _plan(lost)


def test_runs_are_named_once_a_key_is_down_to_its_current_row(w):
    plan = _plan(w.silver("app_application"))
    assert plan.count("sha2(") == 1 and plan.index("sha2(") < plan.index("WindowGroupLimit")


def test_listing_repeats_equal_changes_after_the_sort(spark):
    w = Warehouse(lambda name: None, AS_OF, CHECK_KEY)
    w.keep("silver", "app_application", spark.createDataFrame([("A", "x"), ("B", "y"), ("B", "y")], "application_id string, final_outcome string"))
    w.keep("silver", "app_stage_history", spark.createDataFrame([("A", "s2", 2, 3, "t", "p"), ("A", "s1", 1, 2, "t", None)], "application_id string, stage string, entered_at int, exited_at int, assigned_team string, pending_action_party string"))
    changes = [("A", "o", "n", None)] * 3 + [("A", "o", "m", "r"), ("A", None, None, None)]
    w.keep("silver", "app_status_change", spark.createDataFrame(changes, "application_id string, old_status string, new_status string, reason string"))
    listing = listings.application_lifecycle(w)
    rows = [(r.application_id, r.stage, r.old_status, r.new_status) for r in listing.collect()]
    once = [(None, None), ("o", "m"), ("o", "n"), ("o", "n"), ("o", "n")]
    assert rows == [("A", s, *c) for s in ("s1", "s2") for c in once] + [("B", None, None, None)] * 2
    assert _plan(listing).index("Generate explode") < _plan(listing).index("Sort [")


def test_settled_products_store_the_named_columns_only(spark):
    w = Warehouse(spark_source(spark, SF), AS_OF, CHECK_KEY, settled={"dim_customer": ("global_id", "customer_id"), "app_status_change": None})
    whole = Warehouse(w.sources, AS_OF, CHECK_KEY)
    assert w.gold("dim_customer").columns == ["global_id", "customer_id"]
    assert all("/settled-" in f for f in w.gold("dim_customer").inputFiles() + w.silver("app_status_change").inputFiles())
    for mine, other in ((w.gold("dim_customer"), whole.gold("dim_customer").select("global_id", "customer_id")), (w.silver("app_status_change"), whole.silver("app_status_change"))):
        assert mine.columns == other.columns and mine.count() and mine.exceptAll(other).count() == other.exceptAll(mine).count() == 0


@pytest.mark.parametrize("query", ["audit_duplicate_keys", "audit_null_keys", "audit_orphan_keys", "fact_subject_context_snapshot"])
def test_products_that_others_read_are_stored_without_columns_of_no_reader(spark, monkeypatch, query):
    kept = []
    monkeypatch.setattr("ledgerstone.plans.warehouse.settle", lambda frame: kept.append(frame.columns) or spark.createDataFrame([], frame.schema))
    CHECKS[query].query(spark, SF)
    assert kept and not any({"name_token", "requested_amount_masked", "rejection_reason", "resolution_summary"} & {*columns} for columns in kept)
    if query.startswith("audit"):  # entities that several products read are computed once
        assert sum("source_table" in columns for columns in kept) == 3


def test_profile_names_only_what_is_read(spark, tmp_path):
    spark.createDataFrame([("a", "k1"), ("a", None), ("a", None), (None, "k2")], "id string, k string").write.parquet(str(tmp_path / "t"))
    found = profile(spark.read.parquet(str(tmp_path / "t")), "t", ["id", "k"], ["id", "k"], {"k": ("K1",)})
    rows = sorted((r.audit_id, r.record_key, r.observed) for r in found.collect())
    assert rows == [("DUPLICATE_KEY", "a|", 2), ("NULL_KEY", "id", 1), ("NULL_KEY", "k", 2), ("UNEXPECTED_VALUE", "k=k2", 1)]
    plan = _plan(found.where("audit_id = 'NULL_KEY'"))
    assert plan.index("StructsToJson") < plan.rindex("Filter")  # rows of other checks go before keys are named
