import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerstone.operators import audit, quality
from ledgerstone.operators.quality import ERROR, WARNING, Contract, ContractError, Rule
from ledgerstone.operators.rules import REFERENCE_RULES, Reference, judged
from checks.required import REQUIRED
from ledgerstone.plans.contracts import SILVER_CONTRACTS, SOURCE_CONTRACTS
from tests.defects import inject_defects

NOW = datetime(2024, 2, 1)
CONTRACT = Contract(
    "things",
    ("id",),
    (
        Rule("A_SET", ERROR, "completeness", "a IS NOT NULL"),
        Rule("A_POSITIVE", ERROR, "conformity", "a > 0"),
        Rule("NEW", WARNING, "timeliness", "d >= date_sub({today}, 30)"),
    ),
    required=("id",),
)


@pytest.fixture
def frame(spark):
    rows = [(1, 5, "2024-01-20"), (2, -1, "2024-01-20"), (3, None, None), (4, 2, "2020-01-01")]
    return spark.createDataFrame(rows, "id int, a int, d string")


def test_compile_keeps_one_severity():
    assert list(quality.compile_rules(CONTRACT, ERROR)) == ["A_SET", "A_POSITIVE"]
    assert "DATE'2024-02-01'" in quality.compile_rules(CONTRACT, WARNING, NOW)["NEW"]


@pytest.mark.parametrize(
    "rule", [Rule("X", "fatal", "d", "true"), Rule("", ERROR, "d", "true"), Rule("X", ERROR, "d", ""), Rule("X", ERROR, "d", "{today}")]
)
def test_malformed_rules_are_refused(rule):
    with pytest.raises(ContractError):
        quality.compile_rules(Contract("c", (), (rule,)), ERROR)


def test_duplicate_rule_ids_are_refused():
    rule = Rule("X", ERROR, "d", "true")
    with pytest.raises(ContractError):
        quality.compile_rules(Contract("c", (), (rule, rule)), ERROR)


def test_required_rules():
    assert quality.required_rules(CONTRACT) == {"SOURCE_ID_REQUIRED": "`id` IS NOT NULL"}


def test_null_verdict_is_a_failure_and_nothing_is_lost(frame):
    rules = quality.compile_rules(CONTRACT, ERROR)
    good, bad = quality.passed(frame, rules), quality.quarantined(frame, CONTRACT, rules, as_of=NOW)
    assert [r.id for r in good.orderBy("id").collect()] == [1, 4]
    failed = {r.record_key: r.failed_rule_ids for r in bad.collect()}
    assert failed == {"2": ["A_POSITIVE"], "3": ["A_SET", "A_POSITIVE"]}
    assert good.count() + bad.count() == frame.count()


def test_envelope_is_stable(frame):
    rules = quality.compile_rules(CONTRACT, ERROR)
    ids = [
        sorted(r.failure_id for r in quality.quarantined(f, CONTRACT, rules, as_of=NOW).collect())
        for f in (frame, frame.repartition(3).orderBy(F.desc("id")))
    ]
    assert ids[0] == ids[1]
    assert len(quality.quarantined(frame, CONTRACT, rules, as_of=NOW).columns) == 11


def test_status(frame):
    rows = quality.with_status(frame, quality.compile_rules(CONTRACT, ERROR), quality.compile_rules(CONTRACT, WARNING, NOW))
    assert {r.id: r.quality_status for r in rows.collect()} == {1: "PASSED", 2: "QUARANTINED", 3: "QUARANTINED", 4: "WARNING"}


def test_metrics_agree_with_the_split(frame):
    metrics = {r.rule_id: (r.passed_count, r.failed_count) for r in quality.rule_metrics(frame, CONTRACT, NOW).collect()}
    assert metrics == {"A_SET": (3, 1), "A_POSITIVE": (2, 2), "NEW": (2, 2)}


def test_freshness_and_tolerance(spark, frame):
    moments = spark.createDataFrame([("2024-01-31 23:45:00",)], "processed_at string")
    assert quality.freshness_lag(moments, "processed_at", NOW).first().is_fresh
    row = quality.tolerance_check(frame, CONTRACT, NOW).first()
    assert (row.breach_count, row.rate, row.within_tolerance) == (2, 0.5, False)


def test_defects_are_repeatable(spark):
    rows = spark.range(20000).withColumnRenamed("id", "k").withColumns({"v": F.lit(1.0), "fk": F.col("k")})
    dirty = inject_defects(rows, "k", ["v"], "fk")
    counts = dirty.agg(F.count_if(F.col("v").isNull()), F.count_if(F.col("fk") == -1)).first()
    assert 250 < counts[0] < 550 and 50 < counts[1] < 160
    assert dirty.exceptAll(inject_defects(rows.repartition(5), "k", ["v"], "fk")).count() == 0


def test_contracts_are_complete():
    assert len(SILVER_CONTRACTS) == 19 and len(SOURCE_CONTRACTS) == 32


def test_required_fields_are_the_stated_ones():
    assert {k: (" ".join(c.keys), " ".join(c.required)) for k, c in SOURCE_CONTRACTS.items()} == REQUIRED
    rules = [r for c in SILVER_CONTRACTS.values() for r in c.rules]
    assert (len(rules), sum(r.severity == ERROR for r in rules)) == (171, 149)
    for contract in SILVER_CONTRACTS.values():
        assert len(quality.compile_rules(contract, ERROR, NOW)) + len(quality.compile_rules(contract, WARNING, NOW)) == len(contract.rules)


def test_fingerprint_changes_with_the_contract():
    assert CONTRACT.fingerprint == Contract("things", ("id",), CONTRACT.rules, ("id",)).fingerprint
    assert CONTRACT.fingerprint != Contract("things", ("id",), CONTRACT.rules[:1], ("id",)).fingerprint


def test_profile_answers_all_checks_from_one_scan(spark):
    rows = [(1, "a", "open"), (1, "a", "OPEN"), (None, "b", "shut"), (None, "", None), (2, None, "Gone"), (2, "", "gone"), (2, None, "shut")]
    frame = spark.createDataFrame(rows, "k int, v string, s string")
    out = audit.profile(frame, "t", ["k", "v"], ["k", "s"], {"s": ("OPEN", "SHUT")})
    assert {tuple(r) for r in out.collect()} == {
        ("DUPLICATE_KEY", "t", "1|a", 2), ("DUPLICATE_KEY", "t", "2|", 2), ("NULL_KEY", "t", "k", 2), ("NULL_KEY", "t", "s", 1),
        ("UNEXPECTED_VALUE", "t", "s=Gone", 1), ("UNEXPECTED_VALUE", "t", "s=gone", 1),
    }
    assert audit.profile(frame.where("false"), "t", ["k"], ["k"]).collect() == []


def test_grouped_reference_rules_equal_single_ones(spark):
    rng = random.Random(8)
    child = spark.createDataFrame([(i, rng.choice([None, 1, 2, 3, 9]), rng.choice(["x", "y", None]), f"2024-01-{rng.randrange(1, 29):02d}") for i in range(80)], "id int, k int, v string, at string")
    parent = spark.createDataFrame([(1, "x", "2024-01-10"), (2, None, "2024-01-20"), (3, "y", None), (4, "x", "2024-01-01")], "p int, w string, since string")
    child = child.withColumn("list", F.to_json(F.array(F.col("k").cast("string"), F.lit("7")))).withColumn("n", F.lit("19"))
    base = {"key": ["id"], "pairs": [("k", "p")]}
    rules = [
        Reference("FOREIGN_KEY_IF_PRESENT", "child", "parent", base),
        Reference("REFERENCE_RELATIONSHIP_EXISTS_IF_PRESENT", "child", "parent", {**base, "parent_where": "w = 'x'"}),
        Reference("REFERENCE_CONDITION", "child", "parent", {**base, "parent_columns": ["w"], "condition": "parent_w = 'x'"}),
        Reference("REFERENCE_CONDITION_FOR_VALUES", "child", "parent", {**base, "when": {"column": "v", "in": ["x"]}, "parent_columns": ["w"], "condition": "parent_w <> 'y'"}),
        Reference("REFERENCE_TIMESTAMP_COMPARISON", "child", "parent", {**base, "left": "at", "op": ">=", "right": "since"}),
        Reference("REFERENCE_COLUMN_EQUAL_IF_BOTH_PRESENT", "child", "parent", {**base, "left": "v", "right": "w"}),
        Reference("JSON_ARRAY_FOREIGN_KEY", "child", "parent", {"key": ["id"], "column": "list", "parent_key": "p"}),
        Reference("JSON_ARRAY_REFERENCE_PARENT_CONSISTENCY", "child", "parent", {"key": ["id"], "column": "list", "parent_key": "p", "left": "v", "right": "w"}),
        Reference("CHILD_ROW_COUNT_MATCH", "declared", "child", {"parent_key": "p", "child_key": "k", "declared": "n", "key": ["p"]}),
        Reference("PARENT_DECLARED_CHILD_COUNT_MATCH", "child", "declared", {"parent_key": "p", "child_key": "k", "declared": "n", "key": ["p"]}),
        Reference("PARENT_REFERENCE_USAGE", "parent", "child", {"parent_key": "p", "child_key": "k"}),
    ]
    tables = {"child": child, "parent": parent, "declared": parent.withColumn("n", F.lit("19"))}
    got = Counter(tuple(r) for r in judged(tables, rules).collect())
    want = Counter()
    for r in rules:
        want.update(tuple(x) for x in REFERENCE_RULES[r.type](tables[r.child], tables[r.parent], {"type": r.type, **r.spec}).collect())
    assert got == want and len({t for t, *_ in want}) == len(rules)
    plan = judged(tables, rules[:6])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


def test_existence_rules_use_the_shuffle_of_a_join_on_a_part_of_their_key(spark):
    """Null and repeated keys on either side give what the single forms give."""
    rng = random.Random(9)
    some = lambda *values: rng.choice([None, *values])
    child = spark.createDataFrame([(i % 60, some(1, 2, 3, 9), some("x", "y"), some("2024-01-01", "2024-01-02")) for i in range(70)], "id int, k int, v string, at string").withColumn("at", F.col("at").cast("timestamp"))
    parent = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y"), (None, "x")], "p int, w string")
    days = spark.createDataFrame([(some(1, 2, 3), some("2024-01-01", "2024-01-02")) for _ in range(5)], "p int, day string").withColumn("day", F.col("day").cast("date"))
    both = spark.createDataFrame([(some(1, 2, 3), some("x", "y")) for _ in range(9)], "p int, w string")
    rules = [
        Reference("REFERENCE_CONDITION", "child", "parent", {"key": ["id"], "pairs": [("k", "p")], "parent_columns": ["w"], "condition": "parent_w = 'x'"}),
        Reference("REFERENCE_PAIR_CONSISTENT", "child", "days", {"key": ["id"], "pairs": [("k", "p"), ("at", "day")]}),
        Reference("REFERENCE_TRIPLE_CONSISTENT", "child", "both", {"key": ["id"], "pairs": [("k", "p"), ("v", "w")], "parent_where": "w = 'x'"}),
    ]
    tables = {"child": child, "parent": parent, "days": days, "both": both}
    grouped = judged(tables, rules)
    want = Counter()
    for r in rules:
        want.update(tuple(x) for x in REFERENCE_RULES[r.type](tables[r.child], tables[r.parent], {"type": r.type, **r.spec}).collect())
    assert Counter(tuple(r) for r in grouped.collect()) == want and len({t for t, *_ in want}) == len(rules)
    assert grouped._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_metrics_are_counted_while_writing(spark, tmp_path):
    contract = Contract("t", ("k",), (Rule("K_SET", "error", "completeness", "k IS NOT NULL"), Rule("K_SMALL", "warning", "conformity", "k < 5")))
    rows = spark.createDataFrame([(i if i % 3 else None,) for i in range(20)], "k int")
    seen, metrics = quality.observed(rows, contract)
    seen.write.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, metrics().collect())) == sorted(map(tuple, quality.rule_metrics(rows, contract).collect()))
