import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerstone.operators import history
from ledgerstone.operators.quality import ERROR, Contract, Rule, compile_rules, rule_metrics
from ledgerstone.operators.splice import Splice
from ledgerstone.plans.publish import latest, materialise
from ledgerstone.streaming import flows
from tests.test_history import SCHEMA, changes


@pytest.fixture
def batches(spark, tmp_path):
    """A change log in five files, delivered out of order."""
    rows = changes(250, 7)
    random.Random(1).shuffle(rows)
    for i in range(5):
        spark.createDataFrame(rows[i::5], SCHEMA).coalesce(1).write.parquet(str(tmp_path / f"in/part={i}"))
    return spark.createDataFrame(rows, SCHEMA), str(tmp_path / "in")


def same(a, b):
    columns = sorted(a.columns)
    a, b = a.select(columns), b.select(columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_history_table_equals_batch_for_any_batch_split(spark, batches, tmp_path):
    log, path = batches
    want = history.scd2(log, ["k"], untracked=["note"])
    for files in (1, 3):
        table = flows.SplicedHistory(spark, str(tmp_path / f"h{files}"), Splice(["k"], untracked=["note"]), buckets=3)
        stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", files).parquet(f"{path}/*")
        table.follow(stream, str(tmp_path / f"cp{files}")).awaitTermination()
        assert same(table.read(), want)


def test_repeating_a_batch_changes_nothing(spark, tmp_path):
    log = spark.createDataFrame(changes(80, 8), SCHEMA)
    table = flows.SplicedHistory(spark, str(tmp_path), Splice(["k"], untracked=["note"]), buckets=2)
    first, second = log.where("_source_lsn < 40"), log.where("_source_lsn >= 40")
    for batch, i in ((first, 0), (second, 1), (second, 1)):
        table.apply(batch, i)
    assert same(table.read(), history.scd2(log, ["k"], untracked=["note"]))


def test_split_sink_loses_nothing(spark, tmp_path):
    spark.range(100).withColumn("a", F.when(F.col("id") % 4 > 0, F.col("id"))).write.parquet(str(tmp_path / "in"))
    contract = Contract("numbers", ("id",), (Rule("A_SET", ERROR, "completeness", "a IS NOT NULL"),))
    stream = flows.inserts(spark, str(tmp_path / "in")).withColumn("processed_at", F.lit(datetime(2024, 1, 1)))
    paths = str(tmp_path / "good"), str(tmp_path / "bad")
    flows.split_sink(stream, contract, compile_rules(contract, ERROR), *paths, str(tmp_path / "cp")).awaitTermination()
    good, bad = (spark.read.parquet(p) for p in paths)
    assert (good.count(), bad.count()) == (75, 25)
    assert bad.select("entity_name").distinct().first()[0] == "numbers"


def test_dedup_within_watermark_across_batches(spark, tmp_path):
    for i in range(2):
        rows = [(k, datetime(2024, 1, 1) + timedelta(hours=i)) for k in range(50)]
        spark.createDataFrame(rows, "k int, processed_at timestamp").coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    schema = spark.read.parquet(str(tmp_path / "in/0")).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    flows.append_sink(flows.deduplicated(stream, ["k"]), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 50


def test_stored_product_switches_version_last(spark, tmp_path):
    one, two = spark.range(10), spark.range(20)
    materialise(one, str(tmp_path), "p", 1, ["id"])
    assert latest(spark, str(tmp_path), "p").count() == 10
    two.write.parquet(str(tmp_path / "p/data/_version=2"))  # written but not committed
    assert latest(spark, str(tmp_path), "p").count() == 10
    materialise(two, str(tmp_path), "p", 3, ["id"])
    assert latest(spark, str(tmp_path), "p").count() == 20


@pytest.mark.parametrize("name", ["app_missing_document", "evt_support_interaction"])
def test_entity_stream_equals_batch(spark, tmp_path, name):
    from checks.estate import AS_OF, CHECK_KEY, spark_source
    from ledgerstone.plans.silver import ENTITIES
    from ledgerstone.plans.warehouse import Warehouse
    from ledgerstone.streaming.entities import EntityStream

    batch = Warehouse(spark_source(spark, "/root/testdata/sf0.001"), AS_OF, CHECK_KEY)
    source = batch.sources(ENTITIES[name].source)
    source.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema)
    stream = stream.option("maxFilesPerTrigger", 1)
    live = EntityStream(spark, name, str(tmp_path / "out"), AS_OF, buckets=3)
    for query in live.start(stream.parquet(str(tmp_path / "in"))):
        query.awaitTermination()
    want = batch.history(name)
    # records that came later than the watermark stand apart, counted; with them the answer is the batch answer
    got = live.table.reconciled() if ENTITIES[name].mode == "append" else live.read()
    assert same(got.select(want.columns), want)
    if ENTITIES[name].mode == "append":
        counts = live.table.counts().agg(F.sum("rows"), F.sum("accepted"), F.sum("late"), F.sum("repeated")).first()
        assert counts[0] == sum(counts[1:]) and counts[1] == live.read().count()
    assert live.refused().count() == batch.quarantine(name).count()
    assert same(live.metrics(), rule_metrics(batch.built(name), live.contract, AS_OF))


def test_joined_entities_have_no_stream(spark, tmp_path):
    from ledgerstone.streaming.entities import EntityStream

    with pytest.raises(ValueError):
        EntityStream(spark, "ip_individual", str(tmp_path), datetime(2024, 1, 1))


def test_joined_entity_is_refreshed_from_its_last_state(spark, tmp_path):
    from checks.estate import AS_OF, CHECK_KEY, spark_source
    from checks.products import MOMENTS
    from ledgerstone.plans.warehouse import Warehouse
    from ledgerstone.streaming.entities import JoinedEntity

    w = Warehouse(spark_source(spark, "/root/testdata/sf0.001"), AS_OF, CHECK_KEY)
    live = JoinedEntity(spark, "arr_banking_arrangement", str(tmp_path))
    for i, moment in enumerate(MOMENTS):
        state = w.at(moment).changes(live.name)
        live.refresh(state, moment, i)
        live.refresh(state, moment, i)
    got = live.read(len(MOMENTS) - 1)
    assert {"__START_AT", "__END_AT"} <= set(got.columns) and got.count() > 0
    assert same(got, w.joined_history(live.name, MOMENTS))


def test_new_checkpoint_over_old_output_is_refused(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in"))

    def start(checkpoint):
        stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
        flows.append_sink(stream, str(tmp_path / "out"), str(tmp_path / checkpoint)).awaitTermination()

    start("one")
    start("one")
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5
    with pytest.raises(ValueError):
        start("two")
