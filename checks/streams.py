"""Streaming flows drained over the check tables; the answer is the batch answer."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import functions as F

from checks.catalogue import register
from checks.estate import AS_OF, read
from checks.operators import _EVENT_HISTORY, _HARD, _ORDER_RULES
from checks.oracle import predicate
from ledgerstone.operators.splice import Splice
from ledgerstone.session import shared_folder
from ledgerstone.streaming import flows
from ledgerstone.streaming.late import LateAwareTable


def _work_dir(spark) -> str:
    """A fresh folder below the cluster's shared checkpoint folder, or below /tmp in tests."""
    return f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"


def _stream(spark, sf_dir, table):
    schema = read(spark, sf_dir, table).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{table}.parquet*")


def stream_dedup(spark, sf_dir):
    root = _work_dir(spark)
    # A backfill arrives at one load time, so no row is late whatever file it comes from.
    lines = _stream(spark, sf_dir, "lineitem").withColumn("at", F.lit(AS_OF).cast("timestamp"))
    kept = flows.deduplicated(lines, ["l_orderkey", "l_linenumber"], "at").select("l_orderkey", "l_linenumber")
    flows.append_sink(kept, f"{root}/out", f"{root}/cp").awaitTermination()
    return spark.read.parquet(f"{root}/out")


def stream_split(spark, sf_dir):
    root = _work_dir(spark)
    paths = f"{root}/passed", f"{root}/refused"
    flows.split_sink(_stream(spark, sf_dir, "orders"), _ORDER_RULES, _HARD, *paths, f"{root}/cp").awaitTermination()
    good = spark.read.parquet(paths[0]).select(F.col("o_orderkey").cast("string").alias("record_key"), F.lit("passed").alias("branch"))
    return good.unionByName(spark.read.parquet(paths[1]).select("record_key", F.lit("quarantined").alias("branch")))


def _splice() -> Splice:
    return Splice(["user_id"], sequence="seq", tie_breaks=["_tie"], untracked=["event_id", "value"], deleted=F.col("event_type") == "error", dropped=[], chunk_unit="day")


def _changes(events):
    return events.select("user_id", "event_type", "value", "event_id", F.col("ts").cast("timestamp").alias("seq"), F.col("event_id").alias("_tie"))


def stream_scd2(spark, sf_dir):
    root = _work_dir(spark)
    table = flows.SplicedHistory(spark, root, _splice(), buckets=8)
    table.follow(_changes(_stream(spark, sf_dir, "events")), f"{root}/cp").awaitTermination()
    return table.read()


def _in_batches(spark, sf_dir, root, count):
    """The events as a stream of ``count`` files, each with rows of the whole time range."""
    events = read(spark, sf_dir, "events")
    events.repartition(count, F.xxhash64("event_id")).write.parquet(f"{root}/in")
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")


def stream_history_batches(spark, sf_dir):
    """Changes out of order over several micro-batches give the history of the whole log."""
    root = _work_dir(spark)
    table = flows.SplicedHistory(spark, root, _splice(), buckets=8)
    table.follow(_changes(_in_batches(spark, sf_dir, root, 3)), f"{root}/cp").awaitTermination()
    return table.read()


def stream_late_rows(spark, sf_dir):
    """Several micro-batches with late rows, then a replay in one: both give the batch answer, all rows counted."""
    root = _work_dir(spark)
    stream = _in_batches(spark, sf_dir, root, 4)
    whole = spark.readStream.schema(read(spark, sf_dir, "events").schema).parquet(f"{root}/in")
    results = []
    for run, source in (("batches", stream), ("replay", whole)):
        rows = source.select("user_id", "event_type", F.col("ts").cast("timestamp").alias("at"))
        table = LateAwareTable(spark, f"{root}/{run}", ["user_id", "event_type"], "at", timedelta(days=2))
        table.follow(rows, f"{root}/cp-{run}").awaitTermination()
        dealt = table.counts().agg(F.sum(F.col("accepted") + F.col("late") + F.col("repeated")).alias("dealt"), F.sum("rows").alias("came"))
        results.append(table.reconciled().select(F.lit(run).alias("run"), "*").join(dealt))
    return results[0].unionByName(results[1])


register("stream_dedup", stream_dedup, "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
_OK = " AND ".join(f"coalesce({predicate(p)}, false)" for p in _HARD.values())
register(
    "stream_split",
    stream_split,
    f"SELECT CAST(o_orderkey AS VARCHAR) AS record_key, CASE WHEN {_OK} THEN 'passed' ELSE 'quarantined' END AS branch FROM orders",
)
register("stream_scd2", stream_scd2, _EVENT_HISTORY)
register("stream_history_batches", stream_history_batches, _EVENT_HISTORY)
register(
    "stream_late_rows",
    stream_late_rows,
    """SELECT run, user_id, event_type, min(ts) AS at, (SELECT count(*) FROM events) AS dealt, (SELECT count(*) FROM events) AS came
    FROM events CROSS JOIN (VALUES ('batches'), ('replay')) r(run) GROUP BY run, user_id, event_type""",
)
