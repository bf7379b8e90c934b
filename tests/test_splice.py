"""Spliced history, refreshes, retention and late rows, each against the whole log."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerstone.operators import history, splice
from ledgerstone.streaming import flows
from ledgerstone.streaming.late import LateAwareTable
from tests.test_history import BASE, SCHEMA, changes
from tests.test_streaming import same


def no_log(split):
    raise AssertionError("the log is read")


@pytest.mark.parametrize("seed, batches, unit", [(1, 3, "month"), (2, 4, "day")])
def test_splices_equal_the_whole_log(spark, tmp_path, seed, batches, unit):
    rows = changes(240, seed, keys=5)
    random.Random(seed).shuffle(rows)
    table = flows.SplicedHistory(spark, str(tmp_path), splice.Splice(["k"], untracked=["note"], chunk_unit=unit), buckets=2)
    cuts = sorted(random.Random(seed).sample(range(1, len(rows)), batches - 1))
    for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
        table.apply(spark.createDataFrame(rows[a:b], SCHEMA), i)
        if i == 1:
            table.apply(spark.createDataFrame(rows[a:b], SCHEMA), i)
            assert same(table.read(), history.scd2(spark.createDataFrame(rows[:b], SCHEMA), ["k"], untracked=["note"]))
    assert same(table.read(), history.scd2(spark.createDataFrame(rows, SCHEMA), ["k"], untracked=["note"]))


def test_splice_cases(spark):
    """Ties, zero-length runs, splits at a run's first and last row, deletes inside and around runs: one key each."""
    of = splice.Splice(["k"], untracked=["note"])

    def at(rows):
        return spark.createDataFrame([(k, v, n, op, BASE + timedelta(hours=h), lsn) for k, (v, n, op, h, lsn) in rows], SCHEMA)

    first = [("a", "1", "U", 1, 1), ("a", "2", "U", 2, 1), ("a", "3", "U", 3, 1), ("b", "4", "U", 3, 2), ("a", "5", "U", 3, 3), ("a", "6", "DELETE", 5, 1), ("a", "7", "U", 8, 1), ("a", "8", "U", 9, 1)]
    cases = [
        [("c", "x", "U", 1, 2)], [("c", "x", "U", 2, 2)], [("c", "x", "U", 2, 0), ("a", "y", "U", 2, 2)], [("a", "x", "U", 6, 1)], [("a", "x", "DELETE", 8, 2)], [("a", "x", "U", 2, 3)],
        [("c", "x", "U", 0, 1), ("c", "y", "U", 99, 1)], [("b", "x", "U", 3, 4)], [("a", "x", "DELETE", 4, 1), ("b", "y", "U", 4, 2)], [("c", "x", "U", 1, 0), ("b", "y", "U", 9, 0), ("a", "z", "U", 9, 2)],
    ]
    old, new = [(k, r) for k in range(len(cases)) for r in first], [(k, r) for k, case in enumerate(cases) for r in case]
    stored = of.runs(of.rows(at(old))).withColumns({"_batch": F.lit(0), "_sign": F.lit(1)})
    signed = of.spliced(splice.live(stored, ["k"], "_batch"), at(new), lambda split: of.rows(at(old)))
    after = splice.live(stored.unionByName(signed.withColumn("_batch", F.lit(1))), ["k"], "_batch")
    assert same(of.versions(after), history.scd2(at(old + new), ["k"], untracked=["note"]))


def test_changes_in_order_never_read_the_log(spark, tmp_path):
    rows = sorted(changes(120, 5), key=lambda r: (r[4], r[5]))
    of = splice.Splice(["k"], untracked=["note"])
    stored = of.runs(of.rows(spark.createDataFrame(rows[:80], SCHEMA)))
    new = spark.createDataFrame([(k, v, n, o, rows[79][4] + timedelta(hours=i), lsn) for i, (k, v, n, o, _, lsn) in enumerate(rows[80:], 1)], SCHEMA)
    seen = []
    signed = of.spliced(stored, new, lambda split: (seen.append(split.count()), of.rows(new).where("false"))[1])
    assert seen == [0]
    # of the stored runs at most the last one of each key is replaced
    assert signed.where("_sign < 0").count() <= len({r[0] for r in rows})


def test_refreshes_equal_snapshots(spark):
    rng = random.Random(4)
    times = [BASE + timedelta(days=i) for i in range(5)]
    states = []
    for i in range(5):
        rows = [(k, rng.choice(["a", "b", None]), f"n{i}") for k in range(12) if rng.random() < 0.7]
        states.append(spark.createDataFrame(rows, "k int, v string, processed_at string"))
    stored = None
    for at, state in zip(times, states):
        stored = splice.refreshed(stored, state, ["k"], at)
    assert same(stored, history.scd2_from_snapshots(list(zip(times, states)), ["k"]))
    emptied = splice.refreshed(stored, states[0].where("false"), ["k"], times[-1] + timedelta(days=1))
    assert history.current(emptied).count() == 0 and emptied.count() == stored.count()


def test_retention_closes_and_reopens_nothing(spark):
    log = spark.createDataFrame(changes(300, 6), SCHEMA)
    whole = history.scd2(log, ["k"], untracked=["note"])
    moment = BASE + timedelta(days=60)
    kept, closed, cuts = splice.folded(log, ["k"], moment, untracked=["note"])
    assert kept.count() < log.count() and closed.count() > 0
    assert same(history.scd2(kept, ["k"], untracked=["note"]).unionByName(closed), whole)
    gone = spark.createDataFrame([(1, "a", "n", "U", BASE, 1), (1, "a", "n", "DELETE", BASE + timedelta(days=1), 2)], SCHEMA)
    kept, closed, cuts = splice.folded(gone, ["k"], moment, untracked=["note"])
    assert kept.count() == 0 and [(r.v, r["__END_AT"]) for r in closed.collect()] == [("a", BASE + timedelta(days=1))]
    again = spark.createDataFrame([(1, "b", "n", "U", BASE + timedelta(hours=5), 3), (1, "b", "n", "U", BASE + timedelta(days=2), 4), (2, "b", "n", "U", BASE, 5)], SCHEMA)
    fine, late = splice.after_cut(again, cuts, ["k"])
    assert sorted(r._source_lsn for r in fine.collect()) == [4, 5] and [r._source_lsn for r in late.collect()] == [3]


@pytest.mark.parametrize("seed, files", [(1, 3), (3, 10)])
def test_late_rows_are_kept_apart_and_counted(spark, tmp_path, seed, files):
    rng = random.Random(seed)
    rows = [(rng.randrange(120), BASE + timedelta(days=rng.randrange(40)), i) for i in range(400)] + [(500, None, 0), (None, BASE, 1), (None, BASE, 2)]
    for i in range(10):
        spark.createDataFrame(rows[i::10], "k int, processed_at timestamp, n int").coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    schema = spark.read.parquet(str(tmp_path / "in/0")).schema
    table = LateAwareTable(spark, str(tmp_path / "out"), ["k"], delay=timedelta(days=40))

    def drain(table, checkpoint):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(str(tmp_path / "in/*"))
        table.follow(stream, str(tmp_path / checkpoint)).awaitTermination()

    drain(table, "cp")
    counts = table.counts().agg(F.sum("rows"), F.sum("accepted"), F.sum("late"), F.sum("repeated")).first()
    assert counts[0] == len(rows) == sum(counts[1:]) and counts[1] == table.read().count() == table.read().select("k").distinct().count()
    narrow = LateAwareTable(spark, str(tmp_path / "narrow"), ["k"], delay=timedelta(days=2))
    drain(narrow, "cp2")
    assert narrow.late().count() == narrow.counts().agg(F.sum("late")).first()[0] >= 1
    batch = {}
    for k, at, n in rows:
        batch[k] = min(batch.get(k, (datetime(9999, 1, 1),)), (at or datetime(9999, 1, 1),))
    want = {(k, None if m[0].year == 9999 else m[0]) for k, m in batch.items()}
    assert {(r.k, r.processed_at) for r in narrow.reconciled().collect()} == want
    assert files == 10 or narrow.late().where("_late_reason = 'LATER_THAN_WATERMARK'").count() > 0


def test_a_late_aware_batch_that_runs_again(spark, tmp_path):
    table = LateAwareTable(spark, str(tmp_path), ["k"], delay=timedelta(days=1))
    batches = [[(1, BASE), (1, BASE)], [(1, BASE), (2, BASE + timedelta(days=3))], [(3, BASE), (2, BASE + timedelta(days=3))]]
    for i in (0, 1, 1, 2, 2):
        table.apply(spark.createDataFrame(batches[i], "k int, processed_at timestamp"), i)
    got = {r["_batch"]: (r.rows, r.accepted, r.late, r.repeated) for r in table.counts().collect()}
    assert got == {0: (2, 1, 0, 1), 1: (2, 1, 0, 1), 2: (2, 0, 1, 1)}
    assert sorted(r.k for r in table.read().collect()) == [1, 2] and table.late().first().k == 3
