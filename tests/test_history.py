import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerstone.operators import history, ordered
from ledgerstone.operators.joins import lookup, orphans, salted_join

BASE = datetime(2024, 1, 1)
SCHEMA = "k int, v string, note string, _operation string, _sequence_ts timestamp, _source_lsn bigint"


def brute_scd2(rows):
    """Versions of a change log by a plain loop."""
    out = []
    for key in sorted({r[0] for r in rows}):
        runs = []
        for r in sorted((r for r in rows if r[0] == key), key=lambda r: (r[4], r[5])):
            state = "DELETE" if r[3] == "DELETE" else r[1]
            if not runs or runs[-1]["state"] != state:
                runs.append({"state": state, "start": r[4]})
            runs[-1]["note"] = r[2]
        for run, after in zip(runs, [*runs[1:], None]):
            if run["state"] != "DELETE":
                out.append((key, run["state"], run["note"], run["start"], after["start"] if after else None))
    return out


def changes(n, seed, keys=6, hot=True):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if hot and rng.random() < 0.5 else rng.randrange(keys)
        op = "DELETE" if rng.random() < 0.1 else "UPDATE"
        rows.append((key, rng.choice("abc"), f"n{i}", op, BASE + timedelta(hours=rng.randrange(24 * 90)), i))
    return rows



def key_of(row):
    return tuple("" if x is None else str(x) for x in row)


@pytest.mark.parametrize("unit", ["day", "month", "year"])
def test_scd2_matches_a_plain_loop_for_any_chunking(spark, unit):
    rows = changes(400, 1)
    log = spark.createDataFrame(rows, SCHEMA)
    got = history.scd2(log, ["k"], untracked=["note"], chunk_unit=unit).collect()
    got = sorted(((r.k, r.v, r.note, r["__START_AT"], r["__END_AT"]) for r in got), key=key_of)
    assert got == sorted(brute_scd2(rows), key=key_of)


def test_scd2_does_not_depend_on_row_order(spark):
    rows = changes(200, 2)
    shuffled = rows[:]
    random.Random(9).shuffle(shuffled)
    one, two = (history.scd2(spark.createDataFrame(r, SCHEMA).repartition(5), ["k"], untracked=["note"]) for r in (rows, shuffled))
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_intervals_do_not_overlap_and_one_is_open(spark):
    versions = history.scd2(spark.createDataFrame(changes(300, 3), SCHEMA), ["k"], untracked=["note"])
    assert history.current(versions).groupBy("k").count().where("count > 1").count() == 0
    moment = BASE + timedelta(days=40, minutes=30)
    assert history.as_of(versions, moment).groupBy("k").count().where("count > 1").count() == 0


def test_snapshots_give_deletes_and_reopening(spark):
    s = [spark.createDataFrame(r, "k int, v string, processed_at string") for r in ([(1, "a", "x"), (2, "b", "x")], [(1, "a", "y")], [(1, "c", "z"), (2, "b", "z")])]
    times = [BASE, BASE + timedelta(days=1), BASE + timedelta(days=2)]
    got = history.scd2_from_snapshots(list(zip(times, s)), ["k"]).collect()
    assert sorted(((r.k, r.v, r.processed_at, r["__START_AT"], r["__END_AT"]) for r in got), key=key_of) == sorted(
        [
            (1, "a", "y", times[0], times[2]), (1, "c", "z", times[2], None),
            (2, "b", "x", times[0], times[1]), (2, "b", "z", times[2], None),
        ],
        key=key_of,
    )


def test_snapshot_prefers_older_complete_row_and_drops_deleted_keys(spark):
    rows = [(1, "x", 1, "UPDATE"), (1, None, 2, "UPDATE"), (2, "y", 1, "UPDATE"), (2, "y", 2, "DELETE")]
    frame = spark.createDataFrame(rows, "k int, need string, lsn int, _operation string")
    assert [(r.k, r.need) for r in history.current_snapshot(frame, ["k"], ["need"], ["lsn"]).collect()] == [(1, "x")]


def test_sequence_falls_back_over_the_clocks(spark):
    frame = spark.createDataFrame(
        [(None, None, "2024-01-03 00:00:00"), (None, "2024-01-02 00:00:00", "2024-01-03 00:00:00")],
        "_commit_ts string, _captured_at string, _ingested_at string",
    )
    assert sorted(str(r._sequence_ts)[:10] for r in history.with_sequence(frame).collect()) == ["2024-01-02", "2024-01-03"]


def test_neighbours_and_ordinal_with_one_hot_key(spark):
    rng = random.Random(4)
    rows = [(0 if rng.random() < 0.7 else rng.randrange(3), i, BASE + timedelta(hours=rng.randrange(2000))) for i in range(500)]
    frame = spark.createDataFrame(rows, "k int, id int, at timestamp")
    chunk = ordered.time_chunk(F.col("at"), "week")
    near = ordered.with_neighbours(frame, ["k"], ["at", "id"], chunk, ["id"], ["id"])
    got = ordered.with_ordinal(near, ["k"], ["at", "id"], chunk, "n")
    want = {}
    for key in range(3):
        line = sorted((r for r in rows if r[0] == key), key=lambda r: (r[2], r[1]))
        for i, r in enumerate(line):
            want[r[1]] = (line[i - 1][1] if i else None, line[i + 1][1] if i + 1 < len(line) else None, i + 1)
    assert {r.id: (r._previous and r._previous.id, r._following and r._following.id, r.n) for r in got.collect()} == want


def test_neighbour_pass_reads_its_input_once(spark):
    frame = spark.createDataFrame(changes(50, 5), SCHEMA)
    near = ordered.with_neighbours(frame, ["k"], ["_sequence_ts", "_source_lsn"], ordered.time_chunk(F.col("_sequence_ts")), ["v"], ["v"])
    near.collect()
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


def test_joins_with_missing_and_hot_keys(spark):
    left = spark.createDataFrame([(i, None if i % 3 == 0 else (1 if i % 3 == 1 else i)) for i in range(300)], "id int, k int")
    right = spark.createDataFrame([(1, "one"), (2, "two"), (5, "five")], "k int, name string")
    plain = left.join(right, "k", "left").select("id", "k", "name")
    assert lookup(left, right, ["k"]).select("id", "k", "name").exceptAll(plain).count() == 0
    inner = left.join(right, "k").select("id", "k", "name")
    assert salted_join(left, right, ["k"]).select("id", "k", "name").exceptAll(inner).count() == 0
    assert salted_join(left, right, ["k"]).count() == inner.count()
    want = {r.id for r in left.where("k is not null").join(right, "k", "left_anti").collect()}
    assert {r.id for r in orphans(left, right, [("k", "k")]).collect()} == want
    with pytest.raises(ValueError):
        salted_join(left, right, ["k"], "full")


def test_top_rows_are_limited_below_the_shuffle(spark):
    frame = spark.createDataFrame(changes(50, 6), SCHEMA)
    plan = ordered.latest_by(frame, ["k"], ["_sequence_ts", "_source_lsn"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.rindex("WindowGroupLimit") > plan.index("Exchange")


def test_marks_tell_nulls_apart(spark):
    rows = [(None, "a"), ("a", None), ("a", "a"), (None, None), ("", "a"), ("a", ""), ("0", "1"), ("01", "")]
    frame = spark.createDataFrame(rows, "x string, y string")
    marks = [r[0] for r in frame.select(history.state_mark(["x", "y"])).collect()]
    assert len(set(marks)) == len(rows)
    versions = history.scd2(
        spark.createDataFrame([(1, x, y, "U", BASE + timedelta(hours=i), i) for i, (x, y) in enumerate(rows)], "k int, x string, y string, _operation string, _sequence_ts timestamp, _source_lsn bigint"), ["k"]
    )
    assert versions.count() == len(rows)


@pytest.mark.parametrize("busy_rows", [0, 60, 10**6])
def test_scd2_matches_a_plain_loop_however_many_keys_are_cut(spark, busy_rows):
    rows = changes(400, 7)
    log = spark.createDataFrame(rows, SCHEMA)
    got = history.scd2(log, ["k"], untracked=["note"], busy_rows=busy_rows, counted=log.unionByName(log)).collect()
    assert sorted(((r.k, r.v, r.note, r["__START_AT"], r["__END_AT"]) for r in got), key=key_of) == sorted(brute_scd2(rows), key=key_of)


def test_keys_of_few_rows_are_shuffled_and_sorted_once(spark):
    log = spark.createDataFrame(changes(400, 8), SCHEMA)
    assert history.busy_buckets(log, ["k"], 100) and not history.busy_buckets(log, ["k"], 400)
    versions = history.scd2(log, ["k"], untracked=["note"])
    plan = versions._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1


def test_repeated_rows_leave_every_version_its_start(spark):
    rows = [(k, "ab"[k % 2], "n", "UPDATE", BASE + timedelta(hours=k), k) for k in range(500)]
    log = spark.createDataFrame(rows * 2, SCHEMA).repartition(7)
    got = history.scd2(log, ["k"], untracked=["note"]).collect()
    assert sorted((r.k, r["__START_AT"], r["__END_AT"]) for r in got) == [(r[0], r[4], None) for r in rows]
