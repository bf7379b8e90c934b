"""Line-level reading: rescue at every level, CSV by header name, schemas that grow, shared quarantine."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ledgerstone.sources import bronze, evolution, landing, reading
from ledgerstone.streaming.ingestion import Ingestion
from tests.test_landing import RECORD, cdc_line, write_lines


def opened(spark, lines, ddl):
    frame = spark.createDataFrame([(x,) for x in lines], "value string")
    return reading.json_rows(frame, StructType.fromDDL(ddl)).collect()


def test_json_rows_split_typed_rescued_and_unreadable(spark):
    ddl = "id bigint, name string, tags array<string>, inner struct<a: bigint, deep: struct<b: string>>"
    rows = opened(
        spark,
        [
            '{"id": 1, "name": "a", "tags": ["x"], "inner": {"a": 2, "deep": {"b": "c"}}}',
            '{"id": "no", "new": {"k": 1.5}, "inner": {"a": "7", "z": null, "deep": {"y": "q\\"}"}}}',
            '{"id": null, "inner": 5, "tags": "t"}',
            "broken", "[1]", '{"id": 1, "id": 2}', "{}",
        ],
        ddl,
    )
    assert (rows[0].id, rows[0].tags, rows[0].inner.deep.b, rows[0]._rescued_data, rows[0]._unreadable) == (1, ["x"], "c", None, None)
    assert rows[1].inner.a == 7 and json.loads(rows[1]._rescued_data) == {"new": {"k": 1.5}, "id": "no", "inner": {"z": None, "deep": {"y": 'q"}'}}}
    assert rows[2].inner is None and rows[2].id is None and json.loads(rows[2]._rescued_data) == {"inner": 5, "tags": "t"}
    assert [r._unreadable for r in rows[3:]] == ["broken", "[1]", '{"id": 1, "id": 2}', None]
    assert all(r.id is None and r._rescued_data is None for r in rows[3:])


def test_filters_on_rescued_data_do_not_parse_again(spark):
    frame = spark.createDataFrame([('{"id": "no", "inner": {"z": 1}}',), ("broken",), ('{"id": 1}',)], "value string")
    rows = reading.json_rows(frame, StructType.fromDDL("id bigint, inner struct<a: bigint, deep: struct<b: string>>"))
    held = rows.where("_rescued_data IS NOT NULL OR _unreadable IS NOT NULL").select("_rescued_data", "_unreadable")
    assert {tuple(r) for r in held.collect()} == {('{"id":"no","inner":{"z":1}}', None), (None, "broken")}
    assert held._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1


def test_csv_by_header_name(spark, tmp_path):
    files = {
        "a.csv": "id,note\n1,x\n", "shuffled [1].csv": 'note,id\n"a, ""q""",2\n\n,3\n', "extra.csv": "﻿ID,other,note,note\n4,o,n,again\n5,,m,\n",
        "missing.csv": "id\n6\n", "ragged.csv": "id,note\n7\n8,y,z\n", "empty.csv": "", "head.csv": "note,id\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    rows = landing.csv_rows(spark, str(tmp_path), ["id", "note", "never"])
    got = {r.id: (r.note, r.never, r._rescued_data and json.loads(r._rescued_data)) for r in rows.collect()}
    assert got == {
        "1": ("x", None, None), "2": ('a, "q"', None, None), "3": (None, None, None), "4": ("n", None, {"other": "o", "note": "again"}),
        "5": ("m", None, None), "6": (None, None, None), "7": (None, None, {"_line": "7"}), "8": ("y", None, {"_line": "8,y,z"}),
    }
    heads = {r.path.rsplit("/", 1)[-1]: (r.header, r.records) for r in reading.csv_headers(reading.text_lines(spark, str(tmp_path))).collect()}
    assert heads["a.csv"] == ("id,note", 1) and heads["extra.csv"] == ("ID,other,note,note", 2) and "empty.csv" not in heads
    assert reading.new_headers(reading.text_lines(spark, str(tmp_path)), ["id", "note"]).fieldNames() == ["other"]
    # nothing but rescued data read
    assert rows.where("_rescued_data IS NOT NULL").select("_rescued_data").count() == 3


def test_csv_of_an_empty_folder(spark, tmp_path):
    (tmp_path / "none.csv").write_text("")
    rows = landing.csv_rows(spark, str(tmp_path), ["id"])
    assert rows.columns[:2] == ["id", "_rescued_data"] and rows.collect() == []
    assert bronze.file_rows(rows, "loans").collect() == []


def test_header_of_a_file_in_several_splits(spark, tmp_path):
    (tmp_path / "big.csv").write_text("b,a\n" + "".join(f"{i},{-i}\n" for i in range(20_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = landing.csv_rows(spark, str(tmp_path), ["a", "b"])
        assert rows.where("CAST(a AS INT) = -CAST(b AS INT)").count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_schema_of_rescued_data(spark):
    texts = ['{"record":{"n":1,"d":2.5,"o":{"k":"x"},"m":1}}', '{"record":{"n":20000000000,"d":10.25,"m":"s","l":[1,2],"z":null}}', '{"topic":7}', None, "broken"]
    frame = spark.createDataFrame([(t,) for t in texts], "rescued_data string")
    seen = {f.name: f.dataType.simpleString() for f in evolution.seen_in_rescued(frame).fields}
    assert seen == {"n": "bigint", "d": "double", "o": "struct<k:string>", "m": "string", "l": "array<bigint>", "z": "string"}
    assert evolution.seen_in_rescued(frame.where("false")).fields == []
    assert evolution.seen_in_rescued(spark.createDataFrame([('{"a":"1"}',)], "rescued_data string"), member=None).fieldNames() == ["a"]


def test_ledger_adds_columns_once(spark, tmp_path):
    ledger = evolution.SchemaLedger(spark, str(tmp_path / "ledger"))
    declared = StructType([StructField("id", LongType())])
    assert ledger.schema("t", declared) == declared
    more = StructType([StructField("ID", StringType()), StructField("b", StringType()), StructField("a", LongType())])
    assert ledger.extend("t", declared, more) == ["b", "a"]
    assert ledger.extend("t", declared, more) == []
    assert ledger.extend("t", declared, StructType([StructField("c", StringType())])) == ["c"]
    assert [f.simpleString() for f in ledger.schema("t", declared).fields] == ["id:bigint", "b:string", "a:bigint", "c:string"]
    assert ledger.schema("other", declared) == declared


def test_ingestion_evolves_at_restart_and_repeats_nothing(spark, tmp_path):
    root, out = tmp_path / "landing", str(tmp_path / "out")
    folder = root / "cdc" / "banking_core__banking_payees"
    plans = root / "file" / "energy_plans"
    plans.mkdir(parents=True)
    for kind in ("cdc", "event"):
        write_lines(root / "quarantine" / kind / "x.jsonl", [{"parse_error": "INVALID_JSON", "raw_value": "{", "batch_id": "b"}])
    line = {**cdc_line(1), "record": {"id": "1", "amount": "5", "limit": 9}}
    write_lines(folder / "a.jsonl", [line, cdc_line(2)])
    with open(folder / "a.jsonl", "a") as f:
        f.write("{oops\n")
    (plans / "p.csv").write_text("tier,id,amount\ngold,1,2\n")

    live = Ingestion(spark, str(root), out, {"banking_payees": RECORD, "energy_plans": RECORD})

    def drain():
        for query in live.start():
            query.awaitTermination()

    drain()
    assert {r.failure_reason for r in live.quarantine().collect()} == {"INVALID_JSON", "UNREADABLE_LINE", "SCHEMA_RESCUED_DATA"}
    assert live.quarantine().count() == 5 and live.table("cdc_banking_payees").count() == 2
    assert live.evolve() == {"cdc_banking_payees": ["limit"], "file_energy_plans": ["tier"]} and live.evolve() == {}
    write_lines(folder / "b.jsonl", [{**line, "record": {"id": "3", "limit": 11}}])
    (plans / "q.csv").write_text("id,tier\n2,iron\n")
    drain()
    drain()
    rows = {r.id: (r.limit, r._rescued_data) for r in live.table("cdc_banking_payees").collect()}
    assert rows == {"1": (None, '{"record":{"limit":9}}'), "2": (None, None), "3": (11, None)}
    assert {(r.id, r.tier) for r in live.table("file_energy_plans").collect()} == {("1", None), ("2", "iron")}
    assert live.quarantine().count() == 5


def test_streamed_lines_open_as_batch_lines_do(spark, tmp_path):
    write_lines(tmp_path / "a.jsonl", [cdc_line(i, **({"odd": i} if i % 2 else {})) for i in range(10)])
    lines = reading.text_lines(spark, str(tmp_path), streaming=True)
    rows, bad = bronze.opened(lines, "cdc_customers", RECORD)
    assert rows.isStreaming and bad.isStreaming
    batch, _ = bronze.opened(reading.text_lines(spark, str(tmp_path)), "cdc_customers", RECORD)
    assert batch.where(F.col("_rescued_data").isNotNull()).count() == 5


@pytest.mark.parametrize("path, name", [("file:/a%20b/x.csv", "file:/a b/x.csv"), ("file:/a/[1]{2}*.csv", "file:/a/\\[1\\]\\{2\\}\\*.csv")])
def test_paths_are_read_as_named(path, name):
    assert reading._readable(path) == name
