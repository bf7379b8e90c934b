import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ledgerstone.sources import bronze, envelope, landing, manifest, registry, rescue
from ledgerstone.streaming import flows

RECORD = StructType([StructField("id", StringType()), StructField("amount", StringType())])


def cdc_line(i, op="c", **extra):
    return {
        "topic": "t", "partition": 0, "offset": i, "timestamp": 1, "timestamp_type": 0, "key": str(i),
        "payload": {"op": op, "ts_ms": 1704067200000 + i, "source": {"schema": "s", "table": "x", "lsn": i, "snapshot": "false"}},
        "record": {"id": str(i), "amount": "5"}, "load_type": "INCREMENTAL", "captured_at": "2024-01-01T00:00:00Z", "batch_id": "b1", **extra,
    }


def write_lines(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps(x) + "\n" for x in lines))


def test_registry_lists_every_data_set():
    assert (len(registry.CDC_DATASETS), len(registry.EVENT_DATASETS), len(registry.FILE_DATASETS)) == (23, 5, 4)
    assert len(registry.bronze_tables()) == 32
    assert registry.landing_path("/l", "cdc", "customers") == "/l/cdc/customer_master__customers"


def test_cdc_files_become_bronze_rows_once_each(spark, tmp_path):
    src, out, cp = tmp_path / "cdc", str(tmp_path / "out"), str(tmp_path / "cp")

    def drain():
        stream = landing.json_lines(spark, str(src), landing.cdc_schema(RECORD), streaming=True)
        flows.append_sink(bronze.cdc_rows(stream, "things"), out, cp).awaitTermination()
        return spark.read.parquet(out)

    write_lines(src / "batch-1.jsonl", [cdc_line(1, "r"), cdc_line(2, "u")])
    assert drain().count() == 2
    write_lines(src / "batch-2.jsonl", [cdc_line(3, "d"), cdc_line(4, "?")])
    rows = drain()
    assert {r.id: r._operation for r in rows.collect()} == {"1": "SNAPSHOT", "2": "UPDATE", "3": "DELETE", "4": "UNKNOWN"}
    first = rows.where("id = '1'").first()
    assert first._commit_ts == datetime(2024, 1, 1, 0, 0, 0, 1000) and first._source_lsn == 1
    assert first._source_file.endswith("batch-1.jsonl") and first._ingested_at is not None
    assert drain().count() == 4


def test_events_and_csv(spark, tmp_path):
    event = {**cdc_line(1), "payload": {"event_id": "e1", "event_type": "made", "occurred_at": "2024-01-01T10:00:00Z", "producer": "p"}}
    write_lines(tmp_path / "event" / "a.jsonl", [event])
    rows = bronze.event_rows(landing.json_lines(spark, str(tmp_path / "event"), landing.event_schema(RECORD)), "things").first()
    assert (rows.id, rows._event_id, rows._event_type, str(rows._occurred_at)) == ("1", "e1", "made", "2024-01-01 10:00:00")
    (tmp_path / "file").mkdir()
    (tmp_path / "file" / "loans-20240101T000000Z.csv").write_text('id,note\n1,"a ""quoted"" note"\n2,x\n')
    (tmp_path / "file" / "loans.csv").write_text("id,note\n3,y\n")
    got = bronze.file_rows(landing.csv_rows(spark, str(tmp_path / "file"), ["id", "note"]), "loans").collect()
    assert {(r.id, r.note, r._load_type, r._batch_id) for r in got} == {
        ("1", 'a "quoted" note', "INCREMENTAL", "loans-20240101T000000Z"), ("2", "x", "INCREMENTAL", "loans-20240101T000000Z"), ("3", "y", "INITIAL", "loans"),
    }


def test_manifest_round_trip_and_reconciliation(spark, tmp_path):
    data = tmp_path / "file" / "a.csv"
    data.parent.mkdir()
    data.write_text("id\n1\n2\n")
    digest = hashlib.sha256(data.read_bytes()).hexdigest()
    uri = f"file:{data}"
    doc = {
        "manifest_version": "1.0", "batch_id": "b", "artifact_count": 2, "total_records": 5,
        "artifacts": [{"path": uri, "record_count": 3, "sha256": digest}, {"path": "file:/gone.csv", "record_count": 2, "sha256": "x"}],
        "source_record_counts": {"CDC": 0, "EVENT": 0, "FILE": 5},
    }
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "manifest-b.json").write_text(json.dumps(doc, indent=2))
    read = bronze.manifest_rows(landing.manifests(spark, str(tmp_path / "m")))
    assert read.first().source_record_counts.FILE == 5
    listed = read.select(F.explode("artifacts").alias("a")).select("a.*")
    prints = manifest.file_fingerprints(spark, str(data.parent))
    counts = manifest.file_record_counts(landing.csv_rows(spark, str(data.parent), ["id"]))
    normal = lambda f: f.withColumn("path", F.regexp_replace("path", "^file:/+", "file:/"))
    observed = normal(prints).join(normal(counts), "path")
    issues = {(r.path, r.reason) for r in manifest.reconcile(normal(listed), observed).collect()}
    assert issues == {(uri, "RECORD_COUNT"), ("file:/gone.csv", "FILE_MISSING")}
    assert manifest.repeated_files(prints, prints).count() == 1
    files = spark.createDataFrame([("a.csv",), ("b.csv",)], "name string")
    assert [r.name for r in manifest.unprocessed(files, files.where("name = 'a.csv'")).collect()] == ["b.csv"]


def test_invalid_transport_reader(spark, tmp_path):
    write_lines(tmp_path / "q" / "x.jsonl", [{"topic": "t", "parse_error": "INVALID_JSON", "raw_value": "{", "batch_id": "b"}])
    rows = landing.invalid_transport(spark, str(tmp_path / "q"))
    assert bronze.refused_messages(rows, "cdc").first().rescued_data == "{"


def test_rescue_keeps_unknown_and_mistyped_fields(spark):
    schema = StructType.fromDDL("id bigint, name string, tags array<string>")
    lines = ['{"id": 1, "name": "a", "tags": ["x"]}', '{"id": "no", "name": "b", "new": {"k": 1}}', "broken", '{"id": 2}']
    got = rescue.with_rescued(spark.createDataFrame([(x,) for x in lines], "value string"), schema).collect()
    assert (got[0].id, got[0].tags, got[0]._rescued_data) == (1, ["x"], None)
    assert got[1].id is None and json.loads(got[1]._rescued_data) == {"new": '{"k":1}', "id": "no"}
    assert got[2]._rescued_data == "broken" and got[3]._rescued_data is None


def test_additive_evolution(spark, tmp_path):
    stored = StructType.fromDDL("id bigint, name string")
    write_lines(tmp_path / "j" / "a.jsonl", [{"id": "1", "Name": "x", "extra": 2.5}])
    schema, new = rescue.evolved(stored, rescue.inferred(spark, str(tmp_path / "j"), 1.0))
    assert new == ["extra"] and schema.fieldNames() == ["id", "name", "extra"] and schema["id"].dataType.simpleString() == "bigint"


@pytest.mark.parametrize(
    "value, status",
    [
        ('{"op":"c","source":{"table":"t"},"after":{"a":1}}', "VALID"), ("{x", "INVALID_JSON"), (None, "TOMBSTONE"), ("null", "TOMBSTONE"),
        ("[1]", "TOMBSTONE"), ('{"op":"c"}', "UNCLASSIFIED_CDC_ENVELOPE"),
    ],
)
def test_cdc_classification(spark, value, status):
    frame = spark.createDataFrame([("T", value)], "topic string, value string")
    assert envelope.classify_cdc(frame).first().status == status


def test_slug(values):
    assert values(envelope.slug, ["A.B c", "__x__", "!!", "é"]) == ["a__b__c", "x", "unknown_dataset", "unknown_dataset"]


def test_registered_tables_fan_out(spark, tmp_path):
    write_lines(tmp_path / "cdc" / registry.CDC_DATASETS["banking_payees"] / "a.jsonl", [cdc_line(1)])
    (tmp_path / "file" / "energy_plans").mkdir(parents=True)
    (tmp_path / "file" / "energy_plans" / "p.csv").write_text("id,amount\n9,1\n")
    frames = bronze.tables(spark, str(tmp_path), {"banking_payees": RECORD, "energy_plans": RECORD})
    assert {n: f.first().id for n, f in frames.items()} == {"cdc_banking_payees": "1", "file_energy_plans": "9"}
    streams = bronze.tables(spark, str(tmp_path), {"banking_payees": RECORD, "energy_plans": RECORD}, streaming=True)
    assert streams.keys() == {"cdc_banking_payees"} and streams["cdc_banking_payees"].isStreaming


def test_repeated_keys(spark):
    lines = spark.createDataFrame([('{"id": 1, "x": "a", "x": "b"}',)], "value string")
    row = rescue.with_rescued(lines, StructType([StructField("id", LongType())])).first()
    assert row.id == 1 and '"x":"' in row._rescued_data
