"""Transport steps on the events table turned into messages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from checks.catalogue import register
from checks.estate import AS_OF, SOURCES, TABLES, read
from checks.oracle import compose
from checks.products import warehouse
from checks.required import REQUIRED
from ledgerstone.sources import bronze, envelope, landing, manifest, rescue

# Change messages: broken text for tiny values, no table for errors, a tombstone for each large value.
_MESSAGES = """
SELECT 'Shop.' || event_type AS topic, event_id % 8 AS partition, event_id AS offset, CAST(user_id AS STRING) AS key,
  CASE WHEN value < 0.3 THEN '{{"op": broken' WHEN value > 150 THEN CAST(NULL AS STRING)
    WHEN value > 120 THEN '{{}}'
    WHEN event_type = 'error' THEN '{{"op":"u","source":{{"schema":"shop"}},"after":{{"id":1}}}}'
    ELSE '{{"op":"' || CASE event_type WHEN 'signup' THEN 'r' WHEN 'view' THEN 'u' WHEN 'click' THEN 'c' ELSE 'd' END
      || '","source":{{"schema":"Shop Floor","table":"' || event_type || '!","lsn":' || CAST(event_id * 3 AS STRING)
      || ',"snapshot":"last"}},"ts_ms":' || CAST(1704067200000 + event_id * 1000 AS STRING)
      || CASE event_type WHEN 'purchase' THEN ',"after":{{}},"before":' ELSE ',"after":' END
      || '{{"id":"' || CAST(event_id AS STRING) || '","amount":"' || CAST(CAST(value AS DECIMAL(18,2)) AS STRING)
      || CASE WHEN value < 1 THEN '","extra":"x' ELSE '' END || '"}}}}' END AS value,
  '2024-01-31 00:00:00' AS captured_at, CAST(CAST(ts AS DATE) AS STRING) AS batch_id
FROM {events}"""
_EVENT_MESSAGES = """
SELECT 'Bus.' || event_type AS topic, event_id % 8 AS partition, event_id AS offset, CAST(user_id AS STRING) AS key,
  CASE WHEN value < 0.3 THEN 'oops' WHEN value > 150 THEN CAST(NULL AS STRING)
    ELSE '{{"event_id":"' || CAST(event_id AS STRING) || '"' || CASE WHEN event_type = 'error' THEN '' ELSE ',"source_dataset":"' || event_type || ' log"' END
      || CASE WHEN value > 20 THEN ',"load_type":"INITIAL"' ELSE '' END
      || CASE WHEN value < 2 THEN ',"payload":"text"}}' ELSE ',"payload":{{"id":' || CAST(user_id AS STRING) || '}}}}' END END AS value,
  '2024-01-31 00:00:00' AS captured_at, CAST(CAST(ts AS DATE) AS STRING) AS batch_id
FROM {events}"""


def _messages(text):
    return lambda spark, sf_dir: spark.sql(text, events=read(spark, sf_dir, "events"))


def _duck(text: str) -> str:
    return text.format(**{t: t for t in TABLES})


_SLUG = "coalesce(nullif(trim(regexp_replace(lower({0}), '[^a-z0-9_]+', '__', 'g'), '_'), ''), 'unknown_dataset')"


def _js(path: str) -> str:
    return f"CASE WHEN json_valid(value) THEN json_extract_string(value, '{path}') END"


_CDC = f"""(SELECT *, CASE WHEN coalesce(value, '') = '' THEN 'TOMBSTONE' WHEN NOT json_valid(value) THEN 'INVALID_JSON'
      WHEN value = '{{}}' THEN 'TOMBSTONE' WHEN {_js('$.source.table')} IS NULL THEN 'UNCLASSIFIED_CDC_ENVELOPE' ELSE 'VALID' END AS status,
    {_SLUG.format(f"coalesce(nullif(concat_ws('.', {_js('$.source.schema')}, {_js('$.source.table')}), ''), topic)")} AS dataset,
    CASE WHEN {_js('$.after')} <> '{{}}' THEN {_js('$.after')} ELSE {_js('$.before')} END AS record,
    CASE WHEN {_js('$.op')} = 'r' THEN 'INITIAL' ELSE 'INCREMENTAL' END AS load_type,
    CASE {_js('$.op')} WHEN 'r' THEN 'SNAPSHOT' WHEN 'c' THEN 'INSERT' WHEN 'u' THEN 'UPDATE' WHEN 'd' THEN 'DELETE' ELSE 'UNKNOWN' END AS _operation,
    {_js('$.source.snapshot')} AS _snapshot_state, CAST({_js('$.source.lsn')} AS BIGINT) AS _source_lsn,
    make_timestamp(CAST({_js('$.ts_ms')} AS BIGINT) * 1000) AS _commit_ts FROM ({_duck(_MESSAGES)}))"""
_EVT = f"""(SELECT *, CASE WHEN value IS NOT NULL AND NOT json_valid(value) THEN 'INVALID_JSON'
      WHEN {_js('$.source_dataset')} IS NULL OR json_type(value, '$.payload') <> 'OBJECT' THEN 'UNCLASSIFIED_EVENT_ENVELOPE' ELSE 'VALID' END AS status,
    {_SLUG.format(f"coalesce({_js('$.source_dataset')}, topic)")} AS dataset, {_js('$.payload')} AS record,
    coalesce({_js('$.load_type')}, 'INCREMENTAL') AS load_type FROM ({_duck(_EVENT_MESSAGES)}))"""
_EVT = _EVT.replace("json_type(value, '$.payload')", "CASE WHEN json_valid(value) THEN json_type(value, '$.payload') END")

_cdc = lambda s, d: envelope.classify_cdc(_messages(_MESSAGES)(s, d))
_evt = lambda s, d: envelope.classify_events(_messages(_EVENT_MESSAGES)(s, d))

register("envelope_parse_cdc", _cdc, f"SELECT * FROM {_CDC}")
register("envelope_parse_events", _evt, f"SELECT * FROM {_EVT}")
register(
    "transport_quarantine",
    lambda s, d: envelope.invalid(_cdc(s, d)).unionByName(envelope.invalid(_evt(s, d))),
    " UNION ALL ".join(
        f"""SELECT topic, "partition", "offset", key, status AS parse_error, CASE WHEN status = 'INVALID_JSON' THEN value END AS raw_value,
        captured_at, batch_id FROM {t} WHERE status NOT IN ('VALID', 'TOMBSTONE')"""
        for t in (_CDC, _EVT)
    ),
)


def _watermark_sql(t: str, lsn: str) -> str:
    return f"""SELECT dataset, batch_id, count(*) AS record_count, min("offset") AS min_kafka_offset, max("offset") AS max_kafka_offset,
    min({lsn}) AS min_source_lsn, max({lsn}) AS max_source_lsn, array_to_string(list_sort(list(DISTINCT topic)), ',') AS topics
    FROM {t} WHERE status = 'VALID' GROUP BY dataset, batch_id"""


register("batch_watermarks", lambda s, d: envelope.watermarks(envelope.valid(_cdc(s, d))), _watermark_sql(_CDC, "_source_lsn"))


def _entries(spark, sf_dir):
    cdc = manifest.artifacts(envelope.watermarks(envelope.valid(_cdc(spark, sf_dir))), "CDC")
    return cdc.unionByName(manifest.artifacts(envelope.watermarks(envelope.valid(_evt(spark, sf_dir))), "EVENT"))


def _manifest(spark, sf_dir):
    counts = [F.col(f"source_record_counts.{t}").alias(f"{t.lower()}_records") for t in manifest.SOURCE_TYPES]
    paths = F.transform("artifacts", lambda a: a["path"]).alias("paths")
    return manifest.manifest(_entries(spark, sf_dir)).select("batch_id", "manifest_version", "artifact_count", "total_records", *counts, paths)


_ENTRIES_SQL = " UNION ALL ".join(
    f"""SELECT batch_id, '{kind.lower()}/' || dataset || '/batch-' || batch_id || '.jsonl' AS path, count(*) AS n, '{kind}' AS kind
    FROM {t} WHERE status = 'VALID' GROUP BY dataset, batch_id"""
    for kind, t in (("CDC", _CDC), ("EVENT", _EVT))
)
register(
    "manifest",
    _manifest,
    f"""SELECT batch_id, '1.0' AS manifest_version, count(*) AS artifact_count, CAST(sum(n) AS BIGINT) AS total_records,
    CAST(coalesce(sum(n) FILTER (WHERE kind = 'CDC'), 0) AS BIGINT) AS cdc_records,
    CAST(coalesce(sum(n) FILTER (WHERE kind = 'EVENT'), 0) AS BIGINT) AS event_records, CAST(0 AS BIGINT) AS file_records,
    string_agg(path, ',' ORDER BY path) AS paths FROM ({_ENTRIES_SQL}) GROUP BY batch_id""",
)


def _reconcile(spark, sf_dir):
    listed = _entries(spark, sf_dir).select("path", "record_count", F.sha2("path", 256).alias("sha256"))
    late = F.col("path").contains("2024-01-1")
    seen = listed.where(~F.col("path").contains("view")).select(
        "path",
        F.when(late, F.col("record_count") + 1).otherwise(F.col("record_count")).alias("record_count"),
        F.when(F.col("path").startswith("event"), F.lit("other")).otherwise(F.col("sha256")).alias("sha256"),
    )
    return manifest.reconcile(listed.where(~F.col("path").contains("click")), seen)


_SEEN = f"(SELECT path, n, sha256(path) AS h FROM ({_ENTRIES_SQL}))"
register(
    "manifest_reconciliation",
    _reconcile,
    f"""WITH l AS (SELECT * FROM {_SEEN} WHERE path NOT LIKE '%click%'),
    s AS (SELECT path, CASE WHEN path LIKE '%2024-01-1%' THEN n + 1 ELSE n END AS n,
          CASE WHEN path LIKE 'event%' THEN 'other' ELSE h END AS h FROM {_SEEN} WHERE path NOT LIKE '%view%')
    SELECT path, 'FILE_MISSING' AS reason, CAST(n AS VARCHAR) AS expected, CAST(NULL AS VARCHAR) AS actual FROM l WHERE path NOT IN (SELECT path FROM s)
    UNION ALL SELECT path, 'FILE_NOT_LISTED', NULL, CAST(n AS VARCHAR) FROM s WHERE path NOT IN (SELECT path FROM l)
    UNION ALL SELECT path, 'RECORD_COUNT', CAST(l.n AS VARCHAR), CAST(s.n AS VARCHAR) FROM l JOIN s USING (path) WHERE l.n <> s.n
    UNION ALL SELECT path, 'SHA256', l.h, s.h FROM l JOIN s USING (path) WHERE l.h <> s.h""",
)


def _bronze(spark, sf_dir):
    """Bronze rows straight from parsed change messages."""
    schema = landing.string_schema(["id", "amount"])
    body = "op string, ts_ms bigint, source struct<lsn: bigint, snapshot: string>"
    messages = envelope.valid(_cdc(spark, sf_dir)).select(
        "topic", "partition", "offset", "key", "load_type", "captured_at", "batch_id", "dataset",
        F.from_json("value", body).alias("payload"), F.col("record").alias("value"),
    )
    rows = rescue.with_rescued(messages, schema)
    packed = rows.withColumn("record", F.struct("id", "amount", F.col("dataset").alias("landed_in")))
    at = F.lit(AS_OF).cast("timestamp")
    return bronze.cdc_rows(packed, "shop", at, files=False)


_BRONZE_SQL = f"""SELECT json_extract_string(record, '$.id') AS id, json_extract_string(record, '$.amount') AS amount, dataset AS landed_in,
    'shop' AS _source_dataset, load_type AS _load_type, _operation, _snapshot_state, _source_lsn, _commit_ts, topic AS _topic,
    "partition" AS _kafka_partition, "offset" AS _kafka_offset, key AS _record_key, batch_id AS _batch_id,
    CAST(captured_at AS TIMESTAMP) AS _captured_at, CASE WHEN json_extract_string(record, '$.extra') = 'x' THEN '{{"extra":"x"}}' END AS _rescued_data,
    TIMESTAMP '{AS_OF}' AS _ingested_at FROM {_CDC} WHERE status = 'VALID'"""
register("bronze_projection", _bronze, _BRONZE_SQL)


def _refused(spark, sf_dir):
    at = F.lit(AS_OF).cast("timestamp")
    rows = _bronze(spark, sf_dir).withColumn("_source_file", F.col("landed_in"))
    return bronze.ingestion_quarantine(
        [
            bronze.rescued_rows(rows, "cdc", "shop", at),
            bronze.refused_messages(envelope.invalid(_cdc(spark, sf_dir)), "cdc", at=at),
            bronze.refused_messages(envelope.invalid(_evt(spark, sf_dir)), "event", at=at),
        ]
    )


def _refused_sql(t: str, kind: str) -> str:
    return f"""SELECT '{kind}' AS source_type, CAST(NULL AS VARCHAR) AS source_dataset, status AS failure_reason,
    CASE WHEN status = 'INVALID_JSON' THEN value END AS rescued_data, CAST(NULL AS VARCHAR) AS source_file, batch_id,
    TIMESTAMP '{AS_OF}' AS quarantined_at FROM {t} WHERE status NOT IN ('VALID', 'TOMBSTONE')"""


register(
    "ingestion_quarantine",
    _refused,
    f"""SELECT 'CDC' AS source_type, 'shop' AS source_dataset, 'SCHEMA_RESCUED_DATA' AS failure_reason, _rescued_data AS rescued_data,
    landed_in AS source_file, _batch_id AS batch_id, TIMESTAMP '{AS_OF}' AS quarantined_at FROM ({_BRONZE_SQL}) WHERE _rescued_data IS NOT NULL
    UNION ALL {_refused_sql(_CDC, 'CDC')} UNION ALL {_refused_sql(_EVT, 'EVENT')}""",
)


def _files(spark, sf_dir):
    day = F.date_format("o_orderdate", "yyyyMMdd")
    stamp = F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("orders-"), day, F.lit("T000000Z.csv"))).otherwise(
        F.concat(F.lit("orders_"), day, F.lit(".csv"))
    )
    path = F.concat(F.lit("/landing/file/orders/"), stamp)
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", bronze.file_load_type(path).alias("_load_type"), bronze.file_batch(path).alias("_batch_id")
    )


register(
    "file_load_type",
    _files,
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'INCREMENTAL' ELSE 'INITIAL' END AS _load_type,
    CASE WHEN o_orderstatus = 'O' THEN 'orders-' || strftime(o_orderdate, '%Y%m%d') || 'T000000Z' ELSE 'orders_' || strftime(o_orderdate, '%Y%m%d') END AS _batch_id
    FROM orders""",
)
SOURCES_USED = sorted(SOURCES)


def _source_quarantine(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    columns = ["entity_name", "validation_stage", "record_key", "failed_rule_ids", "processed_at"]
    return reduce(DataFrame.unionByName, [w.source_quarantine(s).select(*columns) for s in SOURCES_USED])


def _refused(source: str) -> str:
    key, fields = REQUIRED[source]
    failed = ", ".join(f"CASE WHEN \"{f}\" IS NULL THEN 'SOURCE_{f.upper()}_REQUIRED' END" for f in fields.split())
    lacks = " OR ".join(f'"{f}" IS NULL' for f in fields.split())
    return f"""SELECT '{source}' AS entity_name, 'PRE_TRANSFORM' AS validation_stage, coalesce(CAST("{key}" AS VARCHAR), '') AS record_key,
        concat_ws(',', {failed}) AS failed_rule_ids, TIMESTAMP '{AS_OF}' AS processed_at FROM src_{source} WHERE {lacks}"""


register("source_quarantine", _source_quarantine, compose(" UNION ALL ".join(_refused(s) for s in SOURCES_USED)))
