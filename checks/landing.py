"""Landing files made from the given tables, read with rescue, header names, evolution and quarantine."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from checks.catalogue import register
from checks.estate import read
from ledgerstone.session import shared_folder
from ledgerstone.sources import bronze, landing, registry
from ledgerstone.streaming.ingestion import Ingestion

RECORD = StructType([StructField("id", LongType()), StructField("kind", StringType()), StructField("qty", DoubleType())])
TABLES = registry.bronze_tables()


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/landing-{uuid.uuid4().hex}"


# --- CSV by header name

_HEADERS = {  # order, further and absent columns by group of customers
    0: ["c_custkey", "c_name", "c_acctbal"],
    1: ["c_acctbal", "note", "C_CUSTKEY", "c_name", "c_mktsegment"],
    2: ["c_mktsegment", "c_acctbal", "c_custkey"],
}


def landing_csv_by_header(spark, sf_dir):
    root = _folder(spark)
    note = F.concat(F.lit('said "hi", '), F.col("c_custkey").cast("string"))
    rows = read(spark, sf_dir, "customer").withColumn("note", note).withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(15,2)"))
    for group, names in _HEADERS.items():
        part = rows.where(F.col("c_custkey") % len(_HEADERS) == group).select(*[F.col(n.lower()).alias(n) for n in names])
        part.write.option("header", "true").option("escape", '"').csv(f"{root}/{group}")
    found = landing.csv_rows(spark, f"{root}/*", ["c_custkey", "c_name", "c_acctbal", "c_phone_2"])
    return found.drop("_metadata")


register(
    "landing_csv_by_header",
    landing_csv_by_header,
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CASE WHEN c_custkey % 3 <> 2 THEN c_name END AS c_name,
    CAST(CAST(c_acctbal AS DECIMAL(15,2)) AS VARCHAR) AS c_acctbal, CAST(NULL AS VARCHAR) AS c_phone_2,
    CASE c_custkey % 3 WHEN 1 THEN '{"note":"said \\"hi\\", ' || c_custkey || '","c_mktsegment":"' || c_mktsegment || '"}'
      WHEN 2 THEN '{"c_mktsegment":"' || c_mktsegment || '"}' END AS _rescued_data FROM customer""",
)


# --- Every data set of the landing area: data set n holds the events whose id leaves n when divided by their number

_EXTRA = "value < 2"
_WRONG = "value > 100 AND value <= 150"
_BROKEN = "value < 0.3 OR event_type = 'error' AND value > 150"


def _line(event: bool) -> str:
    """An envelope as JSON text."""
    payload = '{"event_id":"e"}' if event else '{"op":"c","source":{"lsn":1}}'
    return f"""CASE WHEN {_BROKEN} THEN '{{"topic": broken' ELSE '{{"topic":"t","payload":{payload},"record":{{"id":' || CAST(event_id AS STRING)
      || ',"kind":"' || event_type || '","qty":' || CASE WHEN {_WRONG} THEN '"many"' ELSE '1.5' END
      || CASE WHEN {_EXTRA} THEN ',"more":{{"n":' || CAST(event_id AS STRING) || '}}' ELSE '' END
      || '}},"batch_id":"b' || CAST(user_id % 5 AS STRING) || '"' || CASE WHEN user_id % 11 = 0 THEN ',"trace":[1,"x"]' ELSE '' END || '}}' END AS value"""


def _land(spark: SparkSession, root: str, table: str, events: DataFrame) -> None:
    kind, _, dataset = table.partition("_")
    path = registry.landing_path(root, kind, dataset)
    if kind == "file":
        plain, wider = events.where(~F.expr(_EXTRA)), events.where(_EXTRA)
        for part, columns in ((plain, ["event_id AS id", "event_type AS kind", "value AS qty"]), (wider, ["event_type AS kind", "event_id AS id", "user_id AS more"])):
            part.selectExpr(*columns).write.mode("append").option("header", "true").csv(path)
    else:
        events.selectExpr(_line(kind == "event")).write.mode("append").text(path)


def _land_invalid(spark: SparkSession, root: str, events: DataFrame) -> None:
    for kind, of in (("cdc", "error"), ("event", "signup")):
        rows = events.where(F.col("event_type") == of).selectExpr("CAST(event_id AS STRING) AS key", "'INVALID_JSON' AS parse_error", "'{' || event_type AS raw_value", "'b1' AS batch_id")
        rows.write.mode("append").json(f"{root}/quarantine/{kind}")


def landing_quarantine(spark, sf_dir):
    root, events = _folder(spark), read(spark, sf_dir, "events")
    for n, table in enumerate(TABLES):
        _land(spark, root, table, events.where(F.col("event_id") % len(TABLES) == n))
    _land_invalid(spark, root, events)
    records = {t.partition("_")[2]: RECORD for t in TABLES}
    return bronze.landing_quarantine(spark, root, records).drop("source_file", "quarantined_at")


def _rescued_sql() -> str:
    """Rescued JSON of an event's line, by the rules that ``_line`` plants."""
    return f"""CASE WHEN ({_WRONG}) OR ({_EXTRA}) OR user_id % 11 = 0 THEN '{{' || concat_ws(',',
      CASE WHEN user_id % 11 = 0 THEN '"trace":[1,"x"]' END,
      CASE WHEN ({_WRONG}) OR ({_EXTRA}) THEN '"record":{{' || concat_ws(',', CASE WHEN {_EXTRA} THEN '"more":{{"n":' || event_id || '}}' END,
        CASE WHEN {_WRONG} THEN '"qty":"many"' END) || '}}' END) || '}}' END"""


def _names(kind: str) -> str:
    return ", ".join(f"({n}, '{t.partition('_')[2]}')" for n, t in enumerate(TABLES) if t.startswith(kind))


def _quarantine_sql() -> str:
    parts = []
    for kind in ("cdc", "event"):
        of = f"(SELECT e.*, d.name, {_BROKEN} AS broken FROM events e JOIN (VALUES {_names(kind)}) d(n, name) ON event_id % {len(TABLES)} = d.n)"
        rescued = _rescued_sql()
        parts.append(f"""SELECT '{kind.upper()}' AS source_type, name AS source_dataset, 'UNREADABLE_LINE' AS failure_reason, '{{"topic": broken' AS rescued_data,
            CAST(NULL AS VARCHAR) AS batch_id FROM {of} WHERE broken""")
        parts.append(f"""SELECT '{kind.upper()}', name, 'SCHEMA_RESCUED_DATA', {rescued}, 'b' || user_id % 5 FROM {of} WHERE NOT broken AND {rescued} IS NOT NULL""")
    parts.append(f"""SELECT 'FILE', name, 'SCHEMA_RESCUED_DATA', '{{"more":"' || user_id || '"}}', 'part' FROM events
        JOIN (VALUES {_names('file')}) d(n, name) ON event_id % {len(TABLES)} = d.n WHERE {_EXTRA}""")
    for kind, of in (("CDC", "error"), ("EVENT", "signup")):
        parts.append(f"SELECT '{kind}', NULL, 'INVALID_JSON', '{{' || event_type, 'b1' FROM events WHERE event_type = '{of}'")
    return " UNION ALL ".join(parts)


def _of_run(frame: DataFrame) -> DataFrame:
    """Batches of CSV rows are named after their files, whose names Spark's writer draws."""
    return frame.withColumn("batch_id", F.when(F.col("source_type") == "FILE", F.lit("part")).otherwise(F.col("batch_id")))


register("landing_quarantine", lambda s, d: _of_run(landing_quarantine(s, d)), _quarantine_sql())


# --- Streams over several batches, restarted with the columns that the first run rescued

_STREAMED = ("cdc_customers", "event_status_change_history", "file_energy_plans")


def landing_streams(spark, sf_dir):
    """Half of the events land and are drained, the schemas grow by what was rescued, then the other half lands."""
    root, out, events = _folder(spark), _folder(spark), read(spark, sf_dir, "events")
    live = Ingestion(spark, root, out, {t.partition("_")[2]: RECORD for t in _STREAMED})
    _land_invalid(spark, root, events)
    for half in (0, 1):
        for n, table in enumerate(_STREAMED):
            of = events.where((F.col("event_id") % len(_STREAMED) == n) & (F.col("event_id") / len(_STREAMED)).cast("long").bitwiseAND(1).eqNullSafe(half))
            _land(spark, root, table, of.repartition(3))
        if half:
            live.evolve()
        for query in live.start(files_per_batch=2):
            query.awaitTermination()
    parts = []
    for table in _STREAMED:
        rows = live.table(table)
        more = rows["more"].cast("string") if table.startswith("file") else F.to_json(rows["more"])
        parts.append(rows.select(F.lit(table).alias("name"), F.col("id").cast("long"), "kind", F.col("qty").cast("string"), more.alias("more"), "_rescued_data"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _streams_sql() -> str:
    names = ", ".join(f"({n}, '{t}')" for n, t in enumerate(_STREAMED))
    of = f"(SELECT e.*, d.name, {_BROKEN} AS broken, event_id // {len(_STREAMED)} % 2 = 1 AS later FROM events e JOIN (VALUES {names}) d(n, name) ON event_id % {len(_STREAMED)} = d.n)"
    first = _rescued_sql()
    second = f"""CASE WHEN ({_WRONG}) OR user_id % 11 = 0 THEN '{{' || concat_ws(',', CASE WHEN user_id % 11 = 0 THEN '"trace":[1,"x"]' END,
      CASE WHEN {_WRONG} THEN '"record":{{"qty":"many"}}' END) || '}}' END"""
    json = f"""SELECT name, event_id AS id, event_type AS kind, CASE WHEN NOT ({_WRONG}) THEN '1.5' END AS qty,
      CASE WHEN later AND ({_EXTRA}) THEN '{{"n":' || event_id || '}}' END AS more, CASE WHEN later THEN {second} ELSE {first} END AS _rescued_data
      FROM {of} WHERE name NOT LIKE 'file%' AND NOT broken"""
    file = f"""SELECT name, event_id, event_type, CASE WHEN NOT ({_EXTRA}) THEN CAST(value AS VARCHAR) END, CASE WHEN later AND ({_EXTRA}) THEN CAST(user_id AS VARCHAR) END,
      CASE WHEN NOT later AND ({_EXTRA}) THEN '{{"more":"' || user_id || '"}}' END FROM {of} WHERE name LIKE 'file%'"""
    return f"{json} UNION ALL {file}"


register("landing_streams", landing_streams, _streams_sql())
