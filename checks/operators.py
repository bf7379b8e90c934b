"""Single operators on the check tables themselves."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from checks import oracle as o
from checks.catalogue import checked, register
from checks.estate import AS_OF, CHECK_KEY, read
from ledgerstone import functions as fn
from ledgerstone.session import shared_folder
from ledgerstone.operators import derive, history, joins, ordered, quality
from ledgerstone.operators.quality import ERROR, WARNING, Contract, Rule
from ledgerstone.plans.gold import calendar

# --- masks and scalars -----------------------------------------------------------


@checked(
    f"""SELECT o_orderkey, {o.band("'$ ' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)")} AS amount_band,
    {o.band_of("CAST(l AS DECIMAL(18,2))")} AS loss_band FROM (SELECT *, 250000 - o_totalprice AS l FROM orders)"""
)
def mask_amount_band(spark, sf_dir):
    money = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    loss = (F.lit(250000) - F.col("o_totalprice")).cast("decimal(18,2)").cast("string")
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        fn.amount_band(F.concat(F.lit("$ "), money)).alias("amount_band"),
        fn.amount_band(loss).alias("loss_band"),
    )


_NUM = "CAST(c_custkey * 7919 AS VARCHAR)"


@checked(
    f"""SELECT c_custkey, {o.email("c_name || CASE WHEN c_acctbal > 0 THEN '@' ELSE '@@' END || 'Example.com'")} AS email_masked,
    {o.phone("'04-' || " + _NUM)} AS phone_masked, {o.identifier("' ' || " + _NUM)} AS identifier_masked,
    {o.card("'4111 ' || " + _NUM)} AS card_masked, {o.identifier(_NUM)} AS short_identifier FROM customer"""
)
def mask_contact_details(spark, sf_dir):
    number = (F.col("c_custkey") * 7919).cast("string")
    at = F.when(F.col("c_acctbal") > 0, "@").otherwise("@@")
    return read(spark, sf_dir, "customer").select(
        "c_custkey",
        fn.mask_email(F.concat("c_name", at, F.lit("Example.com"))).alias("email_masked"),
        fn.mask_phone(F.concat(F.lit("04-"), number)).alias("phone_masked"),
        fn.mask_identifier(F.concat(F.lit(" "), number)).alias("identifier_masked"),
        fn.mask_card(F.concat(F.lit("4111 "), number)).alias("card_masked"),
        fn.mask_identifier(number).alias("short_identifier"),
    )


@checked(f"SELECT c_custkey, {o.token('c_name')} AS name_token FROM customer")
def hmac_name_token(spark, sf_dir):
    return read(spark, sf_dir, "customer").select("c_custkey", fn.name_token(F.col("c_name"), CHECK_KEY).alias("name_token"))


@checked(f"SELECT p_partkey, {o.age('p_size + 10')} AS age_band FROM part")
def age_band(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", fn.age_band(F.col("p_size") + 10).alias("age_band"))


_EMAIL = r"(^|[^\p{L}\p{N}_])([A-Za-z0-9_][A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\.[A-Za-z]{2,})\b"
_MOBILE = r"(^|[^0-9])(?:\+?61[ -]?4|04)[ -]?[0-9]{2}[ -]?[0-9]{3}[ -]?[0-9]{3}($|[^0-9])"
_TAX = r"(^|[^0-9])[0-9]{3}[ -]?[0-9]{3}[ -]?[0-9]{3}($|[^0-9])"


def _scrub_sql(x: str) -> str:
    sql = f"regexp_replace({x}, '{_EMAIL}', '\\1[EMAIL]', 'g')"
    for pattern, name in ((_MOBILE, "AU_MOBILE"), (_TAX, "TFN_LIKE")):
        for _ in range(2):  # neighbours share a border character, so a second pass takes every other match
            sql = f"regexp_replace({sql}, '{pattern}', '\\1[{name}]\\2', 'g')"
    return sql


@checked(
    f"""SELECT 'document-' || doc_id AS text_id, {_scrub_sql('text')} AS scrubbed FROM documents
    UNION ALL SELECT 'turn-' || conv_id || '-' || turn, {_scrub_sql('text')} FROM conversations"""
)
def pii_scrub_text(spark, sf_dir):
    documents = read(spark, sf_dir, "documents").select(F.concat(F.lit("document-"), "doc_id").alias("text_id"), "text")
    turns = read(spark, sf_dir, "conversations").select(
        F.concat_ws("-", F.lit("turn"), "conv_id", "turn").alias("text_id"), "text"
    )
    return documents.unionByName(turns).select("text_id", fn.scrub_pii(F.col("text")).alias("scrubbed"))


def _count_sql(tag: str) -> str:
    return f"CAST(sum((length(s) - length(replace(s, '[{tag}]', ''))) / {len(tag) + 2}) AS BIGINT)"


@checked(
    f"""SELECT lang, {', '.join(f'{_count_sql(t)} AS {t.lower()}_count' for t in ('EMAIL', 'AU_MOBILE', 'TFN_LIKE'))},
    count(*) AS documents FROM (SELECT lang, {_scrub_sql('text')} AS s FROM documents) GROUP BY lang"""
)
def pii_counts_by_language(spark, sf_dir):
    counts = fn.pii_counts(F.col("text"))
    return read(spark, sf_dir, "documents").groupBy("lang").agg(
        *[F.sum(c).alias(f"{name.lower()}_count") for name, c in counts.items()], F.count("*").alias("documents")
    )


@checked(
    f"""SELECT c_custkey, sha256(c_name) AS c_name, {o.band('CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR)')} AS c_acctbal,
    {o.age('c_nationkey + 10')} AS age, CAST(NULL AS VARCHAR) AS note FROM customer"""
)
def column_handling(spark, sf_dir):
    rows = read(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("c_acctbal"),
        (F.col("c_nationkey") + 10).cast("string").alias("age"), F.col("c_mktsegment").alias("note"), "c_nationkey",
    )
    return derive.private(
        rows, {"c_name": "hash", "c_acctbal": "range_bucket", "age": "generalise", "note": "redact", "c_nationkey": "remove"}
    )


# --- change logs -----------------------------------------------------------------


def _log(spark, sf_dir):
    return read(spark, sf_dir, "events").withColumn("seq", F.col("ts").cast("timestamp")).drop("ts")


@checked("SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_by(spark, sf_dir):
    return ordered.latest_by(read(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])


@checked(
    """SELECT * FROM (SELECT * FROM events WHERE value > 1
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) WHERE event_type <> 'error'"""
)
def current_snapshot(spark, sf_dir):
    rows = read(spark, sf_dir, "events").withColumns(
        {
            "complete": F.when(F.col("value") > 1, F.lit(True)),
            "_operation": F.when(F.col("event_type") == "error", "DELETE").otherwise("UPDATE"),
        }
    )
    return history.current_snapshot(rows, ["user_id"], ["complete"], ["ts", "event_id"]).drop("complete", "_operation")


_EVENT_HISTORY = o.scd2_sql("events", "user_id", ["event_type"], ["event_id", "value"], "ts, event_id", "event_type = 'error'", "ts")


def _event_history(spark, sf_dir):
    log = _log(spark, sf_dir).select("user_id", "event_type", "value", "event_id", "seq")
    tagged = log.withColumn("_tie", F.col("event_id"))
    return history.scd2(
        tagged, ["user_id"], "seq", ["_tie"], ["event_id", "value"], F.col("event_type") == "error", chunk_unit="day"
    )


register("scd2_history", _event_history, _EVENT_HISTORY)
register("scd2_current", lambda s, d: history.current(_event_history(s, d)), f"SELECT * FROM ({_EVENT_HISTORY}) WHERE __END_AT IS NULL")
_MOMENT = datetime(2024, 1, 15, 12)
register(
    "scd2_as_of",
    lambda s, d: history.as_of(_event_history(s, d), _MOMENT),
    f"""SELECT * FROM ({_EVENT_HISTORY}) WHERE __START_AT <= TIMESTAMP '{_MOMENT}'
    AND (__END_AT IS NULL OR __END_AT > TIMESTAMP '{_MOMENT}')""",
)

_CUTS = [datetime(2024, 1, d) for d in (8, 15, 22, 31)] + [datetime(2024, 3, 1)]  # the last lies after all events


def _state_sql(cut: datetime) -> str:
    return f"""(SELECT user_id, event_type, event_id FROM events WHERE ts < TIMESTAMP '{cut}'
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)"""


def _snapshot_sql() -> str:
    live = " UNION ALL ".join(
        f"SELECT user_id, event_type, event_id, TIMESTAMP '{c}' AS moment FROM {_state_sql(c)} WHERE event_type <> 'error'" for c in _CUTS
    )
    grid = f"(SELECT DISTINCT user_id FROM ({live})) u CROSS JOIN (VALUES {', '.join(f'(TIMESTAMP {chr(39)}{c}{chr(39)})' for c in _CUTS)}) t(moment)"
    full = f"""(SELECT u.user_id, t.moment, l.event_type, l.event_id, l.user_id IS NULL AS missing FROM {grid}
      LEFT JOIN ({live}) l ON l.user_id = u.user_id AND l.moment = t.moment)"""
    return o.scd2_sql(full, "user_id", ["event_type"], ["event_id"], "moment", "missing", "moment")


@checked(_snapshot_sql())
def snapshot_diff_scd2(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    snapshots = []
    for cut in _CUTS:
        state = ordered.latest_by(events.where(F.col("ts") < F.lit(cut).cast("timestamp_ntz")), ["user_id"], ["ts", "event_id"])
        snapshots.append((cut, state.where(F.col("event_type") != "error").select("user_id", "event_type", "event_id")))
    return history.scd2_from_snapshots(snapshots, ["user_id"], ["event_id"])


@checked(
    """SELECT o_orderkey, sha256(concat_ws('|', 'customer,orders', CAST(o_orderkey AS VARCHAR), coalesce(CAST(c_custkey AS VARCHAR), '')))
      AS pipeline_run_id, 'customer,orders' AS source_table, greatest(o_orderdate, TIMESTAMP '1998-01-01') AS processed_at,
      'CLEAN' AS masking_status FROM orders LEFT JOIN customer ON c_custkey = o_custkey"""
)
def audit_columns(spark, sf_dir):
    customers = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_custkey")
    rows = joins.lookup(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), customers, ["o_custkey"])
    return history.with_audit_columns(
        rows, ["orders", "customer"], [F.col("o_orderkey"), F.col("c_custkey")],
        [F.col("o_orderdate"), F.lit("1998-01-01 00:00:00")], "CLEAN",
    ).drop("o_custkey", "c_custkey", "o_orderdate")


@checked(
    """SELECT event_id, user_id, lag(event_type) OVER w AS before, lead(event_type) OVER w AS after,
      CAST(row_number() OVER w AS INTEGER) AS position FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""
)
def neighbours_and_ordinal(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    day = ordered.time_chunk(F.col("ts"), "day")
    near = ordered.with_neighbours(rows, ["user_id"], ["ts", "event_id"], day, ["event_type"], ["event_type"])
    return ordered.with_ordinal(near, ["user_id"], ["ts", "event_id"], day, "position").select(
        "event_id", "user_id", F.col("_previous.event_type").alias("before"), F.col("_following.event_type").alias("after"), "position"
    )


# --- rules -------------------------------------------------------------------------

_ORDER_RULES = Contract(
    "orders",
    ("o_orderkey",),
    (
        Rule("PRICE_HIGH", ERROR, "conformity", "o_totalprice <= 450000"),
        Rule("STATUS_KNOWN", ERROR, "conformity", "o_orderstatus IN ('F', 'O')"),
        Rule("PRIORITY_SET", WARNING, "completeness", "o_orderpriority != '4-NOT SPECIFIED'"),
        Rule("RECENT", WARNING, "timeliness", "o_orderdate >= date_sub({today}, 9000)"),
        Rule("EVEN_SPREAD", WARNING, "consistency", "nullif(o_orderstatus, 'O') = 'F'"),
    ),
)
_HARD = quality.compile_rules(_ORDER_RULES, ERROR, AS_OF)
_SOFT = quality.compile_rules(_ORDER_RULES, WARNING, AS_OF)


def _failed_sql(rules) -> str:
    cases = [f"CASE WHEN NOT coalesce({o.predicate(p)}, false) THEN '{name}' END" for name, p in rules.items()]
    return f"concat_ws(',', {', '.join(cases)})"


@checked(
    f"""SELECT o_orderkey, h AS failed_hard_rules, w AS failed_warning_rules,
    CASE WHEN h <> '' THEN 'QUARANTINED' WHEN w <> '' THEN 'WARNING' ELSE 'PASSED' END AS quality_status
    FROM (SELECT *, {_failed_sql(_HARD)} AS h, {_failed_sql(_SOFT)} AS w FROM orders)"""
)
def dq_status(spark, sf_dir):
    rows = quality.with_status(read(spark, sf_dir, "orders"), _HARD, _SOFT)
    return rows.select("o_orderkey", "failed_hard_rules", "failed_warning_rules", "quality_status")


@checked(
    f"""SELECT sha256(concat_ws('|', 'orders', CAST(o_orderkey AS VARCHAR), s, '2024-02-01 00:00:00')) AS failure_id,
    'PRE_TRANSFORM' AS validation_stage, 'orders' AS contract_id, '1.0.0' AS contract_version, 'orders' AS entity_name,
    CAST(o_orderkey AS VARCHAR) AS record_key, f AS failed_rule_ids, CAST(NULL AS VARCHAR) AS source_reference,
    '{{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}}' AS record_payload,
    {o.NOW} AS processed_at, '{_ORDER_RULES.fingerprint}' AS contract_hash
    FROM (SELECT *, {_failed_sql(_HARD)} AS f, {_failed_sql(dict(sorted(_HARD.items())))} AS s FROM orders) WHERE f <> ''"""
)
def dq_quarantine_envelope(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    rows = quality.quarantined(rows, _ORDER_RULES, _HARD, quality.PRE_TRANSFORM, AS_OF)
    pruned = F.to_json(F.from_json("record_payload", "o_orderkey bigint, o_orderstatus string"))
    return rows.withColumn("record_payload", pruned)


_METRICS = " UNION ALL ".join(
    f"""SELECT 'orders' AS entity_name, '{r.id}' AS rule_id, '{r.severity}' AS severity, '{r.dimension}' AS dimension,
    count(*) FILTER (WHERE {o.predicate((_HARD | _SOFT)[r.id])}) AS passed_count,
    count(*) - count(*) FILTER (WHERE {o.predicate((_HARD | _SOFT)[r.id])}) AS failed_count FROM orders"""
    for r in _ORDER_RULES.rules
)
register("dq_metrics", lambda s, d: quality.rule_metrics(read(s, d, "orders"), _ORDER_RULES, AS_OF), _METRICS)


def _metrics_while_writing(spark, sf_dir):
    """The same numbers, counted while the rows are written, without a scan of their own."""
    rows, metrics = quality.observed(read(spark, sf_dir, "orders"), _ORDER_RULES, AS_OF)
    rows.write.parquet(f"{shared_folder(spark)}/metrics-{uuid.uuid4().hex}")
    return metrics()


register("dq_metrics_while_writing", _metrics_while_writing, _METRICS)
register(
    "dq_quality_by_dimension",
    lambda s, d: quality.quality_by_dimension(quality.rule_metrics(read(s, d, "orders"), _ORDER_RULES, AS_OF)),
    f"""SELECT entity_name, dimension, CAST(sum(passed_count) AS BIGINT) AS passed_count, CAST(sum(failed_count) AS BIGINT) AS failed_count,
    round(sum(passed_count) / sum(passed_count + failed_count), 6) AS pass_rate FROM ({_METRICS}) GROUP BY ALL""",
)
_BROKEN = " OR ".join(f"NOT coalesce({o.predicate(p)}, false)" for p in _HARD.values())
register(
    "dq_tolerance",
    lambda s, d: quality.tolerance_check(read(s, d, "orders"), _ORDER_RULES, AS_OF, F.col("o_orderdate") < F.lit("1995-02-01")),
    f"""SELECT 'orders' AS entity_name, m AS metric, n AS breach_count, round(n / t, 6) AS rate, l AS tolerance, n / t <= l AS within_tolerance
    FROM (SELECT 'hardFailureRate' AS m, count(*) FILTER (WHERE {_BROKEN}) AS n, count(*) AS t, 0.01::DOUBLE AS l FROM orders
    UNION ALL SELECT 'freshnessBreachRate', count(*) FILTER (WHERE o_orderdate < DATE '1995-02-01'), count(*), 0.05 FROM orders)""",
)
register(
    "dq_freshness_lag",
    lambda s, d: quality.freshness_lag(read(s, d, "events"), "ts", AS_OF),
    f"""SELECT max(ts) AS latest_processed_at, CAST(floor((epoch({o.NOW}) - floor(epoch(max(ts)))) / 60) AS BIGINT) AS lag_minutes,
    floor((epoch({o.NOW}) - floor(epoch(max(ts)))) / 60) <= 30 AS is_fresh FROM events""",
)


def _library(spark, sf_dir):
    lines = quality.library_metrics(
        read(spark, sf_dir, "lineitem"),
        [
            ("nullValues", "l_shipdate", {}),
            ("invalidValues", "l_returnflag", {"values": ["A", "N"]}),
            ("duplicateValues", "l_orderkey", {}),
        ],
    )
    customers = quality.library_metrics(
        read(spark, sf_dir, "customer"),
        [("invalidValues", "c_name", {"pattern": "^Customer#[0-9]{8}[0-4]$"}), ("duplicateValues", "c_custkey", {})],
    )
    return lines.unionByName(customers)


register(
    "dq_library_metrics",
    _library,
    """SELECT *, actual = 0 AS passed FROM (
      SELECT 'nullValues' AS metric, 'l_shipdate' AS column_name, count(*) FILTER (WHERE l_shipdate IS NULL) AS actual FROM lineitem
      UNION ALL SELECT 'invalidValues', 'l_returnflag', count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) FROM lineitem
      UNION ALL SELECT 'duplicateValues', 'l_orderkey', count(l_orderkey) - count(DISTINCT l_orderkey) FROM lineitem
      UNION ALL SELECT 'invalidValues', 'c_name', count(*) FILTER (WHERE NOT regexp_matches(c_name, '^Customer#[0-9]{8}[0-4]$')) FROM customer
      UNION ALL SELECT 'duplicateValues', 'c_custkey', count(c_custkey) - count(DISTINCT c_custkey) FROM customer)""",
)


@checked(
    f"""SELECT r_regionkey, r_name, 'regions' AS contract_name, '1.0.0' AS contract_version,
    '{Contract('regions', limitations=('names only',)).fingerprint}' AS contract_hash, 'names only' AS known_limitations,
    {o.NOW} AS quality_evaluated_at FROM region"""
)
def contract_metadata(spark, sf_dir):
    return quality.with_contract_metadata(read(spark, sf_dir, "region"), Contract("regions", limitations=("names only",)), AS_OF)


# --- derivations -------------------------------------------------------------------

_TEXT = {"signup": "Joined", "view": "Looked", "click": "Chose", "error": "Internal fault"}


def _derived(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    rows = derive.with_lineage(
        derive.translated(events, "event_type", _TEXT, "safe_text", ["error"]), "events", ["event_id"]
    )
    ranked = derive.recency_rank(rows, "user_id", "ts", "event_id")
    return ranked.select(
        "event_id",
        (F.col("value") > 50).alias("is_large"),
        derive.days_open(F.col("ts"), F.when(F.col("value") > 10, F.col("ts")), AS_OF).alias("days_open"),
        derive.first_like(F.col("event_type"), [("s_gn%", "START"), ("%c_", "INPUT"), ("e%", "FAULT")], "OTHER").alias("family"),
        derive.transition_text(F.col("event_type"), F.lit("next")).alias("change_text"),
        derive.json_presence(F.col("props"), {"HAS_K": "$.k", "HAS_Z": "$.z"}).alias("props_summary"),
        "safe_text", "_source_dataset", "_record_hash", "recency_rank",
    )


register(
    "derived_columns",
    _derived,
    f"""SELECT event_id, value > 50 AS is_large,
    CAST(coalesce(CASE WHEN value > 10 THEN CAST(ts AS DATE) END, {o.TODAY}) - CAST(ts AS DATE) AS INTEGER) AS days_open,
    CASE WHEN event_type LIKE 's_gn%' THEN 'START' WHEN event_type LIKE '%c_' THEN 'INPUT' WHEN event_type LIKE 'e%' THEN 'FAULT' ELSE 'OTHER' END AS family,
    event_type || ' -> next' AS change_text,
    concat_ws(',', CASE WHEN json_extract(props, '$.k') IS NOT NULL THEN 'HAS_K' END, CASE WHEN json_extract(props, '$.z') IS NOT NULL THEN 'HAS_Z' END) AS props_summary,
    CASE event_type WHEN 'signup' THEN 'Joined' WHEN 'view' THEN 'Looked' WHEN 'click' THEN 'Chose' END AS safe_text,
    'events' AS _source_dataset, sha256('events|' || event_id) AS _record_hash,
    CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS INTEGER) AS recency_rank FROM events""",
)
register(
    "latest_event_value",
    lambda s, d: derive.latest_value(read(s, d, "events"), ["user_id"], "value", "ts", "event_id", "latest_value"),
    "SELECT user_id, arg_max_null(value, row(ts, event_id)) AS latest_value FROM events GROUP BY user_id",
)
register(
    "reference_enrichment",
    lambda s, d: derive.approved_projection(
        derive.enrich(
            read(s, d, "customer").select("c_custkey", "c_nationkey"), read(s, d, "nation"), {"c_nationkey": "n_nationkey"},
            {"nation": "n_name", "region_key": "n_regionkey"},
        ),
        ["c_custkey", "nation", "region_key"], ["c_name", "c_acctbal"],
    ),
    "SELECT c_custkey, n_name AS nation, n_regionkey AS region_key FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey",
)
_ROUTES = {"BIG": "o_totalprice < 400000", "KNOWN": "o_orderstatus != 'P'", "URGENT": "o_orderpriority != '1-URGENT'"}
_ACTIONS = {"BIG": "REJECT_FILE", "KNOWN": "QUARANTINE", "URGENT": "ALLOW_WITH_WARNING"}


def _routed(spark, sf_dir):
    rows = derive.routed(read(spark, sf_dir, "orders"), _ROUTES, _ACTIONS)
    return rows.withColumn("file", F.date_format("o_orderdate", "yyyy-MM-dd"))


_ROUTED_SQL = f"""(SELECT o_orderkey, {_failed_sql(_ROUTES)} AS failed_rule_ids, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS file,
    CASE WHEN o_totalprice >= 400000 THEN 'REJECT_FILE' WHEN o_orderstatus = 'P' THEN 'QUARANTINE'
    WHEN o_orderpriority = '1-URGENT' THEN 'ALLOW_WITH_WARNING' END AS rule_action FROM orders)"""
register("action_routing", lambda s, d: _routed(s, d).select("o_orderkey", "failed_rule_ids", "rule_action", "file"), f"SELECT * FROM {_ROUTED_SQL}")
register(
    "rejected_files",
    lambda s, d: derive.accepted_files(_routed(s, d).select("o_orderkey", "rule_action", "file"), "file").select("o_orderkey", "file"),
    f"SELECT o_orderkey, file FROM {_ROUTED_SQL} WHERE file NOT IN (SELECT file FROM {_ROUTED_SQL} WHERE rule_action = 'REJECT_FILE')",
)


@checked(
    """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date, dayname(d) AS day_of_week,
    CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(month(d) AS INTEGER) AS month, CAST(quarter(d) AS INTEGER) AS quarter,
    CAST(year(d) AS INTEGER) AS year, dayofweek(d) NOT IN (0, 6) AS is_business_day
    FROM (SELECT unnest(generate_series(least(a, b, c), greatest(x, y, z), INTERVAL 1 DAY)) AS d FROM
      (SELECT CAST(min(o_orderdate) AS DATE) a, CAST(max(o_orderdate) AS DATE) x FROM orders),
      (SELECT CAST(min(l_shipdate) AS DATE) b, CAST(max(l_shipdate) AS DATE) y FROM lineitem),
      (SELECT CAST(min(ts) AS DATE) c, CAST(max(ts) AS DATE) z FROM events))"""
)
def calendar_of_tables(spark, sf_dir):
    parts = [("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts")]
    bounds = None
    for table, column in parts:
        d = F.col(column).cast("date")
        one = read(spark, sf_dir, table).agg(F.min(d).alias("low"), F.max(d).alias("high"))
        bounds = one if bounds is None else bounds.unionByName(one)
    return calendar(bounds.agg(F.min("low").alias("first_day"), F.max("high").alias("last_day")))
