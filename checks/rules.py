"""Every declared rule type on the check tables, with its DuckDB predicate beside it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks.catalogue import register
from checks.estate import AS_OF, cents, day, later, money, read, second, text
from ledgerstone.operators.quality import failed_rules
from ledgerstone.operators.rules import GROUP_RULES, Reference, judged, row_rule, violations
from ledgerstone.operators.rules import populations as pop
from ledgerstone.operators.rules.files import FILE_RULES

NOW = datetime(1999, 6, 1)
T, TS = "DATE '1999-06-01'", "TIMESTAMP '1999-06-01 00:00:00'"

# String columns of uneven quality, derived from orders.
_ROWS = f"""
SELECT o_orderkey AS k, o_orderstatus AS status, o_orderpriority AS prio, o_custkey % 60 AS terms,
  CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN ' ' WHEN '1-URGENT' THEN CAST(NULL AS STRING) ELSE o_orderpriority END AS a,
  CASE WHEN o_totalprice < 30000 THEN 'n/a' WHEN o_totalprice < 90000 THEN CAST(NULL AS STRING) ELSE {money('o_totalprice')} END AS n,
  {money('o_totalprice / 2')} AS h,
  CASE WHEN o_orderstatus = 'P' THEN 'many' ELSE {text('o_custkey')} END AS i,
  CASE WHEN o_totalprice > 450000 THEN 'soon' ELSE {day('o_orderdate')} END AS d,
  CASE WHEN o_orderstatus = 'F' THEN CAST(NULL AS STRING) ELSE {day(later('o_orderdate', 'o_custkey % 60 - 5'))} END AS e,
  {second(later('o_orderdate', 'o_custkey', 'MINUTE'))} AS t,
  CASE WHEN o_totalprice > 450000 THEN 'never' ELSE {second(later('o_orderdate', '2'))} END AS u,
  CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'false' ELSE 'maybe' END AS b,
  'AB-' || lpad({text('o_orderkey')}, 9, '0') AS code, '****' || {text('o_custkey % 10')} || {text('o_orderkey % 10')} AS masked,
  CASE WHEN o_orderstatus = 'F' THEN 'red,blue' WHEN o_orderstatus = 'O' THEN 'red' ELSE 'green, red' END AS tags,
  CASE WHEN o_totalprice < 9000 THEN '{{{{broken' WHEN o_orderstatus = 'P' THEN CAST(NULL AS STRING) ELSE
    '{{{{"kind":"' || o_orderstatus || '","amount":"' || CASE WHEN o_totalprice > 400000 THEN 'x' ELSE {money('o_totalprice')} END
    || '","from":"' || {day('o_orderdate')} || '","to":"' || {day(later('o_orderdate', 'o_custkey % 60'))}
    || '","url":"https://' || CASE WHEN o_custkey % 2 = 0 THEN 'www.example.com' ELSE 'other.example.org' END || '/p"}}}}' END AS j,
  CASE WHEN o_totalprice < 9000 THEN 'no array' WHEN o_orderstatus = 'P' THEN '[]' WHEN o_orderstatus = 'O' THEN '[{{{{"id":"1","kind":"F"}}}}]'
    ELSE '[{{{{"id":"1","kind":"F"}}}},{{{{"kind":"Z"}}}}]' END AS r
FROM {{orders}}""".replace("{{{{", "{{").replace("}}}}", "}}")


def _rows(spark, sf_dir):
    return spark.sql(_ROWS, orders=read(spark, sf_dir, "orders"))


def _n(c):
    return f"TRY_CAST({c} AS DECIMAL(38,10))"


def _d(c):
    return f"TRY_CAST({c} AS DATE)"


def _t(c):
    return f"TRY_CAST({c} AS TIMESTAMP)"


def _j(p):
    return f"CASE WHEN json_valid(j) THEN json_extract_string(j, '{p}') END"


_F = {"column": "status", "equals": "F"}
_FO = {"column": "status", "in": ["F", "O"]}
_BIG = {"column": "h", "op": ">", "number": 100000}
_PRE = {"column": "prio", "prefix": "1"}
_E_LIST = "CASE WHEN json_valid(r) AND json_type(r) = 'ARRAY' THEN json_transform(r, '[{\"id\":\"VARCHAR\",\"kind\":\"VARCHAR\"}]') END"

R1 = [
    ("NON_BLANK", {"column": "a"}, "a IS NOT NULL AND trim(a) <> ''"),
    ("NON_BLANK_IF_PRESENT", {"column": "a"}, "a IS NULL OR trim(a) <> ''"),
    ("ALL_NOT_NULL", {"columns": ["a", "n"]}, "a IS NOT NULL AND n IS NOT NULL"),
    ("ANY_NOT_NULL", {"columns": ["a", "n"]}, "a IS NOT NULL OR n IS NOT NULL"),
    ("ANY_PRESENT", {"columns": ["a", "e"]}, "coalesce(trim(a), '') <> '' OR e IS NOT NULL"),
    ("ALL_OR_NONE_NULL", {"columns": ["a", "n"]}, "(a IS NULL) = (n IS NULL)"),
    ("ENVELOPE_FIELD_NOT_NULL", {"field": "e"}, "e IS NOT NULL"),
    ("PARSEABLE_DECIMAL", {"column": "n"}, f"{_n('n')} IS NOT NULL"),
    ("PARSEABLE_DECIMAL_IF_PRESENT", {"column": "n"}, f"n IS NULL OR {_n('n')} IS NOT NULL"),
    ("PARSEABLE_INTEGER", {"column": "i"}, "TRY_CAST(i AS BIGINT) IS NOT NULL"),
    ("PARSEABLE_INTEGER_IF_PRESENT", {"column": "i"}, "i IS NULL OR TRY_CAST(i AS BIGINT) IS NOT NULL"),
    ("PARSEABLE_TIMESTAMP_IF_PRESENT", {"column": "u"}, f"u IS NULL OR {_t('u')} IS NOT NULL"),
    ("PARSEABLE_DATE_IF_PRESENT", {"column": "d"}, f"d IS NULL OR {_d('d')} IS NOT NULL"),
    ("BOOLEAN", {"column": "b"}, "TRY_CAST(b AS BOOLEAN) IS NOT NULL"),
    ("BOOLEAN_IF_PRESENT", {"column": "b"}, "b IS NULL OR TRY_CAST(b AS BOOLEAN) IS NOT NULL"),
    ("MAX_LENGTH_IF_PRESENT", {"column": "a", "max": 5}, "a IS NULL OR length(a) <= 5"),
    ("REGEX_OR_BLANK_IF_PRESENT", {"column": "a", "pattern": "^[25]-"}, "a IS NULL OR trim(a) = '' OR regexp_matches(a, '^[25]-')"),
    ("SOURCE_PATTERN_IF_PRESENT", {"column": "code", "pattern": "??-00000####"}, "regexp_matches(code, '^[A-Za-z]{2}-0{5}[0-9]{4}$')"),
    ("ACCEPTED_NUMERIC_VALUES", {"column": "i", "values": [1, 2, 7]}, "coalesce(TRY_CAST(i AS BIGINT) IN (1, 2, 7), false)"),
    ("REFERENCE_SET_IF_PRESENT", {"column": "a", "values": ["2-HIGH", "5-LOW"]}, "a IS NULL OR a IN ('2-HIGH', '5-LOW')"),
    (
        "DELIMITED_ACCEPTED_VALUES_IF_PRESENT",
        {"column": "tags", "values": ["red", "blue"], "min_items": 2},
        "len(string_split(tags, ',')) >= 2 AND len(list_filter(string_split(tags, ','), lambda x: trim(x) NOT IN ('red', 'blue'))) = 0",
    ),
]
_CODE = r"^AB-([0-9]+)$"
_ID = f"TRY_CAST(regexp_extract(code, '{_CODE}', 1) AS BIGINT)"
_PAY = "(TRY_CAST(h AS DOUBLE) * (terms / 1200.0::DOUBLE)) / nullif(1 - pow(1 + terms / 1200.0::DOUBLE, -24), 0)"
R2 = [
    ("RANGE", {"column": "n", "min": 100000, "max": 300000}, f"coalesce({_n('n')} BETWEEN 100000 AND 300000, false)"),
    ("RANGE_IF_PRESENT", {"column": "n", "min": 100000, "min_exclusive": True}, f"n IS NULL OR coalesce({_n('n')} > 100000, false)"),
    ("REGEX_NUMERIC_COMPONENT_RANGE", {"column": "code", "pattern": _CODE, "min": 10, "max": 9000}, f"{_ID} BETWEEN 10 AND 9000"),
    ("REGEX_NUMERIC_COMPONENT_RANGE_IF_PRESENT", {"column": "code", "pattern": _CODE, "max": 5000}, f"{_ID} <= 5000"),
    ("REGEX_AND_NUMERIC_COMPONENT_RANGE", {"column": "code", "pattern": "^AB-([0-9]+)[02468]$", "max": 700}, "regexp_matches(code, '[02468]$') AND coalesce(TRY_CAST(regexp_extract(code, '^AB-([0-9]+)[02468]$', 1) AS BIGINT) <= 700, false)"),
    ("COLUMN_COMPARISON", {"left": "a", "right": "prio", "op": "="}, "a IS NULL OR a = prio"),
    ("COLUMN_EQUALITY", {"left": "a", "right": "prio"}, "a IS NOT DISTINCT FROM prio"),
    ("NUMERIC_COLUMN_COMPARISON", {"left": "n", "right": "h", "op": ">="}, f"coalesce({_n('n')} >= {_n('h')}, true)"),
    ("DATE_COLUMN_COMPARISON", {"left": "d", "right": "e", "op": "<"}, f"coalesce({_d('d')} < {_d('e')}, true)"),
    ("TIMESTAMP_COLUMN_COMPARISON", {"left": "t", "right": "u", "op": "<="}, f"coalesce({_t('t')} <= {_t('u')}, true)"),
    ("TIMESTAMP_EQUALITY", {"left": "t", "right": "u"}, f"coalesce({_t('t')} = {_t('u')}, true)"),
    ("NUMERIC_RATIO_RANGE", {"numerator": "h", "denominator": "i", "min": 100, "max": 500}, f"{_n('i')} IS NULL OR coalesce({_n('h')}::DOUBLE / nullif({_n('i')}, 0)::DOUBLE BETWEEN 100 AND 500, false)"),
    ("NUMERIC_COLUMN_RATIO_RANGE", {"numerator": "n", "denominator": "h", "min": 1.5}, f"{_n('n')} IS NULL OR {_n('h')} IS NULL OR coalesce({_n('n')}::DOUBLE / nullif({_n('h')}, 0)::DOUBLE >= 1.5, false)"),
    ("NUMERIC_FORMULA_MATCH", {"target": "n", "formula": "try_cast(h as double) * 2", "tolerance": 0.005}, "TRY_CAST(n AS DOUBLE) IS NULL OR abs(TRY_CAST(n AS DOUBLE) - TRY_CAST(h AS DOUBLE) * 2) <= 0.005"),
    ("AMORTISATION_PAYMENT_MATCH", {"principal": "h", "target": "i", "annual_rate": "terms", "months": "m24", "ratio": 0.9}, f"coalesce(abs(TRY_CAST(i AS DOUBLE) - {_PAY}) <= {_PAY} * 0.9, true)"),
    ("PREFIX_MATCH", {"source": "prio", "target": "a", "length": 2}, "a IS NULL OR starts_with(a, left(prio, 2))"),
    ("PREFIX_TO_VALUE_MAPPING", {"source": "prio", "target": "status", "mapping": {"1-": "F", "2": "O"}}, "CASE WHEN prio LIKE '1-%' THEN status = 'F' WHEN prio LIKE '2%' THEN status = 'O' ELSE true END"),
    ("VALUE_PAIR_ACCEPTED", {"left": "status", "right": "prio", "pairs": [("F", "5-LOW"), ("O", "2-HIGH")]}, "(status, prio) IN (('F', '5-LOW'), ('O', '2-HIGH'))"),
    ("MASKED_SUFFIX_MATCH", {"masked": "masked", "clear": "code", "length": 2}, "right(masked, 2) = right(code, 2)"),
]
R3 = [
    ("DATE_NOT_IN_FUTURE", {"column": "d"}, f"coalesce({_d('d')} <= {T}, true)"),
    ("TIMESTAMP_NOT_IN_FUTURE", {"column": "t"}, f"{_t('t')} <= {TS}"),
    ("TIMESTAMP_NOT_BEFORE_DATE", {"timestamp": "t", "date": "e"}, f"coalesce(CAST({_t('t')} AS DATE) >= {_d('e')}, true)"),
    ("TIMESTAMP_OFFSET_RANGE", {"start": "t", "end": "u", "min": 0, "max": 90000}, f"coalesce(date_diff('second', {_t('t')}, {_t('u')}) BETWEEN 0 AND 90000, true)"),
    ("TIMESTAMP_APPROXIMATE_OFFSET", {"start": "d", "end": "e", "count": "terms", "days_each": 1, "tolerance": 4}, f"coalesce(abs({_d('e')} - {_d('d')} - terms) <= 4, true)"),
    ("CONDITIONAL_TIMESTAMP_OFFSET_MATCH", {"selector": "status", "start": "t", "end": "u", "days": {"F": 1, "O": 2}, "tolerance_seconds": 30000}, f"coalesce(abs(date_diff('second', {_t('t')}, {_t('u')}) - CASE status WHEN 'F' THEN 86400 WHEN 'O' THEN 172800 END) <= 30000, true)"),
    ("DATE_ADD_DAYS_MATCH", {"start": "d", "target": "e", "days": 10}, f"coalesce({_d('d')} + 10 = {_d('e')}, true)"),
    ("DATE_ADD_MONTHS_MATCH", {"start": "d", "target": "e", "months": "m1"}, f"coalesce(CAST({_d('d')} + INTERVAL 1 MONTH AS DATE) = {_d('e')}, true)"),
    ("DATE_AFTER_TIMESTAMP_DATE", {"date": "e", "timestamp": "t"}, f"coalesce({_d('e')} > CAST({_t('t')} AS DATE), true)"),
    ("DATE_AGE_MAX", {"column": "d", "years": 2}, f"coalesce({_d('d')} >= DATE '1997-06-01', true)"),
    ("DATE_OFFSET_RANGE", {"column": "d", "min": -300, "max": 100}, f"coalesce({_d('d')} - {T} BETWEEN -300 AND 100, true)"),
    ("DATE_YEAR_OFFSET_RANGE", {"start": "d", "end": "far", "min": 3, "max": 5}, f"coalesce(CASE WHEN {_d('d')} IS NULL THEN true WHEN DATE '2001-08-01' >= {_d('d')} THEN CAST({_d('d')} + INTERVAL 3 YEAR AS DATE) <= DATE '2001-08-01' AND CAST({_d('d')} + INTERVAL 5 YEAR AS DATE) >= DATE '2001-08-01' ELSE false END, true)"),
    ("DATE_RANGE_IF_PRESENT", {"column": "d", "min": "1996-01-01"}, f"coalesce({_d('d')} >= DATE '1996-01-01', true)"),
    ("STATUS_DATE_CONSISTENCY", {"status": "status", "start": "d", "end": "e", "inside": ["F"], "ended": ["O"]}, f"CASE status WHEN 'F' THEN coalesce({_d('d')} <= {T} AND ({_d('e')} IS NULL OR {_d('e')} >= {T}), false) WHEN 'O' THEN coalesce({_d('e')} < {T}, false) ELSE true END"),
]
R4 = [
    ("CONDITIONAL_NOT_NULL", {"when": _F, "targets": ["n"]}, "status <> 'F' OR n IS NOT NULL"),
    ("CONDITIONAL_NOT_NULL_FOR_VALUES", {"when": _FO, "targets": ["n"]}, "status NOT IN ('F', 'O') OR n IS NOT NULL"),
    ("CONDITIONAL_NOT_NULL_BY_PREFIX", {"when": _PRE, "targets": ["n"]}, "prio NOT LIKE '1%' OR n IS NOT NULL"),
    ("CONDITIONAL_NOT_NULL_BY_NUMERIC_THRESHOLD", {"when": _BIG, "targets": ["a"]}, f"NOT {_n('h')} > 100000 OR a IS NOT NULL"),
    ("CONDITIONAL_NULL", {"when": _F, "targets": ["e"]}, "status <> 'F' OR e IS NULL"),
    ("CONDITIONAL_NULL_FOR_VALUES", {"when": _FO, "targets": ["e"]}, "status NOT IN ('F', 'O') OR e IS NULL"),
    ("CONDITIONAL_NULL_EXCEPT_VALUES", {"when": {"column": "status", "not_in": ["O"]}, "targets": ["e"]}, "status = 'O' OR e IS NULL"),
    ("CONDITIONAL_NULL_BY_NUMERIC_VALUE", {"when": {"column": "i", "op": "=", "number": 7}, "targets": ["a"]}, "coalesce(TRY_CAST(i AS BIGINT) <> 7, true) OR a IS NULL"),
    ("CONDITIONAL_ALL_NULL", {"when": _F, "targets": ["e", "a"]}, "status <> 'F' OR (e IS NULL AND a IS NULL)"),
    ("CONDITIONAL_ALL_NULL_FOR_VALUES", {"when": _FO, "targets": ["e", "a"]}, "status = 'P' OR (e IS NULL AND a IS NULL)"),
    ("CONDITIONAL_ALL_NULL_UNLESS_PREFIX", {"when": {"column": "prio", "not_prefix": "2"}, "targets": ["a", "n"]}, "prio LIKE '2%' OR (a IS NULL AND n IS NULL)"),
    ("CONDITIONAL_ALL_NOT_NULL", {"when": _F, "targets": ["a", "n"]}, "status <> 'F' OR (a IS NOT NULL AND n IS NOT NULL)"),
    ("CONDITIONAL_ALL_NOT_NULL_FOR_VALUES", {"when": _FO, "targets": ["a", "n"]}, "status = 'P' OR (a IS NOT NULL AND n IS NOT NULL)"),
    ("CONDITIONAL_ANY_NOT_NULL", {"when": _FO, "targets": ["a", "n"]}, "status = 'P' OR a IS NOT NULL OR n IS NOT NULL"),
    ("CONDITIONAL_ACCEPTED_VALUES", {"source": "status", "target": "a", "accepted": {"F": ["2-HIGH"], "O": ["5-LOW", " "]}}, "CASE status WHEN 'F' THEN coalesce(a = '2-HIGH', false) WHEN 'O' THEN coalesce(a IN ('5-LOW', ' '), false) ELSE true END"),
    ("CONDITIONAL_VALUE", {"when": _F, "target": "b", "value": "true"}, "status <> 'F' OR b = 'true'"),
    ("CONDITIONAL_VALUE_MAP", {"source": "status", "target": "b", "mapping": {"F": "true", "P": "false"}}, "CASE status WHEN 'F' THEN b = 'true' WHEN 'P' THEN b = 'false' ELSE true END"),
    ("CONDITIONAL_NUMERIC_MIN", {"when": _F, "target": "n", "min": 200000}, f"status <> 'F' OR coalesce({_n('n')} >= 200000, false)"),
    ("CONDITIONAL_NUMERIC_CONSISTENCY", {"when": _F, "target": "n"}, f"status <> 'F' OR n IS NULL OR coalesce({_n('n')} > 0, false)"),
    ("CONDITIONAL_NOT_BOTH_EQUAL", {"left": "status", "right": "b", "value": "F"}, "NOT (status = 'F' AND b = 'F')"),
]
R5 = [
    ("VALID_JSON_IF_PRESENT", {"column": "j"}, "j IS NULL OR json_valid(j)"),
    ("VALID_JSON_OBJECT_IF_PRESENT", {"column": "r"}, "json_valid(r) AND left(r, 1) = '{'"),
    ("VALID_JSON_ARRAY_IF_PRESENT", {"column": "r"}, "json_valid(r) AND left(r, 1) = '['"),
    ("JSON_REQUIRED_KEYS_IF_PRESENT", {"column": "j", "keys": ["kind", "from"]}, "j IS NULL OR json_valid(j)"),
    ("JSON_ARRAY_SIZE_IF_PRESENT", {"column": "r", "min": 1, "max": 1}, "coalesce(CASE WHEN json_valid(r) THEN json_array_length(r) END = 1, false)"),
    ("JSON_ARRAY_MIN_SIZE_IF_PRESENT", {"column": "r", "min": 1}, "coalesce(CASE WHEN json_valid(r) THEN json_array_length(r) END >= 1, false)"),
    ("JSON_ARRAY_ITEMS_REQUIRED_KEYS_IF_PRESENT", {"column": "r", "keys": ["id"]}, f"coalesce(len(list_filter({_E_LIST}, lambda x: x.id IS NULL)) = 0, false)"),
    ("JSON_ARRAY_FIELD_ACCEPTED_VALUES_IF_PRESENT", {"column": "r", "field": "kind", "values": ["F"]}, f"coalesce(len(list_filter({_E_LIST}, lambda x: x.kind <> 'F')) = 0, false)"),
    ("JSON_FIELD_ACCEPTED_VALUES_IF_PRESENT", {"column": "j", "path": "$.kind", "values": ["F"]}, f"coalesce({_j('$.kind')} = 'F', true)"),
    ("JSON_DECIMAL_PATH_IF_PRESENT", {"column": "j", "path": "$.amount"}, f"coalesce({_j('$.amount')} <> 'x', true)"),
    ("JSON_DATE_PATHS_IF_PRESENT", {"column": "j", "paths": ["$.from", "$.amount"]}, f"{_j('$.amount')} IS NULL"),
    ("JSON_DATE_RANGE_DAYS", {"column": "j", "start": "$.from", "end": "$.to", "min": 5, "max": 30}, f"coalesce(CAST({_j('$.to')} AS DATE) - CAST({_j('$.from')} AS DATE) BETWEEN 5 AND 30, true)"),
    ("JSON_DATE_TO_COLUMN_COMPARISON", {"column": "j", "path": "$.to", "op": "<=", "right": "e"}, f"coalesce(CAST({_j('$.to')} AS DATE) <= {_d('e')}, true)"),
    ("JSON_URI_APPROVED_DOMAIN_IF_PRESENT", {"column": "j", "path": "$.url", "domains": ["www.example.com"]}, f"coalesce(starts_with({_j('$.url')}, 'https://www.example.com/'), true)"),
]
R10 = [
    ("SENSITIVE_VALUE_MASKED", {"column": "masked", "mask": r"^[*]{4}[0-9]{2}$"}, r"regexp_matches(masked, '^[*]{4}[0-9]{2}$')"),
    ("SENSITIVE_COLUMN_PATTERN", {"column": "code", "mask": "^AB"}, "NOT regexp_matches(code, '[0-9]{5}')"),
]


def _row_family(rules):
    def query(spark, sf_dir):
        rows = _rows(spark, sf_dir).withColumns({"m24": F.lit("24"), "m1": F.lit("1"), "far": F.lit("2001-08-01")})
        tests = {name: row_rule({"type": name, **spec}, NOW) for name, spec, _ in rules}
        broken = rows.select(F.explode(failed_rules(tests)).alias("rule_type"))
        names = spark.createDataFrame([(n,) for n in tests], "rule_type string")
        counted = broken.groupBy("rule_type").agg(F.count("*").alias("failed"))
        return names.join(counted, "rule_type", "left").select("rule_type", F.coalesce("failed", F.lit(0)).alias("failed"))

    return query


def _row_sql(rules):
    source = "(" + _ROWS.format(orders="orders") + ")"
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule_type, count(*) FILTER (WHERE NOT coalesce({sql}, false)) AS failed FROM r" for name, _, sql in rules
    ).join([f"WITH r AS {source} ", ""])


for _family, _rules in (("r1_presence", R1), ("r2_ranges", R2), ("r3_time", R3), ("r4_conditions", R4), ("r5_json", R5), ("r10_masks", R10)):
    register(f"rules_{_family}", _row_family(_rules), _row_sql(_rules))
register(
    "rules_row_violations",
    lambda s, d: violations(
        _rows(s, d), {n: {"type": n, **spec} for n, spec, _ in R1}, NOW
    ).select("k", "failed_rule_ids"),
    f"""SELECT * FROM (SELECT k, concat_ws(',', {', '.join(f"CASE WHEN NOT coalesce({q}, false) THEN '{n}' END" for n, _, q in R1)})
    AS failed_rule_ids FROM ({_ROWS.format(orders='orders')})) WHERE failed_rule_ids <> ''""",
)


# --- groups and sequences --------------------------------------------------------------


def _union(parts):
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


def _dup(rule, table, cols, where="true"):
    key = "concat_ws('|', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in cols) + ")"
    live = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    return f"SELECT '{rule}' AS rule_type, {key} AS record_key, count(*) AS observed FROM {table} WHERE {live} AND {where} GROUP BY {', '.join(cols)} HAVING count(*) > 1"


def _groups(spark, sf_dir):
    lines, orders, events = (read(spark, sf_dir, t) for t in ("lineitem", "orders", "events"))
    pair = ["l_orderkey", "l_linenumber"]
    flagged = {"column": "l_returnflag", "equals": "R"}
    g = GROUP_RULES
    envelopes = events.select("event_type", (F.col("event_id") % 8).alias("partition"), F.floor("value").alias("offset"))

    def go(name, frame, **spec):
        return g[name](frame, {"type": name, **spec})

    return _union(
        [
            go("UNIQUE_IF_PRESENT", orders, columns=["o_totalprice"]),
            go("UNIQUE_WITHIN_GROUP", lines, columns=pair),
            go("COMPOSITE_UNIQUE_IF_PRESENT", lines, columns=["l_orderkey", "l_partkey"]),
            go("COMPOSITE_UNIQUE_WHEN", lines, columns=pair, when=flagged),
            go("COMPOSITE_DUPLICATE_DETECTION", orders, columns=["o_custkey", "o_orderdate"]),
            go("CONDITIONAL_UNIQUE_PER_GROUP", lines, group=["l_orderkey"], when=flagged),
            go("UNIQUE_EVENT_ENVELOPE_POSITION", envelopes, columns=["event_type", "partition", "offset"]),
        ]
    )


register(
    "rules_r6_uniqueness",
    _groups,
    " UNION ALL ".join(
        [
            _dup("UNIQUE_IF_PRESENT", "orders", ["o_totalprice"]),
            _dup("UNIQUE_WITHIN_GROUP", "lineitem", ["l_orderkey", "l_linenumber"]),
            _dup("COMPOSITE_UNIQUE_IF_PRESENT", "lineitem", ["l_orderkey", "l_partkey"]),
            _dup("COMPOSITE_UNIQUE_WHEN", "lineitem", ["l_orderkey", "l_linenumber"], "l_returnflag = 'R'"),
            _dup("COMPOSITE_DUPLICATE_DETECTION", "orders", ["o_custkey", "o_orderdate"]),
            _dup("CONDITIONAL_UNIQUE_PER_GROUP", "lineitem", ["l_orderkey"], "l_returnflag = 'R'"),
            _dup("UNIQUE_EVENT_ENVELOPE_POSITION", "(SELECT event_type, event_id % 8 AS p, CAST(floor(value) AS BIGINT) AS o FROM events)", ["event_type", "p", "o"]),
        ]
    ),
)

_MOVES = ["signup->view", "view->click", "click->purchase", "view->view"]


def _sequences(spark, sf_dir):
    events = read(spark, sf_dir, "events").withColumns(
        {
            "late": (F.col("ts") - F.make_dt_interval(F.lit(0), F.lit(0), F.floor("value").cast("int"))),
            "ends": (F.col("ts") + F.make_dt_interval(F.lit(0), F.floor("value").cast("int"))),
            "old": F.when(F.col("value") > 9, "view").otherwise("click"),
        }
    )
    base = {"group": ["user_id"], "order": ["ts", "event_id"], "key": ["event_id"], "chunk": "day"}
    g = GROUP_RULES

    def go(name, **spec):
        return g[name](events, {"type": name, **base, **spec})

    other = events.where(F.col("value") > 5).select("user_id", "event_type", F.col("late").alias("at"))
    near = g["CROSS_EVENT_TRANSITION_ALIGNMENT"](
        events,
        {
            "type": "CROSS_EVENT_TRANSITION_ALIGNMENT", "key": ["event_id"], "group": "user_id", "value": "event_type", "time": "ts",
            "other_group": "user_id", "other_value": "event_type", "other_time": "at", "tolerance_seconds": 3600,
        },
        other,
    )
    gaps = g["IDENTIFIER_SEQUENCE_COMPLETE"](
        read(spark, sf_dir, "labels"), {"type": "IDENTIFIER_SEQUENCE_COMPLETE", "column": "doc_id", "pattern": "^([0-9]+)$", "block": 64}
    )
    return _union(
        [
            go("MONOTONIC_EVENT_TIME_PER_GROUP", time="late"),
            go("NON_OVERLAPPING_INTERVALS_PER_GROUP", start="ts", end="ends"),
            go("ORDERED_TRANSITION_GRAPH", value="event_type", allowed=_MOVES),
            go("PREVIOUS_NEXT_VALUE_CONTINUITY", old="old", new="event_type"),
            near,
            gaps,
        ]
    )


_EV = """(SELECT *, ts - INTERVAL 1 MINUTE * CAST(floor(value) AS INTEGER) AS late, ts + INTERVAL 1 HOUR * CAST(floor(value) AS INTEGER) AS ends,
    CASE WHEN value > 9 THEN 'view' ELSE 'click' END AS old FROM events)"""


def _step(rule, test):
    return f"""SELECT '{rule}' AS rule_type, CAST(event_id AS VARCHAR) AS record_key, CAST(1 AS BIGINT) AS observed FROM
    (SELECT *, lag(late) OVER w AS plate, lag(ends) OVER w AS pends, lag(event_type) OVER w AS ptype FROM {_EV}
     WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE {test}"""


register(
    "rules_r7_sequences",
    _sequences,
    " UNION ALL ".join(
        [
            _step("MONOTONIC_EVENT_TIME_PER_GROUP", "late < plate"),
            _step("NON_OVERLAPPING_INTERVALS_PER_GROUP", "ts < pends"),
            _step("ORDERED_TRANSITION_GRAPH", f"ptype || '->' || event_type NOT IN {tuple(_MOVES)}"),
            _step("PREVIOUS_NEXT_VALUE_CONTINUITY", "ptype IS NOT NULL AND old <> ptype"),
            f"""SELECT 'CROSS_EVENT_TRANSITION_ALIGNMENT', CAST(event_id AS VARCHAR), 1 FROM events e WHERE NOT EXISTS (
            SELECT 1 FROM {_EV} o WHERE o.value > 5 AND o.user_id = e.user_id AND o.event_type = e.event_type
            AND o.late BETWEEN e.ts - INTERVAL 1 HOUR AND e.ts + INTERVAL 1 HOUR)""",
            """SELECT 'IDENTIFIER_SEQUENCE_COMPLETE', CAST(doc_id + 1 AS VARCHAR) || '..' || CAST(next - 1 AS VARCHAR), next - doc_id - 1
            FROM (SELECT doc_id, lead(doc_id) OVER (ORDER BY doc_id) AS next FROM (SELECT DISTINCT doc_id FROM labels)) WHERE next > doc_id + 1""",
        ]
    ),
)


# --- references -----------------------------------------------------------------------


def _references(spark, sf_dir):
    lines, orders, customers, suppliers, events, parts = (
        read(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "supplier", "events", "part")
    )
    lines = lines.withColumn("line", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(F.col("l_extendedprice") * 100).cast("bigint")))
    listed = orders.select("o_orderkey", "o_custkey", F.to_json(F.array(F.col("o_custkey").cast("string"), (F.col("o_custkey") + 700).cast("string"))).alias("party_list"))
    tables = {
        "lines": lines, "orders": orders, "customers": customers, "suppliers": suppliers, "events": events, "parts": parts.select("p_partkey"), "listed": listed,
        "shipped": orders.select("o_orderkey", F.date_add(F.col("o_orderdate").cast("date"), 5).alias("day")),
        "taxed": lines.where(F.col("l_tax") > 0.01).select("l_orderkey", "l_partkey", "l_suppkey"),
        "people": customers.select(F.col("c_custkey").cast("string").alias("id"), "c_nationkey", "c_custkey"),
        "declared": orders.select("o_orderkey", (F.col("o_custkey") % 7).cast("string").alias("declared")),
    }
    return judged(tables, REFERENCES)


_OF_ORDER = {"key": ["line"], "pairs": [("l_orderkey", "o_orderkey")]}
_OF_CUSTOMER = {"key": ["o_orderkey"], "pairs": [("o_custkey", "c_custkey")]}
_OF_USER = {"key": ["event_id"], "pairs": [("user_id", "s_suppkey")]}
_COUNTS = {"parent_key": "o_orderkey", "child_key": "l_orderkey", "declared": "declared", "key": ["o_orderkey"]}
_PARTIES = {"key": ["o_orderkey"], "column": "party_list", "parent_key": "id"}
_TRIPLE = [(c, c) for c in ("l_orderkey", "l_partkey", "l_suppkey")]
REFERENCES = [
    Reference("FOREIGN_KEY_IF_PRESENT", "events", "suppliers", _OF_USER),
    Reference("REFERENCE_PAIR_CONSISTENT", "lines", "shipped", {"key": ["line"], "pairs": [("l_orderkey", "o_orderkey"), ("l_shipdate", "day")]}),
    Reference("REFERENCE_TRIPLE_CONSISTENT", "lines", "taxed", {"key": ["line"], "pairs": _TRIPLE}),
    Reference("REFERENCE_CONDITION", "lines", "orders", {**_OF_ORDER, "parent_columns": ["o_orderstatus"], "condition": "parent_o_orderstatus <> 'P'"}),
    Reference("REFERENCE_CONDITION_FOR_VALUES", "lines", "orders", {**_OF_ORDER, "when": {"column": "l_returnflag", "in": ["R"]}, "parent_columns": ["o_orderstatus"], "condition": "parent_o_orderstatus = 'F'"}),
    Reference("REFERENCE_RELATIONSHIP_EXISTS_IF_PRESENT", "orders", "customers", {**_OF_CUSTOMER, "parent_where": "c_acctbal > 0"}),
    Reference("REFERENCE_TIMESTAMP_COMPARISON", "lines", "orders", {**_OF_ORDER, "left": "l_shipdate", "op": ">", "right": "o_orderdate"}),
    Reference("REFERENCE_COLUMN_EQUAL_IF_BOTH_PRESENT", "lines", "orders", {**_OF_ORDER, "left": "l_linestatus", "right": "o_orderstatus"}),
    Reference("CHILD_ROW_COUNT_MATCH", "declared", "lines", _COUNTS),
    Reference("PARENT_DECLARED_CHILD_COUNT_MATCH", "lines", "declared", _COUNTS),
    Reference("CHILD_FOREIGN_KEY_INTEGRITY", "events", "suppliers", _OF_USER),
    Reference("CHILD_REFERENCE_CUSTOMER_CONSISTENCY", "orders", "customers", {**_OF_CUSTOMER, "left": "o_orderkey", "right": "c_custkey"}),
    Reference("PARENT_REFERENCE_USAGE", "parts", "lines", {"parent_key": "p_partkey", "child_key": "l_partkey"}),
    Reference("JSON_ARRAY_FOREIGN_KEY", "listed", "people", _PARTIES),
    Reference("JSON_ARRAY_REFERENCE_PARENT_CONSISTENCY", "listed", "people", {**_PARTIES, "left": "o_custkey", "right": "c_custkey"}),
]


_LINE = """(SELECT *, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT)) AS line FROM lineitem)"""
_LISTED = "(SELECT o_orderkey, o_custkey, unnest([o_custkey, o_custkey + 700]) AS item FROM orders)"
_COUNTED = "(SELECT o_orderkey, o_custkey % 7 AS declared, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS n FROM orders)"


def _ref(rule, key, source, observed="1"):
    return f"SELECT '{rule}' AS rule_type, CAST({key} AS VARCHAR) AS record_key, CAST({observed} AS BIGINT) AS observed FROM {source}"


_JOINED = f"{_LINE} l JOIN orders o ON l_orderkey = o_orderkey"
register(
    "rules_r8_references",
    _references,
    " UNION ALL ".join(
        [
            _ref("FOREIGN_KEY_IF_PRESENT", "event_id", "events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)"),
            _ref("REFERENCE_PAIR_CONSISTENT", "line", f"{_JOINED} WHERE CAST(l_shipdate AS DATE) <> CAST(o_orderdate AS DATE) + 5"),
            _ref("REFERENCE_TRIPLE_CONSISTENT", "line", f"{_LINE} a WHERE NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_tax > 0.01 AND b.l_orderkey = a.l_orderkey AND b.l_partkey = a.l_partkey AND b.l_suppkey = a.l_suppkey)"),
            _ref("REFERENCE_CONDITION", "line", f"{_JOINED} WHERE o_orderstatus = 'P'"),
            _ref("REFERENCE_CONDITION_FOR_VALUES", "line", f"{_JOINED} WHERE l_returnflag = 'R' AND o_orderstatus <> 'F'"),
            _ref("REFERENCE_RELATIONSHIP_EXISTS_IF_PRESENT", "o_orderkey", "orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)"),
            _ref("REFERENCE_TIMESTAMP_COMPARISON", "line", f"{_JOINED} WHERE l_shipdate <= o_orderdate"),
            _ref("REFERENCE_COLUMN_EQUAL_IF_BOTH_PRESENT", "line", f"{_JOINED} WHERE l_linestatus <> o_orderstatus"),
            _ref("CHILD_ROW_COUNT_MATCH", "o_orderkey", f"{_COUNTED} WHERE declared <> n", "n"),
            _ref("PARENT_DECLARED_CHILD_COUNT_MATCH", "o_orderkey", f"{_COUNTED} WHERE declared <> n AND n > 0", "n"),
            _ref("CHILD_FOREIGN_KEY_INTEGRITY", "event_id", "events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)"),
            _ref("CHILD_REFERENCE_CUSTOMER_CONSISTENCY", "o_orderkey", "orders WHERE o_orderkey <> o_custkey AND o_custkey IN (SELECT c_custkey FROM customer)"),
            _ref("PARENT_REFERENCE_USAGE", "p_partkey", "part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem)", "0"),
            _ref("JSON_ARRAY_FOREIGN_KEY", "o_orderkey || '|' || item", f"{_LISTED} WHERE item NOT IN (SELECT c_custkey FROM customer)"),
            _ref("JSON_ARRAY_REFERENCE_PARENT_CONSISTENCY", "o_orderkey || '|' || item", f"{_LISTED} WHERE item IN (SELECT c_custkey FROM customer) AND item <> o_custkey"),
        ]
    ),
)


# --- populations ------------------------------------------------------------------------

_POP = [
    ({"type": "POPULATION_RATIO_RANGE", "measure": "large", "condition": "o_totalprice > 400000", "min": 0.1, "max": 0.3}, "avg((o_totalprice > 400000)::INT)"),
    ({"type": "POPULATION_RATIO_MAX", "measure": "pending", "when": {"column": "o_orderstatus", "equals": "P"}, "max": 0.3}, "avg((o_orderstatus = 'P')::INT)"),
    ({"type": "NULL_RATIO_RANGE", "measure": "no date", "column": "o_orderdate", "max": 0.0}, "avg((o_orderdate IS NULL)::INT)"),
    ({"type": "CONDITIONAL_CATEGORY_RATIO_RANGE", "measure": "urgent and final", "when": {"column": "o_orderstatus", "equals": "F"}, "column": "o_orderpriority", "values": ["1-URGENT"], "min": 0.5}, "avg((o_orderpriority = '1-URGENT')::INT) FILTER (WHERE o_orderstatus = 'F')"),
    ({"type": "IDENTIFIER_RANGE_POPULATION_RATIO", "measure": "first ids", "column": "o_custkey", "pattern": "^([0-9]+)$", "from_id": 0, "to_id": 99, "max": 0.2}, "avg((o_custkey BETWEEN 0 AND 99)::INT)"),
    ({"type": "RECORD_COUNT_EXACT", "measure": "rows", "min": 15000, "max": 15000}, "count(*)"),
    ({"type": "RECORD_COUNT_EXPECTATION", "measure": "expected rows", "min": 100}, "count(*)"),
]
_POP_EVENTS = [
    ({"type": "TIMESTAMP_HOUR_POPULATION_RATIO", "measure": "office hours", "column": "ts", "from_hour": 9, "to_hour": 17, "min": 0.5}, "avg((hour(ts) BETWEEN 9 AND 17)::INT)"),
    ({"type": "TIMESTAMP_WEEKDAY_POPULATION_RATIO", "measure": "weekend", "column": "ts", "days": [1, 7], "max": 0.5}, "avg((dayofweek(ts) IN (0, 6))::INT)"),
]


def _populations(spark, sf_dir):
    orders, events = read(spark, sf_dir, "orders"), read(spark, sf_dir, "events")
    shares = pop.categories(orders, "o_orderstatus", {"F": 0.33, "O": 0.5, "X": 0.01}, 0.02)
    held = pop.concentration(events, "user_id").withColumn("passed", F.lit(None).cast("boolean"))
    return _union([pop.ratios(orders, [s for s, _ in _POP]), pop.ratios(events, [s for s, _ in _POP_EVENTS]), shares, held])


def _pop_sql(table, rules):
    parts = []
    for s, sql in rules:
        value = f"CAST(round({sql}, 6) AS DOUBLE)"
        good = " AND ".join([f"{value} >= {s['min']}" if "min" in s else "true", f"{value} <= {s['max']}" if "max" in s else "true"])
        parts.append(f"SELECT '{s['type']}' AS rule_type, '{s['measure']}' AS measure, {value} AS actual, {good} AS passed FROM {table}")
    return parts


register(
    "rules_r9_populations",
    _populations,
    " UNION ALL ".join(
        _pop_sql("orders", _POP)
        + _pop_sql("events", _POP_EVENTS)
        + [
            """SELECT 'CATEGORICAL_DISTRIBUTION_TOLERANCE', c, round(coalesce(n, 0) / (SELECT count(*) FROM orders), 6) AS a, abs(round(coalesce(n, 0) / (SELECT count(*) FROM orders), 6) - coalesce(w, 0)) <= 0.02
            FROM (SELECT coalesce(o_orderstatus, k) AS c, n, w FROM (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY ALL)
            FULL JOIN (VALUES ('F', 0.33), ('O', 0.5), ('X', 0.01)) t(k, w) ON k = o_orderstatus)""",
            """SELECT 'CONCENTRATION_DISTRIBUTION_MONITORING', 'user_id', round(sum(n) FILTER (WHERE rk <= ceil(g * 0.1)) / sum(n), 6), NULL FROM (
            SELECT count(*) AS n, row_number() OVER (ORDER BY count(*) DESC) AS rk, (SELECT count(DISTINCT user_id) FROM events) AS g FROM events GROUP BY user_id)""",
        ]
    ),
)
register(
    "rules_r9_moments",
    lambda s, d: pop.moments(read(s, d, "orders"), "o_totalprice").unionByName(pop.moments(read(s, d, "events"), "value", "event_type", True)),
    """SELECT 'NUMERIC_DISTRIBUTION_MONITORING' AS rule_type, 'o_totalprice' AS measure, round(avg(o_totalprice), 6) AS mean, round(stddev_samp(o_totalprice), 6) AS deviation FROM orders
    UNION ALL SELECT 'CONDITIONAL_LOGNORMAL_DISTRIBUTION_MONITORING', event_type, round(avg(ln(value)), 6), round(stddev_samp(ln(value)), 6) FROM events WHERE value > 0 GROUP BY event_type""",
)


# --- files and schemas --------------------------------------------------------------------


def _file_rules(spark, sf_dir):
    """Web pages stand for delivered files: path, size, age and content hash."""
    files = read(spark, sf_dir, "pages").select(
        F.col("url").alias("path"), F.length("html").alias("size"), F.sha2("html", 256).alias("sha256"),
        (F.lit(AS_OF).cast("timestamp") - F.make_dt_interval(F.lit(0), (F.col("page_id") % 100).cast("int"))).alias("modified_at"),
    )
    specs = [
        {"type": "FILE_SIZE_MIN", "min": 1500},
        {"type": "FILE_MODIFICATION_AGE", "max_hours": 48},
        {"type": "DUPLICATE_FILE_HASH"},
    ]
    return _union([FILE_RULES[s["type"]](files, s, AS_OF) for s in specs])


register(
    "rules_r10_files",
    _file_rules,
    """SELECT 'FILE_SIZE_MIN' AS rule_type, url AS record_key FROM pages WHERE length(html) < 1500
    UNION ALL SELECT 'FILE_MODIFICATION_AGE', url FROM pages WHERE page_id % 100 > 48
    UNION ALL SELECT 'DUPLICATE_FILE_HASH', url FROM (SELECT url, min(url) OVER (PARTITION BY sha256(html)) AS f FROM pages) WHERE url <> f""",
)
