"""Rules that judge one row: presence, type, range, time, condition and JSON content.

Each rule type is a function from its parameters (and the clock) to a boolean
column. ``_IF_PRESENT`` types accept null. Any number of them run together in
one projection or one aggregate.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from ledgerstone.operators.quality import failed_rules

Spec = Mapping[str, Any]
ROW_RULES: dict[str, Callable[[Spec, datetime], Column]] = {}

_OPERATORS: dict[str, Callable[[Column, Column], Column]] = {
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    ">=": lambda a, b: a >= b,
    ">": lambda a, b: a > b,
}


def row_rule(spec: Spec, as_of: datetime) -> Column:
    """The predicate of one declared rule."""
    try:
        build = ROW_RULES[spec["type"]]
    except KeyError:
        raise ValueError(f"unknown row rule type {spec.get('type')!r}") from None
    return build(spec, as_of)


def violations(frame: DataFrame, specs: Mapping[str, Spec], as_of: datetime) -> DataFrame:
    """Rows with the ids of the declared rules they break, all judged in one pass."""
    rules = {name: row_rule(spec, as_of) for name, spec in specs.items()}
    return frame.withColumn("failed_rule_ids", failed_rules(rules)).where(F.size("failed_rule_ids") > 0)


def _type(*names: str):
    def add(function):
        for name in names:
            ROW_RULES[name] = function
        return function

    return add


def _if_present(name: str):
    """Register ``name`` as the strict form and ``name``_IF_PRESENT as the tolerant one."""

    def add(function):
        ROW_RULES[name] = function
        ROW_RULES[f"{name}_IF_PRESENT"] = lambda s, t: F.col(s["column"]).isNull() | function(s, t)
        return function

    return add


def _c(spec: Spec, name: str = "column") -> Column:
    return F.col(spec[name])


def _number(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).try_cast("decimal(38,10)")


def _date(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).try_cast("date")


def _time(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).try_cast("timestamp")


def _all(tests) -> Column:
    return reduce(lambda a, b: a & b, tests)


def _any(tests) -> Column:
    return reduce(lambda a, b: a | b, tests)


def _between(value: Column, spec: Spec) -> Column:
    tests = []
    if "min" in spec:
        low = F.lit(spec["min"])
        tests.append(value > low if spec.get("min_exclusive") else value >= low)
    if "max" in spec:
        tests.append(value <= F.lit(spec["max"]))
    return _all(tests)


def _tolerant(test: Column, *needed: Column) -> Column:
    """True where an input is missing, else the test."""
    return _any([c.isNull() for c in needed]) | test


# --- presence and type -------------------------------------------------------------


@_if_present("NON_BLANK")
def _non_blank(s, t):
    return F.coalesce(F.length(F.trim(_c(s))) > 0, F.lit(False))


@_type("ALL_NOT_NULL")
def _all_present(s, t):
    return _all([F.col(c).isNotNull() for c in s["columns"]])


@_type("ANY_NOT_NULL")
def _some_present(s, t):
    return F.coalesce(*[F.col(c).cast("string") for c in s["columns"]]).isNotNull()


@_type("ANY_PRESENT")
def _some_filled(s, t):
    return _any([F.coalesce(F.trim(F.col(c).cast("string")) != "", F.lit(False)) for c in s["columns"]])


@_type("ALL_OR_NONE_NULL")
def _all_or_none(s, t):
    missing = F.size(F.filter(F.array(*[F.col(c).cast("string") for c in s["columns"]]), lambda x: x.isNull()))
    return missing.isin(0, len(s["columns"]))


@_type("ENVELOPE_FIELD_NOT_NULL")
def _envelope_field(s, t):
    return F.col(s["field"]).isNotNull()


@_if_present("PARSEABLE_DECIMAL")
def _decimal(s, t):
    return _number(_c(s)).isNotNull()


@_if_present("PARSEABLE_INTEGER")
def _integer(s, t):
    return _c(s).try_cast("bigint").isNotNull()


@_if_present("PARSEABLE_TIMESTAMP")
def _timestamp(s, t):
    return _time(_c(s)).isNotNull()


@_if_present("PARSEABLE_DATE")
def _parseable_date(s, t):
    return _date(_c(s)).isNotNull()


@_if_present("BOOLEAN")
def _boolean(s, t):
    return _c(s).try_cast("boolean").isNotNull()


@_type("MAX_LENGTH_IF_PRESENT")
def _max_length(s, t):
    return _tolerant(F.length(_c(s)) <= s["max"], _c(s))


@_type("REGEX_OR_BLANK_IF_PRESENT")
def _regex_or_blank(s, t):
    return _tolerant((F.trim(_c(s)) == "") | _c(s).rlike(s["pattern"]), _c(s))


def wildcard_regex(pattern: str) -> str:
    """``?`` is a letter, ``#`` a digit, anything else stands for itself."""
    parts = {"?": "[A-Za-z]", "#": "[0-9]"}
    return "^" + "".join(parts.get(ch, ch if ch.isalnum() else f"[{ch}]" if ch not in "^\\" else f"\\{ch}") for ch in pattern) + "$"


@_type("SOURCE_PATTERN_IF_PRESENT")
def _source_pattern(s, t):
    return _tolerant(_c(s).rlike(wildcard_regex(s["pattern"])), _c(s))


@_type("ACCEPTED_NUMERIC_VALUES")
def _accepted_numbers(s, t):
    return F.coalesce(_number(_c(s)).isin(*s["values"]), F.lit(False))


@_type("REFERENCE_SET_IF_PRESENT")
def _reference_set(s, t):
    return _tolerant(_c(s).isin(*s["values"]), _c(s))


@_type("DELIMITED_ACCEPTED_VALUES_IF_PRESENT")
def _delimited(s, t):
    parts = F.transform(F.split(_c(s), f"[{s.get('delimiter', ',')}]"), lambda x: F.trim(x))
    known = F.forall(parts, lambda x: x.isin(*s["values"]))
    for bound, fits in (("min_items", F.size(parts).__ge__), ("max_items", F.size(parts).__le__)):
        if bound in s:
            known = known & fits(s[bound])
    return _tolerant(known, _c(s))


# --- ranges, comparisons and formulas ---------------------------------------------


@_if_present("RANGE")
def _range(s, t):
    return F.coalesce(_between(_number(_c(s)), s), F.lit(False))


@_if_present("REGEX_NUMERIC_COMPONENT_RANGE")
def _component_range(s, t):
    part = F.regexp_extract(_c(s).cast("string"), s["pattern"], s.get("group", 1)).try_cast("bigint")
    return F.coalesce(_between(part, s), F.lit(False))


@_type("REGEX_AND_NUMERIC_COMPONENT_RANGE")
def _regex_and_range(s, t):
    return F.coalesce(_c(s).rlike(s["pattern"]), F.lit(False)) & _component_range(s, t)


def _compare(parse: Callable[[str], Column], s: Spec) -> Column:
    left, right = parse(s["left"]), parse(s["right"])
    return _tolerant(_OPERATORS[s["op"]](left, right), left, right)


@_type("COLUMN_COMPARISON")
def _columns(s, t):
    return _compare(F.col, s)


@_type("COLUMN_EQUALITY")
def _equality(s, t):
    return F.col(s["left"]).eqNullSafe(F.col(s["right"]))


@_type("NUMERIC_COLUMN_COMPARISON")
def _numbers(s, t):
    return _compare(_number, s)


@_type("DATE_COLUMN_COMPARISON")
def _dates(s, t):
    return _compare(_date, s)


@_type("TIMESTAMP_COLUMN_COMPARISON")
def _times(s, t):
    return _compare(_time, s)


@_type("TIMESTAMP_EQUALITY")
def _same_time(s, t):
    return _compare(_time, {**s, "op": "="})


@_type("NUMERIC_RATIO_RANGE", "NUMERIC_COLUMN_RATIO_RANGE")
def _ratio(s, t):
    top, bottom = _number(s["numerator"]), _number(s["denominator"])
    ratio = top.cast("double") / F.nullif(bottom, F.lit(0)).cast("double")
    return _tolerant(F.coalesce(_between(ratio, s), F.lit(False)), top, bottom)


@_type("NUMERIC_FORMULA_MATCH")
def _formula(s, t):
    target, wanted = _number(s["target"]).cast("double"), F.expr(s["formula"]).cast("double")
    return _tolerant(F.abs(target - wanted) <= s.get("tolerance", 0.01), target, wanted)


@_type("AMORTISATION_PAYMENT_MATCH")
def _amortisation(s, t):
    principal, target = (_number(s[k]).cast("double") for k in ("principal", "target"))
    rate = _number(s["annual_rate"]).cast("double") / (100 * 12)
    months = _number(s["months"]).cast("double")
    payment = F.try_divide(principal * rate, 1 - F.pow(1 + rate, -months))
    return _tolerant(F.abs(target - payment) <= payment * s["ratio"], target, payment)


@_type("PREFIX_MATCH")
def _prefix(s, t):
    head = F.left(F.col(s["source"]), F.lit(s["length"]))
    return _tolerant(F.col(s["target"]).startswith(head), F.col(s["target"]), head)


@_type("PREFIX_TO_VALUE_MAPPING")
def _prefix_value(s, t):
    wanted = F.lit(None).cast("string")
    for prefix, value in reversed(list(s["mapping"].items())):
        wanted = F.when(F.col(s["source"]).startswith(prefix), value).otherwise(wanted)
    return _tolerant(F.col(s["target"]) == wanted, wanted)


@_type("VALUE_PAIR_ACCEPTED")
def _pair(s, t):
    left, right = F.col(s["left"]), F.col(s["right"])
    return _any([(left == a) & (right == b) for a, b in s["pairs"]])


@_type("MASKED_SUFFIX_MATCH")
def _suffix(s, t):
    n = F.lit(s["length"])
    return _tolerant(F.right(_c(s, "masked"), n) == F.right(_c(s, "clear"), n), _c(s, "masked"), _c(s, "clear"))


# --- time ---------------------------------------------------------------------------


def _today(t: datetime) -> Column:
    return F.lit(t.date())


@_type("DATE_NOT_IN_FUTURE")
def _date_past(s, t):
    return _tolerant(_date(_c(s)) <= _today(t), _date(_c(s)))


@_type("TIMESTAMP_NOT_IN_FUTURE")
def _time_past(s, t):
    return _tolerant(_time(_c(s)) <= F.lit(t).cast("timestamp"), _time(_c(s)))


@_type("TIMESTAMP_NOT_BEFORE_DATE")
def _not_before(s, t):
    moment, day = _time(s["timestamp"]), _date(s["date"])
    return _tolerant(moment.cast("date") >= day, moment, day)


@_type("TIMESTAMP_OFFSET_RANGE")
def _offset(s, t):
    a, b = _time(s["start"]), _time(s["end"])
    return _tolerant(_between(F.unix_seconds(b) - F.unix_seconds(a), s), a, b)


@_type("TIMESTAMP_APPROXIMATE_OFFSET")
def _near_offset(s, t):
    a, b = _date(s["start"]), _date(s["end"])
    wanted = _number(s["count"]).cast("int") * s["days_each"]
    return _tolerant(F.abs(F.datediff(b, a) - wanted) <= s["tolerance"], a, b, wanted)


@_type("CONDITIONAL_TIMESTAMP_OFFSET_MATCH")
def _selected_offset(s, t):
    a, b = _time(s["start"]), _time(s["end"])
    days = F.lit(None).cast("int")
    for value, count in s["days"].items():
        days = F.when(F.col(s["selector"]) == value, count).otherwise(days)
    gap = F.unix_seconds(b) - F.unix_seconds(a) - days * 86_400
    return _tolerant(F.abs(gap) <= s.get("tolerance_seconds", 0), a, b, days)


@_type("DATE_ADD_DAYS_MATCH")
def _plus_days(s, t):
    a, b = _date(s["start"]), _date(s["target"])
    return _tolerant(F.date_add(a, s["days"]) == b, a, b)


@_type("DATE_ADD_MONTHS_MATCH")
def _plus_months(s, t):
    a, b, n = _date(s["start"]), _date(s["target"]), F.col(s["months"]).try_cast("int")
    return _tolerant(F.add_months(a, n) == b, a, b, n)


@_type("DATE_AFTER_TIMESTAMP_DATE")
def _after_day(s, t):
    day, moment = _date(s["date"]), _time(s["timestamp"])
    return _tolerant(day > moment.cast("date"), day, moment)


@_type("DATE_AGE_MAX")
def _age_limit(s, t):
    return _tolerant(_date(_c(s)) >= F.add_months(_today(t), -12 * s["years"]), _date(_c(s)))


@_type("DATE_OFFSET_RANGE")
def _days_from_now(s, t):
    return _tolerant(_between(F.datediff(_date(_c(s)), _today(t)), s), _date(_c(s)))


@_type("DATE_YEAR_OFFSET_RANGE")
def _years_between(s, t):
    a, b = _date(s["start"]), _date(s["end"])
    return _tolerant(_between(F.months_between(b, a) / 12, s), a, b)


@_type("DATE_RANGE_IF_PRESENT")
def _date_range(s, t):
    bounds = {k: F.lit(s[k]).cast("date") for k in ("min", "max") if k in s}
    return _tolerant(_between(_date(_c(s)), bounds), _date(_c(s)))


@_type("STATUS_DATE_CONSISTENCY")
def _status_dates(s, t):
    a, b, today, status = _date(s["start"]), _date(s["end"]), _today(t), F.col(s["status"])
    inside = (a <= today) & (b.isNull() | (b >= today))
    return (
        F.when(status.isin(*s["inside"]), F.coalesce(inside, F.lit(False)))
        .when(status.isin(*s["ended"]), F.coalesce(b < today, F.lit(False)))
        .otherwise(F.lit(True))
    )


# --- conditions -----------------------------------------------------------------------


def condition(when: Spec) -> Column:
    """A declared condition: equals, in, not_in, prefix, or an operator with a number."""
    value = F.col(when["column"])
    if "equals" in when:
        test = value == when["equals"]
    elif "in" in when:
        test = value.isin(*when["in"])
    elif "not_in" in when:
        test = ~value.isin(*when["not_in"])
    elif "prefix" in when:
        test = value.startswith(when["prefix"])
    elif "not_prefix" in when:
        test = ~value.startswith(when["not_prefix"])
    else:
        test = _OPERATORS[when["op"]](_number(value), F.lit(when["number"]))
    return F.coalesce(test, F.lit(False))


def _implies(s: Spec, then: Column) -> Column:
    return ~condition(s["when"]) | F.coalesce(then, F.lit(False))


def _targets(s: Spec) -> list[Column]:
    return [F.col(c) for c in s["targets"]]


@_type(
    "CONDITIONAL_NOT_NULL",
    "CONDITIONAL_NOT_NULL_FOR_VALUES",
    "CONDITIONAL_NOT_NULL_BY_PREFIX",
    "CONDITIONAL_NOT_NULL_BY_NUMERIC_THRESHOLD",
    "CONDITIONAL_ALL_NOT_NULL",
    "CONDITIONAL_ALL_NOT_NULL_FOR_VALUES",
)
def _then_present(s, t):
    return _implies(s, _all([c.isNotNull() for c in _targets(s)]))


@_type(
    "CONDITIONAL_NULL",
    "CONDITIONAL_NULL_FOR_VALUES",
    "CONDITIONAL_NULL_EXCEPT_VALUES",
    "CONDITIONAL_NULL_BY_NUMERIC_VALUE",
    "CONDITIONAL_ALL_NULL",
    "CONDITIONAL_ALL_NULL_FOR_VALUES",
    "CONDITIONAL_ALL_NULL_UNLESS_PREFIX",
)
def _then_null(s, t):
    return _implies(s, _all([c.isNull() for c in _targets(s)]))


@_type("CONDITIONAL_ANY_NOT_NULL")
def _then_some(s, t):
    return _implies(s, _any([c.isNotNull() for c in _targets(s)]))


@_type("CONDITIONAL_ACCEPTED_VALUES")
def _then_accepted(s, t):
    source, target = F.col(s["source"]), F.col(s["target"])
    wrong = [(source == k) & ~F.coalesce(target.isin(*v), F.lit(False)) for k, v in s["accepted"].items()]
    return ~F.coalesce(_any(wrong), F.lit(False))


@_type("CONDITIONAL_VALUE")
def _then_value(s, t):
    return _implies(s, F.col(s["target"]) == s["value"])


@_type("CONDITIONAL_VALUE_MAP")
def _then_mapped(s, t):
    wrong = [(F.col(s["source"]) == k) & ~F.col(s["target"]).eqNullSafe(F.lit(v)) for k, v in s["mapping"].items()]
    return ~F.coalesce(_any(wrong), F.lit(False))


@_type("CONDITIONAL_NUMERIC_MIN")
def _then_min(s, t):
    return _implies(s, _number(s["target"]) >= s["min"])


@_type("CONDITIONAL_NUMERIC_CONSISTENCY")
def _then_positive(s, t):
    return _implies(s, _tolerant(_number(s["target"]) > 0, F.col(s["target"])))


@_type("CONDITIONAL_NOT_BOTH_EQUAL")
def _not_both(s, t):
    return ~F.coalesce((F.col(s["left"]) == s["value"]) & (F.col(s["right"]) == s["value"]), F.lit(False))


# --- JSON -----------------------------------------------------------------------------


def _json(s: Spec, path: str | None = None) -> Column:
    return F.get_json_object(_c(s), path or s["path"])


def _present_json(s: Spec, test: Column) -> Column:
    return _tolerant(F.coalesce(test, F.lit(False)), _c(s))


@_type("VALID_JSON_IF_PRESENT")
def _valid_json(s, t):
    return _present_json(s, F.try_parse_json(_c(s)).isNotNull())


@_type("VALID_JSON_OBJECT_IF_PRESENT")
def _json_object(s, t):
    return _present_json(s, F.try_parse_json(_c(s)).isNotNull() & F.ltrim(_c(s)).startswith("{"))


@_type("VALID_JSON_ARRAY_IF_PRESENT")
def _json_array(s, t):
    return _present_json(s, F.json_array_length(_c(s)).isNotNull())


@_type("JSON_REQUIRED_KEYS_IF_PRESENT")
def _json_keys(s, t):
    absent = F.array_except(F.array(*[F.lit(k) for k in s["keys"]]), F.json_object_keys(_c(s)))
    return _present_json(s, F.size(absent) == 0)


@_type("JSON_ARRAY_SIZE_IF_PRESENT", "JSON_ARRAY_MIN_SIZE_IF_PRESENT")
def _json_size(s, t):
    return _present_json(s, _between(F.json_array_length(_c(s)), s))


def _items(s: Spec) -> Column:
    return F.from_json(_c(s), "array<map<string,string>>")


@_type("JSON_ARRAY_ITEMS_REQUIRED_KEYS_IF_PRESENT")
def _json_item_keys(s, t):
    return _present_json(s, F.forall(_items(s), lambda x: _all([F.map_contains_key(x, k) for k in s["keys"]])))


@_type("JSON_ARRAY_FIELD_ACCEPTED_VALUES_IF_PRESENT")
def _json_item_values(s, t):
    field = F.lit(s["field"])
    return _present_json(
        s, F.forall(_items(s), lambda x: F.coalesce(F.try_element_at(x, field).isin(*s["values"]), F.lit(False)))
    )


@_type("JSON_FIELD_ACCEPTED_VALUES_IF_PRESENT")
def _json_value(s, t):
    return _tolerant(_json(s).isin(*s["values"]), _c(s), _json(s))


@_type("JSON_DECIMAL_PATH_IF_PRESENT")
def _json_decimal(s, t):
    return _tolerant(_number(_json(s)).isNotNull(), _c(s), _json(s))


@_type("JSON_DATE_PATHS_IF_PRESENT")
def _json_dates(s, t):
    return _all([_tolerant(_date(_json(s, p)).isNotNull(), _c(s), _json(s, p)) for p in s["paths"]])


@_type("JSON_DATE_RANGE_DAYS")
def _json_days(s, t):
    a, b = _date(_json(s, s["start"])), _date(_json(s, s["end"]))
    return _tolerant(_between(F.datediff(b, a), s), a, b)


@_type("JSON_DATE_TO_COLUMN_COMPARISON")
def _json_date_column(s, t):
    a, b = _date(_json(s)), _date(s["right"])
    return _tolerant(_OPERATORS[s["op"]](a, b), a, b)


@_type("JSON_URI_APPROVED_DOMAIN_IF_PRESENT")
def _json_domain(s, t):
    host = F.try_parse_url(_json(s), F.lit("HOST"))
    return _tolerant(F.coalesce(host.isin(*s["domains"]), F.lit(False)), _c(s), _json(s))


# --- masks ----------------------------------------------------------------------------


@_type("SENSITIVE_VALUE_MASKED")
def _masked(s, t):
    return _tolerant(_c(s).rlike(s["mask"]), _c(s))


@_type("SENSITIVE_COLUMN_PATTERN")
def _mask_pattern(s, t):
    run = F.lit(f"[0-9]{{{s.get('max_digits', 4) + 1},}}")
    return _tolerant(_c(s).rlike(s["mask"]) & ~F.rlike(_c(s), run), _c(s))
