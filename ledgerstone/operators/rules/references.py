"""Rules between two data sets. Child keys that are null are skipped; parents are unique per key."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from ledgerstone.operators.joins import orphans
from ledgerstone.operators.rules.groups import _complete, found, keyed
from ledgerstone.operators.rules.rows import _OPERATORS, condition

Spec = Mapping[str, Any]
REFERENCE_RULES: dict[str, Callable[[DataFrame, DataFrame, Spec], DataFrame]] = {}


def _type(*names: str):
    def add(function):
        for name in names:
            REFERENCE_RULES[name] = function
        return function

    return add


@_type(
    "FOREIGN_KEY_IF_PRESENT",
    "REFERENCE_PAIR_CONSISTENT",
    "REFERENCE_TRIPLE_CONSISTENT",
    "REFERENCE_RELATIONSHIP_EXISTS_IF_PRESENT",
    "CHILD_FOREIGN_KEY_INTEGRITY",
)
def exists(child: DataFrame, parent: DataFrame, spec: Spec) -> DataFrame:
    """Child rows whose columns match no parent row; ``parent_where`` limits the parents."""
    rows = parent.where(spec["parent_where"]) if "parent_where" in spec else parent
    return found(orphans(child, rows, spec["pairs"]), spec, keyed(spec["key"]), F.lit(1))


def _met(child: DataFrame, parent: DataFrame, spec: Spec) -> DataFrame:
    """Child rows joined to their parent, whose columns get the prefix ``parent_``.

    A parent is one row, so nothing fans out; the only wide exchange feeds the
    join directly, where Spark splits a partition that one frequent key fills.
    """
    side = parent.select(
        *[F.col(p).alias(c) for c, p in spec["pairs"]], *[F.col(c).alias(f"parent_{c}") for c in spec["parent_columns"]]
    )
    return child.join(side, [c for c, _ in spec["pairs"]])


@_type("REFERENCE_CONDITION", "REFERENCE_CONDITION_FOR_VALUES")
def parent_condition(child: DataFrame, parent: DataFrame, spec: Spec) -> DataFrame:
    """Child rows whose existing parent breaks the condition; a missing parent is another rule's case."""
    rows = child.where(condition(spec["when"])) if "when" in spec else child
    held = F.coalesce(F.expr(spec["condition"]), F.lit(False))
    return found(_met(rows, parent, spec).where(~held), spec, keyed(spec["key"]), F.lit(1))


@_type("REFERENCE_TIMESTAMP_COMPARISON")
def parent_time(child: DataFrame, parent: DataFrame, spec: Spec) -> DataFrame:
    left, right = (F.col(c).try_cast("timestamp") for c in (spec["left"], f"parent_{spec['right']}"))
    both = _met(child, parent, {**spec, "parent_columns": [spec["right"]]})
    return found(both.where(~_OPERATORS[spec["op"]](left, right)), spec, keyed(spec["key"]), F.lit(1))


@_type("REFERENCE_COLUMN_EQUAL_IF_BOTH_PRESENT", "CHILD_REFERENCE_CUSTOMER_CONSISTENCY")
def parent_equal(child: DataFrame, parent: DataFrame, spec: Spec) -> DataFrame:
    both = _met(child, parent, {**spec, "parent_columns": [spec["right"]]})
    return found(
        both.where(F.col(spec["left"]) != F.col(f"parent_{spec['right']}")), spec, keyed(spec["key"]), F.lit(1)
    )


@_type("CHILD_ROW_COUNT_MATCH")
def child_count(parent: DataFrame, child: DataFrame, spec: Spec) -> DataFrame:
    """Parents whose declared count differs from the children found. Children are counted first."""
    counted = child.where(F.col(spec["child_key"]).isNotNull()).groupBy(F.col(spec["child_key"]).alias(spec["parent_key"])).agg(
        F.count("*").alias("_children")
    )
    both = parent.join(counted, spec["parent_key"], "left").withColumn("_children", F.coalesce("_children", F.lit(0)))
    wrong = both.where(F.col(spec["declared"]).try_cast("bigint") != F.col("_children"))
    return found(wrong, spec, keyed(spec["key"]), F.col("_children"))


@_type("PARENT_DECLARED_CHILD_COUNT_MATCH")
def declared_count(child: DataFrame, parent: DataFrame, spec: Spec) -> DataFrame:
    """The same mismatch named by the child side's keys: only parents that have children."""
    counted = child.where(F.col(spec["child_key"]).isNotNull()).groupBy(F.col(spec["child_key"]).alias(spec["parent_key"])).agg(
        F.count("*").alias("_children")
    )
    both = counted.join(parent, spec["parent_key"])
    wrong = both.where(F.col(spec["declared"]).try_cast("bigint") != F.col("_children"))
    return found(wrong, spec, keyed([spec["parent_key"]]), F.col("_children"))


@_type("PARENT_REFERENCE_USAGE")
def unused_parents(parent: DataFrame, child: DataFrame, spec: Spec) -> DataFrame:
    """Parents that no child names; a report, not a failure."""
    used = child.select(F.col(spec["child_key"]).alias(spec["parent_key"])).distinct()
    return found(parent.join(used, spec["parent_key"], "left_anti"), spec, keyed([spec["parent_key"]]), F.lit(0))


def _exploded(child: DataFrame, spec: Spec) -> DataFrame:
    items = F.from_json(spec["column"], "array<string>")
    return child.select(*spec["key"], *spec.get("keep", []), F.explode(items).alias("_item")).where(F.col("_item").isNotNull())


@_type("JSON_ARRAY_FOREIGN_KEY")
def json_items_exist(child: DataFrame, parent: DataFrame, spec: Spec) -> DataFrame:
    """Items of a JSON array column that match no parent."""
    return found(
        orphans(_exploded(child, spec), parent, [("_item", spec["parent_key"])]), spec, keyed([*spec["key"], "_item"]), F.lit(1)
    )


@_type("JSON_ARRAY_REFERENCE_PARENT_CONSISTENCY")
def json_items_agree(child: DataFrame, parent: DataFrame, spec: Spec) -> DataFrame:
    """Items whose parent belongs to another owner than the row that lists them."""
    rows = _exploded(child, {**spec, "keep": [spec["left"]]})
    both = _met(rows, parent, {**spec, "pairs": [("_item", spec["parent_key"])], "parent_columns": [spec["right"]]})
    wrong = both.where(F.col(spec["left"]) != F.col(f"parent_{spec['right']}"))
    return found(wrong, spec, keyed([*spec["key"], "_item"]), F.lit(1))


# --- many rules over one pair of data sets: one scan and one join a pair

#: Rule types that a joined row decides: what must hold of a child row and its parent.
_EXISTENCE = {
    "FOREIGN_KEY_IF_PRESENT", "REFERENCE_PAIR_CONSISTENT", "REFERENCE_TRIPLE_CONSISTENT", "REFERENCE_RELATIONSHIP_EXISTS_IF_PRESENT",
    "CHILD_FOREIGN_KEY_INTEGRITY", "JSON_ARRAY_FOREIGN_KEY",
}
_CONDITION = {"REFERENCE_CONDITION", "REFERENCE_CONDITION_FOR_VALUES"}
_TIME = {"REFERENCE_TIMESTAMP_COMPARISON"}
_EQUAL = {"REFERENCE_COLUMN_EQUAL_IF_BOTH_PRESENT", "CHILD_REFERENCE_CUSTOMER_CONSISTENCY", "JSON_ARRAY_REFERENCE_PARENT_CONSISTENCY"}
_ITEMS = {"JSON_ARRAY_FOREIGN_KEY", "JSON_ARRAY_REFERENCE_PARENT_CONSISTENCY"}
_COUNTS = {"CHILD_ROW_COUNT_MATCH", "PARENT_DECLARED_CHILD_COUNT_MATCH"}
_THERE, _FIRST, _CHILD, _FAILED = "_there", "_first", "_child", "_failed"


@dataclass(frozen=True)
class Reference:
    """One declared rule between two named data sets. ``child`` is the first argument of its single form."""

    type: str
    child: str
    parent: str
    spec: Spec


def _pairs(rule: Reference) -> tuple[tuple[str, str], ...]:
    return (("_item", rule.spec["parent_key"]),) if rule.type in _ITEMS else tuple(rule.spec["pairs"])


def _group(rule: Reference) -> tuple:
    """Rules of one group share a join: the same data sets, keys and, for lists, list column."""
    if rule.type in _COUNTS:
        declared, counted = (rule.child, rule.parent) if rule.type == "CHILD_ROW_COUNT_MATCH" else (rule.parent, rule.child)
        return ("counts", declared, counted, rule.spec["parent_key"], rule.spec["child_key"])
    return ("join", rule.child, rule.parent, _pairs(rule), rule.spec["column"] if rule.type in _ITEMS else None)


def _parent_columns(rule: Reference) -> list[str]:
    if rule.type in _CONDITION:
        return list(rule.spec["parent_columns"])
    return [rule.spec["right"]] if rule.type in _TIME | _EQUAL else []


def _broken(rule: Reference, number: int) -> Column:
    """Whether a joined row breaks the rule; rows with an incomplete key are not judged."""
    spec, there = rule.spec, F.coalesce(F.col(_THERE), F.lit(False))
    if rule.type in _EXISTENCE:
        whole = F.lit(True)
        for child, _ in _pairs(rule):
            whole = whole & F.col(child).isNotNull()
        return whole & ~F.coalesce(F.col(f"_met_{number}"), F.lit(False))
    if rule.type in _CONDITION:
        asked = condition(spec["when"]) if "when" in spec else F.lit(True)
        return there & F.coalesce(asked, F.lit(False)) & ~F.coalesce(F.expr(spec["condition"]), F.lit(False))
    if rule.type in _TIME:
        left, right = (F.col(c).try_cast("timestamp") for c in (spec["left"], f"parent_{spec['right']}"))
        return there & ~_OPERATORS[spec["op"]](left, right)
    return there & (F.col(spec["left"]) != F.col(f"parent_{spec['right']}"))


def _key_of(rule: Reference) -> Column:
    return keyed([*rule.spec["key"], "_item"] if rule.type in _ITEMS else rule.spec["key"])


def _failures(rules: Sequence[Reference], broken: Sequence[Column], key: Callable[[Reference], Column], observed: Column) -> Column:
    """Array of the rules that a row breaks."""
    rows = [
        F.when(b, F.struct(F.lit(r.type).alias("rule_type"), key(r).alias("record_key"), observed.cast("bigint").alias("observed"))) for r, b in zip(rules, broken)
    ]
    return F.array_compact(F.array(*rows))


def _judged_by_join(child: DataFrame, parent: DataFrame, rules: Sequence[Reference], riders: Sequence[tuple[DataFrame, Sequence[Reference]]] = ()) -> DataFrame:
    """The rules of one group, and of ``riders``: existence rules of the same child whose keys hold this group's whole key.

    Rows of the child and of the riders' parents are spread together by this group's key, and
    a window over a rider's keys tells whether a parent row stands among them: one shuffle of
    the child for all. Child rows with an incomplete key break nothing and stay out of it.
    """
    pairs = _pairs(rules[0])
    names = [c for c, _ in pairs]
    wanted = sorted({c for r in rules for c in _parent_columns(r)})
    met = _met_by(rules, 0)
    side = parent.select(*[F.col(p).alias(c) for c, p in pairs], *[F.col(c).alias(f"parent_{c}") for c in wanted], *[m.alias(n) for n, m in met.items()], F.lit(True).alias(_THERE))
    if not wanted:  # existence alone does not ask for one parent row a key
        side = side.groupBy(*names).agg(*[F.bool_or(n).alias(n) for n in met], F.lit(True).alias(_THERE))
    if riders:  # of a child row that several parent rows meet, the riders' rules judge the first
        side = side.withColumn(_FIRST, F.row_number().over(Window.partitionBy(*names).orderBy(*names)) == 1)
    if rules[0].type in _ITEMS:
        kept = sorted({c for r in rules for c in [*r.spec["key"], *([r.spec["left"]] if "left" in r.spec else [])]})
        items = F.explode(F.from_json(rules[0].spec["column"], "array<string>")).alias("_item")
        child = child.select(*kept, items)
    child, judged_here = _complete(child, names), list(rules)
    broken = [_broken(r, i) for i, r in enumerate(rules)]
    if riders:
        rows, asked = child.withColumn(_CHILD, F.lit(True)), {}
        for other, members in riders:
            keys, here = _pairs(members[0]), _met_by(members, len(judged_here))
            known = other.select(*[F.col(p).cast(child.schema[c].dataType).alias(c) for c, p in keys], *[m.alias(n) for n, m in here.items()])
            rows = rows.unionByName(_complete(known, names), allowMissingColumns=True)
            asked |= {n: F.bool_or(n).over(Window.partitionBy(*[c for c, _ in keys])) for n in here}
            broken += [F.coalesce(_FIRST, F.lit(True)) & _broken(r, i) for i, r in enumerate(members, len(judged_here))]
            judged_here += members
        child = rows.repartition(*names).withColumns(asked).where(_CHILD)
    joined = child.join(side, names, "left" if met or riders else "inner")
    return joined.select(_failures(judged_here, broken, _key_of, F.lit(1)).alias(_FAILED))


def _met_by(rules: Sequence[Reference], first: int) -> dict[str, Column]:
    return {f"_met_{i}": F.expr(r.spec.get("parent_where", "true")) for i, r in enumerate(rules, first) if r.type in _EXISTENCE}


def _judged_by_count(declared: DataFrame, counted: DataFrame, rules: Sequence[Reference]) -> DataFrame:
    spec = rules[0].spec
    parent_key, child_key = spec["parent_key"], spec["child_key"]
    children = counted.where(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias(parent_key)).agg(F.count("*").alias("_children"))
    both = declared.join(children, parent_key, "left")
    number = F.coalesce("_children", F.lit(0))
    wrong = [
        (F.col(r.spec["declared"]).try_cast("bigint") != number) & (F.lit(True) if r.type == "CHILD_ROW_COUNT_MATCH" else F.col("_children").isNotNull()) for r in rules
    ]
    key = lambda r: keyed(r.spec["key"] if r.type == "CHILD_ROW_COUNT_MATCH" else [parent_key])
    return both.select(_failures(rules, wrong, key, number).alias(_FAILED))


def _riding(tables: Mapping[str, DataFrame], groups: Mapping[tuple, Sequence[Reference]]) -> dict[tuple, list[tuple]]:
    """Groups that take others along in their shuffle: a group that reads parent columns, so that its key
    is a whole key of its parent, and groups of existence rules of the same child whose keys hold that key."""
    taken: dict[tuple, list[tuple]] = {}
    joins = {g: {c for c, _ in g[3]} for g in groups if g[0] == "join" and g[4] is None}
    bases = [g for g in joins if any(_parent_columns(r) for r in groups[g])]
    for g, names in joins.items():
        base = next((b for b in bases if b[1] == g[1] and joins[b] <= names), None)
        types = [(tables[g[1]].schema[c].dataType, tables[g[2]].schema[p].dataType) for c, p in g[3]]
        if g not in bases and base and all(a == b or b == DateType() and a in (TimestampType(), TimestampNTZType()) for a, b in types):
            taken.setdefault(base, []).append(g)
    return taken


def judged(tables: Mapping[str, DataFrame], rules: Sequence[Reference]) -> DataFrame:
    """(rule_type, record_key, observed) of every broken rule, from one join for each pair of data sets and keys;
    existence rules of a child whose keys hold that of another of its joins use the other's shuffle.

    Parents whose columns a rule reads are unique per key. Types that no joined row
    decides run in their single form.
    """
    groups: dict[tuple, list[Reference]] = {}
    parts = []
    for rule in rules:
        if rule.type in _EXISTENCE | _CONDITION | _TIME | _EQUAL | _COUNTS:
            groups.setdefault(_group(rule), []).append(rule)
        else:
            parts.append(REFERENCE_RULES[rule.type](tables[rule.child], tables[rule.parent], {"type": rule.type, **rule.spec}))
    ridden = _riding(tables, groups)
    carried = {rider for riders in ridden.values() for rider in riders}
    for group, members in groups.items():
        kind, first, second, *_ = group
        if group in carried:
            continue
        if kind == "counts":
            failed = _judged_by_count(tables[first], tables[second], members)
        else:
            failed = _judged_by_join(tables[first], tables[second], members, [(tables[r[2]], groups[r]) for r in ridden.get(group, ())])
        failed = failed.where(F.size(_FAILED) > 0)
        parts.append(failed.select(F.explode(_FAILED).alias("f")).select("f.*"))
    return reduce(DataFrame.unionByName, parts)
