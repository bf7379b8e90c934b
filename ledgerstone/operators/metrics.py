"""Metric views: named dimensions and measures compiled to join, group and aggregate."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ledgerstone.operators.joins import lookup


@dataclass(frozen=True)
class MetricJoin:
    """A dimension table joined on equal columns, reduced by ``where`` first.

    ``on`` pairs a source expression with a column of the joined table, and
    ``filled`` stands in for a missing value on both sides.
    """

    alias: str
    table: str
    on: tuple[tuple[str, str], ...]
    where: str = ""
    filled: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class MetricView:
    """Expressions name columns of the source, or ``alias.column`` of a join."""

    name: str
    source: str
    dimensions: Mapping[str, str]
    measures: Mapping[str, str]
    joins: tuple[MetricJoin, ...] = ()
    audience: str = "banker"
    owner: str = ""

    def limited_to(
        self, name: str, audience: str, owner: str, dimensions: Sequence[str], measures: Sequence[str]
    ) -> MetricView:
        """The same view for a narrower audience: listed fields only, rows of ``owner`` only."""
        return replace(
            self,
            name=name,
            audience=audience,
            owner=owner,
            dimensions={d: self.dimensions[d] for d in dimensions},
            measures={m: self.measures[m] for m in measures},
        )


def _flat(expression: str, aliases: Sequence[str]) -> str:
    for alias in aliases:
        expression = re.sub(rf"\b{alias}\.", f"{alias}__", expression)
    return expression


def metric_query(
    view: MetricView,
    tables: Callable[[str], DataFrame],
    dimensions: Sequence[str],
    measures: Sequence[str],
    as_of: datetime,
    where: Column | None = None,
    principal: str | None = None,
) -> DataFrame:
    """Group the view by ``dimensions`` and compute ``measures`` (none: the distinct groups).

    Only joins that a requested expression mentions are made. Views with an
    owner column show a principal its own rows only, and are refused without one.
    """
    unknown = [d for d in dimensions if d not in view.dimensions] + [
        m for m in measures if m not in view.measures
    ]
    if unknown:
        raise KeyError(f"{view.name} has no field {', '.join(unknown)}")
    aliases = [j.alias for j in view.joins]
    today = f"DATE'{as_of:%Y-%m-%d}'"
    wanted = {d: view.dimensions[d] for d in dimensions} | {m: view.measures[m] for m in measures}
    wanted = {name: expression.replace("{today}", today) for name, expression in wanted.items()}

    if view.owner and principal is None:
        raise ValueError(f"{view.name} shows a principal its own rows only; name the principal")
    frame = tables(view.source)
    if view.owner:
        frame = frame.where(F.col(view.owner) == principal)
    for join in view.joins:
        if not any(re.search(rf"\b{join.alias}\.", e) for e in wanted.values()):
            continue
        right = tables(join.table)
        if join.where:
            right = right.where(join.where.replace("{today}", today))
        keys = [f"_{join.alias}_{i}" for i in range(len(join.on))]

        def filled(value: Column, name: str) -> Column:
            return F.coalesce(value, F.lit(join.filled[name])) if name in join.filled else value

        right = right.select(
            *[filled(F.col(r), r).alias(k) for k, (_, r) in zip(keys, join.on)],
            *[F.col(c).alias(f"{join.alias}__{c}") for c in right.columns],
        )
        left = frame.withColumns({k: filled(F.expr(source), r) for k, (source, r) in zip(keys, join.on)})
        frame = lookup(left, right, keys)
    if where is not None:
        frame = frame.where(where)
    groups = [F.expr(_flat(wanted[d], aliases)).alias(d) for d in dimensions]
    if not measures:
        return frame.select(*groups).distinct()
    return frame.groupBy(*groups).agg(*[F.expr(_flat(wanted[m], aliases)).alias(m) for m in measures])
