"""Registered queries over the check tables, each with an independent DuckDB statement."""

from checks.catalogue import CHECKS  # noqa: F401
from checks import products, metrics, governance, operators, transport, landing, rules, streams  # noqa: F401
