"""Cleaning and casts that turn bad input into null instead of failing the job.

Spark runs in ANSI mode, where a plain cast of ``'x'`` to a number raises and
takes the whole job down with it. Source columns are strings of unknown
quality, so every parse here is the ``try_`` form.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def trimmed(column: Column) -> Column:
    """Trim; a blank string becomes null."""
    value = F.trim(column.cast("string"))
    return F.when(value != "", value)


def upper_text(column: Column) -> Column:
    return F.upper(trimmed(column))


def lower_text(column: Column) -> Column:
    return F.lower(trimmed(column))


def safe_timestamp(column: Column) -> Column:
    return column.try_cast("timestamp")


def safe_date(column: Column) -> Column:
    return column.try_cast("date")


def safe_int(column: Column) -> Column:
    return column.try_cast("int")


def safe_long(column: Column) -> Column:
    return column.try_cast("bigint")


def safe_bool(column: Column) -> Column:
    return column.try_cast("boolean")


def safe_decimal(column: Column, precision: int = 18, scale: int = 2) -> Column:
    return column.try_cast(f"decimal({precision},{scale})")
