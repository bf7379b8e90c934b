"""Every registered query with its DuckDB statement."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, TimestampType

from ledgerstone.session import tune


@dataclass(frozen=True)
class Check:
    query: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


CHECKS: dict[str, Check] = {}


def comparable(frame: DataFrame) -> DataFrame:
    """Zone-free timestamps and joined arrays, which both engines print alike."""
    out = []
    for f in frame.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, TimestampType):
            c = c.cast("timestamp_ntz").alias(f.name)
        elif isinstance(f.dataType, ArrayType):
            c = F.array_join(c, ",").alias(f.name)
        out.append(c)
    return frame.select(*out)


def register(name: str, query: Callable[[SparkSession, str], DataFrame], oracle: str | None = None) -> None:
    if name in CHECKS:
        raise ValueError(f"query {name} is registered twice")
    CHECKS[name] = Check(lambda spark, sf_dir: comparable(query(tune(spark), sf_dir)), oracle)


def checked(oracle: str | None = None):
    """Register the decorated function under its name."""

    def add(function):
        register(function.__name__, function, oracle)
        return function

    return add
