"""Storing products: clustered layout, versioned full recompute, reading the latest version."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerstone.plans.silver import ENTITIES
from ledgerstone.plans.warehouse import Warehouse

VERSION = "_version"


def clustered(frame: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Order rows by ``keys`` across and within files, so readers skip files by their statistics.

    The range also runs over a hash of the row, which lets one frequent key
    fill several files instead of one.
    """
    spread = F.xxhash64(*frame.columns)
    ranges = [*[F.col(k) for k in keys], spread]
    ranged = frame.repartitionByRange(partitions, *ranges) if partitions else frame.repartitionByRange(*ranges)
    return ranged.sortWithinPartitions(*keys)


def materialise(frame: DataFrame, root: str, name: str, version: int, keys: Sequence[str]) -> None:
    """Write a full recompute beside the earlier versions, then commit it.

    The commit row is written last, so readers see the old version until the new
    one is whole, and a repeated attempt overwrites its own version only.
    """
    clustered(frame, keys).write.mode("overwrite").parquet(f"{root}/{name}/data/{VERSION}={version}")
    spark = frame.sparkSession
    spark.range(1).select(F.lit(name).alias("name")).write.mode("overwrite").parquet(
        f"{root}/{name}/commit/{VERSION}={version}"
    )


def latest(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The newest committed version. The commit list is metadata: one row per version."""
    newest = spark.read.parquet(f"{root}/{name}/commit").agg(F.max(VERSION).alias("v")).first()["v"]
    return spark.read.parquet(f"{root}/{name}/data/{VERSION}={newest}")


def refresh(w: Warehouse, root: str, version: int, products: Sequence[str], keys: dict[str, Sequence[str]]) -> None:
    """Recompute and store products one after another; later ones read the stored earlier ones."""
    for name in products:
        frame = w.gold(name)
        materialise(frame, root, name, version, keys[name])
        w.keep("gold", name, latest(frame.sparkSession, root, name))


def temporary_views(w: Warehouse, names: Sequence[str], prefix: str = "") -> None:
    """Register products or current entities as unpublished session views."""
    for name in names:
        frame = w.silver(name) if name in ENTITIES else w.gold(name)
        frame.createOrReplaceTempView(prefix + name)


def stored_reader(spark: SparkSession, root: str, names: Sequence[str]) -> Callable[[str], DataFrame | None]:
    """A ``stored`` function for ``Warehouse`` that reads the listed products."""
    known = set(names)
    return lambda name: latest(spark, root, name) if name in known else None
