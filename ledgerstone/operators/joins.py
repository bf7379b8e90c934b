"""Join shapes that stay balanced when keys are missing or very frequent.

No side is ever broadcast by hint: Catalyst broadcasts one only when its own
size estimate is below ``spark.sql.autoBroadcastJoinThreshold``, and otherwise
shuffles both, splitting skewed partitions at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

_SPREAD = "_spread"
_FAN = 64


def lookup(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left", spread_by: Sequence[str] = ()
) -> DataFrame:
    """Left join on keys that may be null.

    Rows without a key match nothing, yet a plain shuffle sends all of them to
    one task. They are spread over many instead, by a hash of ``spread_by``
    (two other columns unless given; naming all would defeat column pruning).
    """
    keyless = F.lit(False)
    for name in on:
        keyless = keyless | F.col(name).isNull()
    others = list(spread_by) or [c for c in left.columns if c not in on][:2] or list(left.columns)
    spread = F.when(keyless, 1 + F.pmod(F.xxhash64(*others), F.lit(_FAN))).otherwise(F.lit(0))
    return (
        left.withColumn(_SPREAD, spread.cast("int"))
        .join(right.withColumn(_SPREAD, F.lit(0)), [*on, _SPREAD], how)
        .drop(_SPREAD)
    )


def salted_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", salts: int = 16,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Equi join in which one key may hold a large share of ``left``.

    Each left row gets one of ``salts`` numbers and each right row all of them,
    so a hot key is split over that many tasks. ``right`` must be the smaller
    side; ``how`` is inner, left, left_semi or left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salted_join cannot do a {how} join")
    others = list(spread_by) or [c for c in left.columns if c not in on][:3] or list(left.columns)
    salt = F.pmod(F.xxhash64(*others), F.lit(salts)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return (
        left.withColumn(_SPREAD, salt)
        .join(right.withColumn(_SPREAD, copies), [*on, _SPREAD], how)
        .drop(_SPREAD)
    )


def orphans(child: DataFrame, parent: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Child rows with a complete key that has no parent row.

    The child is computed and shuffled once, whatever it takes to build it. The parent is
    reduced to its distinct keys first; a key that many child rows hold fills a partition
    that Spark splits at run time.
    """
    names = [c for c, _ in pairs]
    complete = child
    for name in names:
        complete = complete.where(F.col(name).isNotNull())
    return complete.join(parent.select(*[F.col(p).alias(c) for c, p in pairs]).distinct(), names, "left_anti")


def valid_at(
    left: DataFrame, right: DataFrame, on: Sequence[str], moment: Column,
    valid_from: str = "effective_from", valid_to: str = "effective_to",
) -> DataFrame:
    """Left join to the version of ``right`` that is valid at ``moment`` (open end allowed)."""
    inside = (F.col(valid_from) <= moment) & (F.col(valid_to).isNull() | (F.col(valid_to) >= moment))
    return lookup(left, right.where(inside), on)
