"""Dirty copies of frames for tests."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def inject_defects(
    frame: DataFrame, key: str, null_columns: Sequence[str] = (), orphan_column: str | None = None,
    outlier_column: str | None = None, null_rate: float = 0.02, outlier_rate: float = 0.01, orphan_rate: float = 0.005,
) -> DataFrame:
    """Make a dirty copy for tests: a fixed share of rows, chosen by key hash, gets each defect."""

    def chosen(salt: str, rate: float) -> Column:
        bucket = F.pmod(F.xxhash64(F.lit(salt), F.col(key)), F.lit(1_000_000))
        return bucket < int(rate * 1_000_000)

    changes = {c: F.when(~chosen(f"null:{c}", null_rate), F.col(c)) for c in null_columns}
    if outlier_column:
        changes[outlier_column] = F.when(
            chosen("outlier", outlier_rate), F.col(outlier_column) * 1000
        ).otherwise(F.col(outlier_column))
    if orphan_column:
        changes[orphan_column] = F.when(
            chosen("orphan", orphan_rate), F.lit(-1).cast("bigint")
        ).otherwise(F.col(orphan_column))
    return frame.withColumns(changes)
