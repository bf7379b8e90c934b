"""Order-aware operators that never gather one key's whole history in one task.

A plain ``lag`` or ``row_number`` window sends every row of a key to one task,
so a key that holds a third of all rows stalls the job. Here each history is
cut into time chunks. The window runs per (key, chunk), which spreads a hot key
over as many tasks as it has chunks; what crosses a chunk border is settled on a
few rows per (key, chunk). The chunk only decides where the work runs: results
are the same for every chunking that follows the order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

CHUNK = "_chunk"
_BEFORE_ALL = "0001-01-01"


def time_chunk(column: Column, unit: str = "month") -> Column:
    """Chunk of a time column; rows without a time sort first and share one chunk."""
    return F.coalesce(
        F.date_trunc(unit, column.cast("timestamp")), F.lit(_BEFORE_ALL).cast("timestamp")
    )


def _columns(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(item) if isinstance(item, str) else item for item in order]


def latest_by(frame: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row of each key with the greatest order; nulls come last."""
    return top_by(frame, keys, [c.desc_nulls_last() for c in _columns(order)], 1).drop("_rank")


def top_by(frame: DataFrame, keys: Sequence[str], order: Sequence[Column], count: int) -> DataFrame:
    """The first ``count`` rows of each key, with their ``_rank``.

    Spark keeps only ``count`` rows per key on the map side of this shape (a
    window group limit below the shuffle), so a hot key sends few rows on.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return frame.withColumn("_rank", rank).where(F.col("_rank") <= count)


def _looked(window: WindowSpec, previous: Sequence[str], following: Sequence[str]) -> dict[str, Column]:
    found = {}
    if previous:
        found["_previous"] = F.lag(F.struct(*previous)).over(window)
    if following:
        found["_following"] = F.lead(F.struct(*following)).over(window)
    return found


def neighbours_in_task(
    frame: DataFrame, keys: Sequence[str], order: Sequence[str], previous: Sequence[str] = (), following: Sequence[str] = ()
) -> DataFrame:
    """``with_neighbours`` for keys of few rows: a key is one task's, and a second call needs no shuffle or sort."""
    return frame.withColumns(_looked(Window.partitionBy(*keys).orderBy(*order), previous, following))


def with_neighbours(
    frame: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Column,
    previous: Sequence[str] = (),
    following: Sequence[str] = (),
) -> DataFrame:
    """Add structs ``_previous`` and ``_following`` of the named columns of the adjacent rows.

    A struct is null where there is no such row. Only the first and last row of
    a chunk need a neighbour from another chunk; those go through a second,
    small window per key (two rows per chunk at most). Both branches read the
    same shuffle, so the input is computed once.
    """
    keys, order = list(keys), list(order)
    inside = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    across = Window.partitionBy(*keys).orderBy(CHUNK, *order)

    def looked(window) -> dict[str, Column]:
        return _looked(window, previous, following)

    local = frame.withColumn(CHUNK, chunk).withColumns(
        looked(inside)
        | {
            "_first": F.lag(F.lit(True)).over(inside).isNull(),
            "_last": F.lead(F.lit(True)).over(inside).isNull(),
        }
    )
    edges = local.where(F.col("_first") | F.col("_last"))
    wide = {f"{name}_across": column for name, column in looked(across).items()}
    border = {"_previous": "_first", "_following": "_last"}
    solved = edges.withColumns(wide).withColumns(
        {
            name: F.when(F.col(border[name]), F.col(f"{name}_across")).otherwise(F.col(name))
            for name in looked(across)
        }
    )
    return (
        local.where(~F.col("_first") & ~F.col("_last"))
        .unionByName(solved.drop(*wide))
        .drop(CHUNK, "_first", "_last")
    )


def with_ordinal(
    frame: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, name: str
) -> DataFrame:
    """Add the 1-based position of each row in its key's order. Keys must not be null."""
    keys, order = list(keys), list(order)
    chunked = frame.withColumn(CHUNK, chunk)
    inside = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = chunked.groupBy(*keys, CHUNK).agg(F.count("*").alias("_rows")).select(
        *keys, CHUNK, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    return (
        chunked.withColumn(name, F.row_number().over(inside))
        .join(carried, [*keys, CHUNK], "left")
        .withColumn(name, (F.col(name) + F.col("_offset")).cast("int"))
        .drop(CHUNK, "_offset")
    )


def with_last_marked(
    frame: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, marked: Column, value: Column, name: str
) -> DataFrame:
    """Add the ``value`` of the last marked row at or before each row of its key, null where there is none.

    A window looks inside the chunk; rows before the chunk's first mark take the last
    mark of earlier chunks, from one summary row per (key, chunk). Keys must not be null.
    """
    keys, order = list(keys), list(order)
    chunked = frame.withColumns({CHUNK: chunk, "_mark": F.when(marked, value)})
    inside = Window.partitionBy(*keys, CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    last = F.max_by("_mark", F.when(F.col("_mark").isNotNull(), F.struct(*order)))
    carried = chunked.groupBy(*keys, CHUNK).agg(last.alias("_last_mark")).select(
        *keys, CHUNK, F.last("_last_mark", ignorenulls=True).over(before).alias("_carried")
    )
    return (
        chunked.withColumn("_near", F.last("_mark", ignorenulls=True).over(inside))
        .join(carried, [*keys, CHUNK], "left")
        .withColumn(name, F.coalesce("_near", "_carried"))
        .drop(CHUNK, "_mark", "_near", "_carried")
    )
