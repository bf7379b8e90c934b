"""Change logs, current snapshots and type 2 history."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ledgerstone.operators.ordered import latest_by, neighbours_in_task, time_chunk, with_neighbours

# Columns that describe a load, not the entity. A change in them
# alone opens no new version.
AUDIT_COLUMNS = ("pipeline_run_id", "source_table", "processed_at", "masking_status")

START, END = "__START_AT", "__END_AT"
OPERATION, SEQUENCE = "_operation", "_sequence_ts"
TIE_BREAKS = ("_source_lsn", "_kafka_offset")

# Rows of one bucket of key hashes that one task takes without cutting them into chunks.
BUSY_ROWS = 250_000
_BUCKETS = 1 << 16


def with_sequence(frame: DataFrame) -> DataFrame:
    """Add the change order: the first known of commit, capture, ingestion and feed time."""
    clocks = [
        name
        for name in ("_commit_ts", "_captured_at", "_ingested_at", "_commit_timestamp")
        if name in frame.columns
    ]
    return frame.withColumn(SEQUENCE, F.coalesce(*clocks).cast("timestamp"))


def current_snapshot(
    frame: DataFrame,
    keys: Sequence[str],
    required: Sequence[str] = (),
    order: Sequence[str] = ("_source_lsn", "_commit_ts", "_kafka_offset", "_ingested_at"),
) -> DataFrame:
    """Current source state: complete rows only, the latest per key, deleted keys gone.

    The required-field filter comes first, so a newer incomplete row gives way
    to the older complete one.
    """
    complete = frame
    for name in required:
        complete = complete.where(F.col(f"`{name}`").isNotNull())
    return latest_by(complete, keys, order).where(F.col(OPERATION) != "DELETE")


def _fingerprint(columns: Sequence[str], deleted: Column) -> Column:
    state = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return F.sha2(F.when(deleted, F.lit("DELETE")).otherwise(state), 256)


def state_mark(columns: Sequence[str]) -> Column:
    """128 bits that stand for the values of the columns, so neighbours carry two numbers and not the whole state.

    Hashes pass over nulls, so which columns are null is hashed too.
    """
    nulls = F.concat(F.lit(""), *[F.when(F.col(c).isNull(), "0").otherwise("1") for c in columns])
    return F.struct(*[F.xxhash64(F.lit(seed), nulls, *columns).alias(f"h{seed}") for seed in (1, 2)])


def busy_buckets(log: DataFrame, keys: Sequence[str], rows: int) -> list[int]:
    """Buckets of key hashes with more than ``rows`` rows, counted with a combine on the map side."""
    counted = log.groupBy(_bucket(keys).alias("bucket")).count().where(F.col("count") > rows)
    return counted.agg(F.collect_list("bucket")).first()[0]


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(_BUCKETS))


def scd2(
    log: DataFrame,
    keys: Sequence[str],
    sequence: str = SEQUENCE,
    tie_breaks: Sequence[str] = TIE_BREAKS,
    untracked: Sequence[str] = AUDIT_COLUMNS,
    deleted: Column | None = None,
    dropped: Sequence[str] = (OPERATION,),
    chunk_unit: str = "month",
    counted: DataFrame | None = None,
    busy_rows: int = BUSY_ROWS,
) -> DataFrame:
    """Type 2 history of a change log, independent of row order and batch split.

    Equal neighbouring states form one version. The version takes its untracked
    columns from its last row, opens at its first row's sequence and closes when
    the next version (or a delete) begins. Deletes only close versions.

    Keys are first counted by hash bucket, in ``counted`` if given (any frame that holds
    at least the keys of the log). A key of a bucket with few rows gathers in one task: one
    shuffle and one sort serve both passes. Only keys of buckets with more than
    ``busy_rows`` rows are cut into time chunks. Both ways give the same versions where the
    order tells the rows of a key apart; repeated rows keep their place only in one task.
    """
    keys = list(keys)
    deleted = F.col(OPERATION) == "DELETE" if deleted is None else deleted
    order = [sequence, *[c for c in tie_breaks if c in log.columns]]
    hidden = {sequence, *order, *dropped}
    state = [c for c in log.columns if c not in hidden and c not in keys and c not in untracked]
    payload = [c for c in log.columns if c not in hidden]
    chunk = time_chunk(F.col(sequence), chunk_unit)

    def versions(rows: DataFrame, beside: Callable[..., DataFrame]) -> DataFrame:
        return _versions(rows, keys, order, state, deleted, beside).select(*payload, START, END)

    def in_task(rows: DataFrame, **looked: Sequence[str]) -> DataFrame:
        return neighbours_in_task(rows, keys, order, **looked)

    def in_chunks(rows: DataFrame, **looked: Sequence[str]) -> DataFrame:
        return with_neighbours(rows, keys, order, chunk, **looked)

    busy = busy_buckets(log if counted is None else counted, keys, busy_rows)
    if not busy:
        return versions(log, in_task)
    is_busy = _bucket(keys).isin(*busy)
    return versions(log.where(~is_busy), in_task).unionByName(versions(log.where(is_busy), in_chunks))


def _versions(
    log: DataFrame, keys: Sequence[str], order: Sequence[str], state: Sequence[str], deleted: Column,
    beside: Callable[..., DataFrame],
) -> DataFrame:
    """Versions in two passes of ``beside``, which adds neighbours.

    The first drops every row that neither opens nor closes a version, the second
    pairs the two borders of each version.
    """
    sequence = order[0]

    def same(side: str) -> Column:
        """Whether the neighbour exists and holds the same state; deletes have no state."""
        return F.coalesce(F.col(f"{side}._mark") == F.col("_mark"), F.lit(False))

    seen = beside(
        log.withColumn("_gone", F.coalesce(deleted, F.lit(False))).withColumn("_mark", F.when(~F.col("_gone"), state_mark(state)).otherwise(F.struct(F.lit(0).cast("bigint").alias("h1"), F.lit(0).cast("bigint").alias("h2")))),
        previous=["_mark"],
        following=["_mark", sequence],
    )
    borders = (
        seen.withColumns(
            {"_opens": ~same("_previous"), "_closes": ~same("_following"), END: F.col(f"_following.{sequence}")}
        )
        .where(F.col("_opens") | F.col("_closes"))
        .drop("_previous", "_following")
    )
    paired = beside(borders, previous=[sequence])
    start = F.when(F.col("_opens"), F.col(sequence)).otherwise(F.col(f"_previous.{sequence}"))
    return paired.where(F.col("_closes") & ~F.col("_gone")).withColumn(START, start)


def snapshot_changes(
    earlier: DataFrame, later: DataFrame, keys: Sequence[str], at: datetime
) -> DataFrame:
    """Change log between two complete snapshots; a key missing from the later one is a delete.

    Both snapshots are unique per key, so the full outer join has no fan-out.
    """
    keys = list(keys)
    columns = later.columns

    def packed(frame: DataFrame, name: str) -> DataFrame:
        return frame.select(
            *keys,
            F.struct(*columns).alias(name),
            _fingerprint(columns, F.lit(False)).alias(f"{name}_state"),
        )

    both = packed(earlier.select(*columns), "_old").join(packed(later, "_new"), keys, "full")
    operation = (
        F.when(F.col("_old").isNull(), "INSERT").when(F.col("_new").isNull(), "DELETE").otherwise("UPDATE")
    )
    return (
        both.where(~F.col("_old_state").eqNullSafe(F.col("_new_state")))
        .select(F.coalesce("_new", "_old").alias("_row"), operation.alias(OPERATION))
        .select("_row.*", OPERATION, F.lit(at).cast("timestamp").alias(SEQUENCE))
    )


def scd2_from_snapshots(
    snapshots: Sequence[tuple[datetime, DataFrame]], keys: Sequence[str], untracked: Sequence[str] = AUDIT_COLUMNS
) -> DataFrame:
    """Type 2 history from complete snapshots taken one after another."""
    first_at, first = snapshots[0]
    log = first.withColumn(OPERATION, F.lit("INSERT")).withColumn(
        SEQUENCE, F.lit(first_at).cast("timestamp")
    )
    for (_, earlier), (at, later) in zip(snapshots, snapshots[1:]):
        log = log.unionByName(snapshot_changes(earlier, later, keys, at))
    return scd2(log, keys, untracked=untracked)


def current(history: DataFrame) -> DataFrame:
    """Open versions only."""
    return history.where(F.col(END).isNull())


def as_of(history: DataFrame, moment: datetime) -> DataFrame:
    """Versions that were valid at ``moment``."""
    at = F.lit(moment).cast("timestamp")
    return history.where((F.col(START) <= at) & (F.col(END).isNull() | (F.col(END) > at)))


def run_id(source_tables: Sequence[str], lineage: Sequence[Column]) -> Column:
    """Id of the run that made a row; it depends only on the sources and their batches."""
    batches = [F.coalesce(c.cast("string"), F.lit("")) for c in lineage]
    return F.sha2(F.concat_ws("|", F.lit(",".join(sorted(source_tables))), *batches), 256)


def with_audit_columns(
    frame: DataFrame,
    source_tables: Sequence[str],
    lineage: Sequence[Column],
    processed: Sequence[Column],
    masking_status: str,
) -> DataFrame:
    """Attach load lineage."""
    sources = ",".join(sorted(source_tables))
    moments = [c.cast("timestamp") for c in processed]
    return frame.withColumns(
        {
            "pipeline_run_id": run_id(source_tables, lineage),
            "source_table": F.lit(sources),
            "processed_at": moments[0] if len(moments) == 1 else F.greatest(*moments),
            "masking_status": F.lit(masking_status),
        }
    )
