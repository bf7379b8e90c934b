"""Type 2 history kept by splicing changes into stored runs, and by refreshing it from snapshots.

A run is a stretch of a key's changes with one state (a delete is a state too). A stored
run holds its last row, the order of its first and last row and of the run after it.
That is enough to take in new changes, in any order of arrival: only the run before and
the run after each new change can differ, so these alone are rebuilt, from their two
border rows, the new changes and, where a change falls inside a run of another state,
the log rows next to it. The result is signed: runs that are no longer so, and runs that
are now. Work follows the new changes; the log is read only where a run is split.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerstone.operators.history import AUDIT_COLUMNS, END, OPERATION, SEQUENCE, START, TIE_BREAKS, scd2
from ledgerstone.operators.ordered import time_chunk, with_last_marked, with_neighbours
from ledgerstone.session import settle

GONE, AT, FIRST, LAST, NEXT, SIGN = "_gone", "_at", "_first", "_last", "_next", "_sign"
#: Where a row of a rebuild comes from: a stored run's first row, a new change or a log row, a stored run's last row.
_KIND, _POINTER = "_kind", "_pointer"
_HEAD, _ROW, _TAIL = 0, 1, 2  # and so they stand where they share their order


class Splice:
    """How changes of one table are ordered, compared and deleted."""

    def __init__(
        self, keys: Sequence[str], sequence: str = SEQUENCE, tie_breaks: Sequence[str] = TIE_BREAKS, untracked: Sequence[str] = AUDIT_COLUMNS,
        deleted: Column | None = None, dropped: Sequence[str] = (OPERATION,), chunk_unit: str = "month",
    ) -> None:
        self.keys, self.sequence, self.tie_breaks = list(keys), sequence, list(tie_breaks)
        self.untracked, self.dropped, self.unit = set(untracked), set(dropped), chunk_unit
        self.deleted = F.col(OPERATION) == "DELETE" if deleted is None else deleted

    def rows(self, changes: DataFrame) -> DataFrame:
        """Changes as (keys, payload, whether deleted, order)."""
        order = [self.sequence, *[c for c in self.tie_breaks if c in changes.columns]]
        payload = [c for c in changes.columns if c not in {*order, *self.dropped}]
        return changes.select(*payload, F.coalesce(self.deleted, F.lit(False)).alias(GONE), F.struct(*order).alias(AT))

    def _payload(self, rows: DataFrame) -> list[str]:
        return [c for c in rows.columns if c not in (GONE, AT, FIRST, LAST, NEXT, SIGN, _KIND, _POINTER)]

    def _chunk(self, order: str) -> Column:
        return time_chunk(F.col(f"{order}.{self.sequence}"), self.unit)

    def _same(self, here: str, there: str, state: Sequence[str]) -> Column:
        """Whether two structs or rows hold one state; deletes are alike whatever they carry."""
        a, b = ([F.col(f"{side}{c}") for c in state] for side in (here, there))
        gone, other = F.col(f"{here}{GONE}"), F.col(f"{there}{GONE}")
        equal = F.struct(*a).eqNullSafe(F.struct(*b)) if state else F.lit(True)
        return F.coalesce((gone == other) & (gone | equal), F.lit(False))

    def runs(self, rows: DataFrame) -> DataFrame:
        """Runs of ``rows``, which may hold borders of stored runs instead of all their rows."""
        if _KIND not in rows.columns:
            rows = rows.withColumns({_KIND: F.lit(_ROW), _POINTER: F.lit(None).cast(rows.schema[AT].dataType)})
        payload = self._payload(rows)
        state = [c for c in payload if c not in self.keys and c not in self.untracked]
        looked = [GONE, AT, _KIND, _POINTER, *state]
        seen = with_neighbours(rows, self.keys, [AT], self._chunk(AT), previous=looked, following=looked)

        def gap(before: str, after: str) -> Column:
            """Between a stored run's last row and another's first row stand runs that are not rebuilt."""
            far = ~F.col(f"{before}{_POINTER}").eqNullSafe(F.col(f"{after}{AT}"))
            return F.coalesce((F.col(f"{before}{_KIND}") == _TAIL) & (F.col(f"{after}{_KIND}") == _HEAD) & far, F.lit(False))

        behind, ahead = gap("_previous.", ""), gap("", "_following.")
        alone = F.when(F.col(_KIND) == _TAIL, F.col(_POINTER))
        borders = seen.withColumns(
            {
                "_opens": ~self._same("", "_previous.", state) | behind,
                "_closes": ~self._same("", "_following.", state) | ahead,
                NEXT: F.when(F.col("_following").isNull() | ahead, alone).otherwise(F.col(f"_following.{AT}")),
            }
        ).where("_opens OR _closes")
        paired = with_neighbours(borders.drop("_previous", "_following"), self.keys, [AT], self._chunk(AT), previous=[AT])
        first = F.when(F.col("_opens"), F.col(AT)).otherwise(F.col(f"_previous.{AT}"))
        return paired.where("_closes").select(*payload, GONE, first.alias(FIRST), F.col(AT).alias(LAST), NEXT)

    def spliced(self, stored: DataFrame | None, changes: DataFrame, log: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Signed runs: -1 for stored runs that are replaced, +1 for those that stand now.

        ``stored`` holds the live runs of the changed keys; others may be among them.
        ``log(split)`` gives earlier changes as ``rows``, at least all of the keys in
        ``split`` between the order ``_from`` and ``_to`` of each of its rows.
        """
        fresh = self.rows(changes)
        if stored is None:
            return self.runs(fresh).withColumn(SIGN, F.lit(1))
        keys = self.keys
        payload = self._payload(fresh)
        state = [c for c in payload if c not in keys and c not in self.untracked]
        touched = fresh.select(*keys).distinct()
        held = stored.join(touched, keys, "left_semi")
        # stored runs by their first row and new changes in one order
        # each step is computed once and cut off; none is larger than the changes and the runs of their keys
        both = held.select(*payload, GONE, F.col(FIRST).alias(AT), F.struct(LAST, NEXT, GONE, *state).alias("_run")).unionByName(
            fresh.withColumn("_run", F.lit(None)), allowMissingColumns=True
        )
        both, is_run = settle(both), F.col("_run").isNotNull()
        near = with_neighbours(both.withColumn("_is_run", is_run), keys, [AT, "_is_run"], self._chunk(AT), previous=["_is_run"], following=["_is_run"])
        beside = ~F.coalesce(F.col("_previous._is_run"), F.lit(True)) | ~F.coalesce(F.col("_following._is_run"), F.lit(True))
        affected = settle(near.where(is_run & beside).select(*payload, GONE, F.col(AT).alias(FIRST), F.col(f"_run.{LAST}").alias(LAST), F.col(f"_run.{NEXT}").alias(NEXT)))

        covered = with_last_marked(both, keys, [AT], self._chunk(AT), is_run, F.struct(F.col(AT).alias(FIRST), "_run"), "_cover").where(~is_run)
        inside = (F.col(AT) < F.col(f"_cover._run.{LAST}")) & ~self._same("", "_cover._run.", state)
        split = settle(covered.where(inside).select(*keys, AT, F.col(f"_cover.{FIRST}").alias("_from"), F.col(f"_cover._run.{LAST}").alias("_to")))
        beside_split = self._log_rows(split, log, payload)

        last, none = F.col(NEXT), F.lit(None).cast(fresh.schema[AT].dataType)
        ends = F.array(F.struct(F.col(FIRST).alias(AT), F.lit(_HEAD).alias(_KIND), none.alias(_POINTER)), F.struct(F.col(LAST).alias(AT), F.lit(_TAIL).alias(_KIND), last.alias(_POINTER)))
        borders = affected.withColumn("_end", F.explode(ends)).select(*payload, GONE, "_end.*")
        rows = fresh.unionByName(beside_split).withColumns({_KIND: F.lit(_ROW), _POINTER: none})
        now = self.runs_of_borders(settle(rows.unionByName(borders)))
        return now.withColumn(SIGN, F.lit(1)).unionByName(affected.withColumn(SIGN, F.lit(-1)))

    def runs_of_borders(self, rows: DataFrame) -> DataFrame:
        """``runs`` of rows of all kinds, ordered by their kind where a border shares a change's order."""
        ranked = rows.withColumn(AT, F.struct(f"{AT}.*", F.col(_KIND).alias("_rank")))
        pointed = ranked.withColumn(_POINTER, F.when(F.col(_POINTER).isNotNull(), F.struct(f"{_POINTER}.*", F.lit(_HEAD).alias("_rank"))))
        made = self.runs(pointed)
        return made.withColumns({c: F.when(F.col(c).isNotNull(), F.col(c).dropFields("_rank")) for c in (FIRST, LAST, NEXT)})

    def _log_rows(self, split: DataFrame, log: Callable[[DataFrame], DataFrame], payload: Sequence[str]) -> DataFrame:
        """The log rows just before and just after each change that falls inside a run of another state, within that run."""
        earlier = log(split).select(*payload, GONE, AT).join(split.select(*self.keys).distinct(), self.keys, "left_semi")
        marked = earlier.withColumn("_split", F.lit(False)).unionByName(
            split.select(*self.keys, AT, F.struct("_from", "_to").alias("_within")).withColumn("_split", F.lit(True)), allowMissingColumns=True
        )
        near = with_neighbours(marked, self.keys, [AT, "_split"], self._chunk(AT), previous=["_split", "_within"], following=["_split", "_within"])
        after = F.col("_previous._split") & (F.col(AT) <= F.col("_previous._within._to"))
        before = F.col("_following._split") & (F.col(AT) >= F.col("_following._within._from"))
        return near.where(~F.col("_split") & (F.coalesce(after, F.lit(False)) | F.coalesce(before, F.lit(False)))).select(*payload, GONE, AT)

    def versions(self, runs: DataFrame) -> DataFrame:
        """Type 2 versions of live runs: deletes only close them."""
        names = [c for c in self._payload(runs)]
        return runs.where(~F.col(GONE)).select(*names, F.col(f"{FIRST}.{self.sequence}").alias(START), F.col(f"{NEXT}.{self.sequence}").alias(END))


def live(signed: DataFrame, keys: Sequence[str], batch: str) -> DataFrame:
    """Runs that stand after all batches of signed rows: of each (key, first row) the last word, where it is no withdrawal."""
    word = F.struct(batch, SIGN)
    rest = [c for c in signed.columns if c not in (*keys, FIRST, batch)]
    said = signed.groupBy(*keys, FIRST).agg(F.max_by(F.struct(*rest), word).alias("_said"))
    return said.where(f"_said.{SIGN} = 1").select(*keys, FIRST, *[f"_said.{c}" for c in rest if c != SIGN])


def refreshed(history: DataFrame | None, state: DataFrame, keys: Sequence[str], at: datetime, untracked: Sequence[str] = AUDIT_COLUMNS) -> DataFrame:
    """Type 2 history after a refresh: its stored versions against the complete state at ``at``, one full join.

    A key whose tracked columns are as in its open version keeps it, with the state's
    untracked columns. Another state closes the open version and opens one; a key that
    the state lacks closes, a new one opens. Closed versions pass through.
    """
    keys, moment = list(keys), F.lit(at).cast("timestamp")
    columns = state.columns
    tracked = [c for c in columns if c not in keys and c not in untracked]
    never = F.lit(None).cast("timestamp")
    if history is None:
        return state.select(*columns, moment.alias(START), never.alias(END))

    def packed(frame: DataFrame, name: str, *more: str) -> DataFrame:
        return frame.select(*keys, F.struct(*columns, *more).alias(name))

    both = packed(history.where(F.col(END).isNull()), "_old", START).join(packed(state, "_new"), keys, "full")
    old, new = (F.struct(F.lit(0), *[F.col(f"{side}.{c}") for c in tracked]) for side in ("_old", "_new"))
    kept = F.col("_old").isNotNull() & F.col("_new").isNotNull() & old.eqNullSafe(new)

    def version(row: str, start: Column, end: Column) -> Column:
        return F.struct(*[F.col(f"{row}.{c}").alias(c) for c in columns], start.alias(START), end.alias(END))

    started = F.col(f"_old.{START}")
    versions = F.when(kept, F.array(version("_new", started, never))).otherwise(
        F.array_compact(
            F.array(F.when(F.col("_old").isNotNull(), version("_old", started, moment)), F.when(F.col("_new").isNotNull(), version("_new", moment, never)))
        )
    )
    now = both.select(F.explode(versions).alias("v")).select("v.*")
    return history.where(F.col(END).isNotNull()).select(*columns, START, END).unionByName(now)


def folded(
    log: DataFrame, keys: Sequence[str], moment: datetime, days: int = 7, sequence: str = SEQUENCE, tie_breaks: Sequence[str] = TIE_BREAKS, **scd2_options
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(log that stays, versions that it no longer holds, where each key was cut): retention of deletes.

    A key's last delete older than the retention goes, and with it every row that it
    ends: their versions are closed for good and come out as such. So the history of
    what stays, and these versions, are the history of the whole log, and no dropped
    delete reopens a key. Later arrivals before a key's cut (third frame) are late:
    ``after_cut`` tells them apart.
    """
    keys = list(keys)
    order = F.struct(sequence, *[c for c in tie_breaks if c in log.columns])
    deleted = scd2_options.get("deleted")
    deleted = F.col(OPERATION) == "DELETE" if deleted is None else deleted
    cutoff = F.lit(moment).cast("timestamp") - F.make_dt_interval(F.lit(days))
    cuts = log.where(deleted & (F.col(sequence) < cutoff)).groupBy(*keys).agg(F.max(order).alias("_cut"))
    placed = log.join(cuts, keys, "left").withColumn("_ended", F.coalesce(order <= F.col("_cut"), F.lit(False))).drop("_cut")
    closed = scd2(placed.where("_ended").drop("_ended"), keys, sequence, tie_breaks, **scd2_options)
    return placed.where("NOT _ended").drop("_ended"), closed, cuts


def after_cut(changes: DataFrame, cuts: DataFrame, keys: Sequence[str], sequence: str = SEQUENCE, tie_breaks: Sequence[str] = TIE_BREAKS) -> tuple[DataFrame, DataFrame]:
    """(changes to take in, late ones) by the cuts of ``folded``."""
    order = F.struct(sequence, *[c for c in tie_breaks if c in changes.columns])
    placed = changes.join(cuts, list(keys), "left").withColumn("_late", F.coalesce(order <= F.col("_cut"), F.lit(False))).drop("_cut")
    return placed.where("NOT _late").drop("_late"), placed.where("_late").drop("_late")
