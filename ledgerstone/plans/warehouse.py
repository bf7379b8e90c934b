"""Names to frames: sources, governed entities and products, each built on demand."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from ledgerstone.operators.history import OPERATION
from ledgerstone.operators.quality import ERROR, PRE_TRANSFORM, compile_rules, quarantined, required_rules
from ledgerstone.operators.splice import refreshed
from ledgerstone.plans import silver
from ledgerstone.plans.contracts import SILVER_CONTRACTS, SOURCE_CONTRACTS
from ledgerstone.plans.gold import PRODUCTS
from ledgerstone.session import settle


class Warehouse:
    """Lazily built products over one set of sources at one explicit point in time.

    ``sources`` gives the Bronze rows of a data set by name. ``stored`` may give
    an already written entity or product, which is then read, not rebuilt.
    ``settled`` names products, and entities' current rows, to compute once because several
    others read them. As a mapping it gives the columns to store of each, all for None; it
    must name every column that readers do.
    """

    def __init__(
        self,
        sources: Callable[[str], DataFrame],
        as_of: datetime,
        token_key: bytes,
        stored: Callable[[str], DataFrame | None] = lambda name: None,
        settled: frozenset[str] | Mapping[str, Sequence[str] | None] = frozenset(),
    ) -> None:
        self.sources, self.as_of, self.token_key = sources, as_of, token_key
        self._stored = stored
        self._settled = settled if isinstance(settled, Mapping) else dict.fromkeys(settled)
        self._frames: dict[tuple[str, str], DataFrame] = {}
        self._kept: set[tuple[str, str]] = set()

    @property
    def now(self) -> Column:
        return F.lit(self.as_of).cast("timestamp")

    @property
    def today(self) -> Column:
        return F.lit(self.as_of.date()).cast("date")

    def before(self, **span: float) -> Column:
        return F.lit(self.as_of - timedelta(**span)).cast("timestamp")

    def _once(self, kind: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        slot = (kind, name)
        if slot not in self._frames:
            frame = self._stored(name) if kind in ("gold", "history") else None
            frame = make() if frame is None else frame
            if name in self._settled and kind in ("gold", "silver"):
                columns = self._settled[name]
                frame = settle(frame if columns is None else frame.select(*columns))
            self._frames[slot] = frame
        return self._frames[slot]

    def holds(self, kind: str, name: str) -> bool:
        """Whether a product is stored, or will be once it is built, so that reading it is cheaper than building its parts."""
        return name in self._settled or (kind, name) in self._kept or self._stored(name) is not None

    def keep(self, kind: str, name: str, frame: DataFrame) -> None:
        """Use ``frame`` for a product from now on, such as its stored form."""
        self._frames[(kind, name)] = frame
        self._kept.add((kind, name))

    def built(self, name: str) -> DataFrame:
        """Typed rows of an entity before its rules."""
        return self._once("built", name, lambda: silver.build(name, self.sources, self.token_key))

    def changes(self, name: str) -> DataFrame:
        """Rows that pass every hard rule."""
        return self._once("changes", name, lambda: silver.validated(name, self.built(name), self.as_of))

    def silver(self, name: str) -> DataFrame:
        """Current rows of an entity."""
        return self._once("silver", name, lambda: silver.current_rows(name, self._changes_with_batch(name)))

    def _changes_with_batch(self, name: str) -> DataFrame:
        """``changes`` whose current rows name their run only when they are found."""
        if silver.ENTITIES[name].mode != silver.SCD2 or {("built", name), ("changes", name)} & self._kept:
            return self.changes(name)
        return silver.validated(name, silver.build(name, self.sources, self.token_key, with_batch=True), self.as_of)

    def history(self, name: str) -> DataFrame:
        """All stored rows of an entity: type 2 versions or immutable records."""
        if silver.ENTITIES[name].mode == silver.JOINED:
            return self.silver(name)
        return self._once("history", name, lambda: silver.publish(name, self.changes(name), self.built(name)))

    def at(self, moment: datetime) -> Warehouse:
        """The same sources as they were ingested up to ``moment``."""
        limit = F.lit(moment).cast("timestamp")
        return Warehouse(lambda source: self.sources(source).where(F.col("_ingested_at") <= limit), self.as_of, self.token_key)

    def joined_history(self, name: str, moments: Sequence[datetime], stored: DataFrame | None = None) -> DataFrame:
        """Type 2 history of a joined entity, refreshed from its complete state at each moment.

        A key that a later state lacks, because its source row is gone or no
        longer passes, closes at that moment. ``stored`` is the history so far; each
        refresh is one full join of its open versions with the new state.
        """
        for moment in moments:
            state = self.at(moment).changes(name)
            stored = settle(refreshed(stored, state, silver.ENTITIES[name].keys, moment))
        return stored

    def dated(self, name: str) -> DataFrame:
        """Rows that carry every date of an entity's history.

        Dates are tracked, so each change that is no delete is some version's
        state: the changes give the same dates as the versions built from them.
        """
        if silver.ENTITIES[name].mode == silver.SCD2 and self._stored(name) is None:
            return self.changes(name).where(F.col(OPERATION) != "DELETE")
        return self.history(name)

    def gold(self, name: str) -> DataFrame:
        return self._once("gold", name, lambda: PRODUCTS[name](self))

    def quarantine(self, name: str) -> DataFrame:
        """Rows of an entity that break a hard rule, in the fixed envelope."""
        contract = SILVER_CONTRACTS[name]
        return quarantined(self.built(name), contract, compile_rules(contract, ERROR, self.as_of))

    def source_quarantine(self, source: str) -> DataFrame:
        """Source rows that lack a required field."""
        contract = SOURCE_CONTRACTS[source]
        return quarantined(
            self.sources(source), contract, required_rules(contract), PRE_TRANSFORM, self.as_of
        )
