"""Governed entities kept up to date from streams of their Bronze rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerstone.operators.history import END
from ledgerstone.operators.quality import ERROR, compile_rules, observed, passed, quarantined
from ledgerstone.operators.splice import Splice, refreshed
from ledgerstone.plans.contracts import SILVER_CONTRACTS
from ledgerstone.plans.silver import APPEND, ENTITIES, JOINED, source_passed, typed
from ledgerstone.streaming import flows
from ledgerstone.streaming.late import LateAwareTable


class EntityStream:
    """One entity below ``root``: its rows, its quarantine and its checkpoints.

    Changes go to a ``SplicedHistory``; immutable records to a ``LateAwareTable``, which
    keeps what is later than the watermark apart. Both divert failing rows into the
    shared quarantine layout.
    """

    def __init__(self, spark: SparkSession, name: str, root: str, as_of: datetime, buckets: int = 64) -> None:
        self.entity, self.contract = ENTITIES[name], SILVER_CONTRACTS[name]
        if self.entity.mode == JOINED:
            raise ValueError(f"{name} is built from snapshots of several sources, not from one stream")
        self.spark, self.root = spark, root
        self.as_of, self.rules = as_of, compile_rules(self.contract, ERROR, as_of)
        self.rows_path, self.refused_path, self.metrics_path = f"{root}/{name}/rows", f"{root}/quarantine", f"{root}/metrics"
        self.checkpoint = f"{root}/{name}/checkpoint"
        append = self.entity.mode == APPEND
        self.table = LateAwareTable(spark, self.rows_path, self.entity.keys) if append else flows.SplicedHistory(spark, self.rows_path, Splice(self.entity.keys), buckets)

    def start(self, bronze: DataFrame, interval: str | None = None) -> list[StreamingQuery]:
        rows = typed(self.entity, source_passed(bronze, self.entity.source))
        flows.bind(self.spark, f"{self.checkpoint}/rows", self.rows_path)
        return [flows.each_batch(rows, self._split, f"{self.checkpoint}/rows", interval)]

    def _refuse(self, batch: DataFrame, batch_id: int) -> None:
        """Write the failing rows, and the counts of every rule that the same pass takes."""
        seen, metrics = observed(batch, self.contract, self.as_of)
        place = f"entity_name={self.contract.name}/{flows.BATCH}={batch_id}"
        failures = quarantined(seen, self.contract, self.rules).drop("entity_name")
        failures.write.mode("overwrite").parquet(f"{self.refused_path}/{place}")
        metrics().drop("entity_name").write.mode("overwrite").parquet(f"{self.metrics_path}/{place}")

    def _split(self, batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            self._refuse(batch, batch_id)
            self.table.apply(passed(batch, self.rules), batch_id)
        finally:
            batch.unpersist()

    def read(self) -> DataFrame:
        return self.table.read()

    def metrics(self) -> DataFrame:
        """Passed and failed rows per rule over all batches."""
        rows = self.spark.read.parquet(self.metrics_path).where(F.col("entity_name") == self.contract.name)
        return rows.groupBy("entity_name", "rule_id", "severity", "dimension").agg(F.sum("passed_count").alias("passed_count"), F.sum("failed_count").alias("failed_count"))

    def refused(self) -> DataFrame:
        return self.spark.read.parquet(self.refused_path).drop(flows.BATCH)


class JoinedEntity:
    """A joined entity's type 2 history below ``root``, refreshed from its complete state.

    Each refresh writes the versions that it closed and the open ones; versions closed
    before are never read or written again. A refresh that runs again overwrites its own.
    """

    REFRESH = "_refresh"

    def __init__(self, spark: SparkSession, name: str, root: str) -> None:
        self.spark, self.name, self.keys = spark, name, ENTITIES[name].keys
        self.open_path, self.closed_path = f"{root}/{name}/open", f"{root}/{name}/closed"

    def refresh(self, state: DataFrame, at: datetime, number: int) -> None:
        """Take in the state at ``at``; refreshes are numbered from 0 without a gap."""
        before = self.spark.read.parquet(f"{self.open_path}/{self.REFRESH}={number - 1}") if number else None
        versions = refreshed(before, state, self.keys, at)
        versions.persist()
        try:
            versions.where(F.col(END).isNotNull()).write.mode("overwrite").parquet(f"{self.closed_path}/{self.REFRESH}={number}")
            versions.where(F.col(END).isNull()).write.mode("overwrite").parquet(f"{self.open_path}/{self.REFRESH}={number}")
        finally:
            versions.unpersist()

    def read(self, number: int) -> DataFrame:
        """The history after a refresh."""
        closed = self.spark.read.parquet(self.closed_path).where(F.col(self.REFRESH) <= number).drop(self.REFRESH)
        return closed.unionByName(self.spark.read.parquet(f"{self.open_path}/{self.REFRESH}={number}"))
