"""Landing to Bronze as streams: every data set with rescue, evolution and one shared quarantine.

Each data set is one query over the lines of its files. A micro-batch is opened once
(JSON by its schema, CSV by the header of each file), its rows go to the data set's
Bronze table and everything refused to the quarantine, below the data set's name and the
batch's number, so a batch that runs again leaves one copy.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerstone.sources import bronze, landing, registry
from ledgerstone.sources.evolution import SchemaLedger, seen_in_rescued
from ledgerstone.streaming import flows


class Ingestion:
    """The landing area ``root`` kept up to date below ``out``; ``records`` are the declared schemas."""

    def __init__(self, spark: SparkSession, root: str, out: str, records: Mapping[str, StructType], ingested_at: Column | None = None) -> None:
        self.spark, self.root, self.out, self.at = spark, root, out, ingested_at
        self.declared = {t: records[t.partition("_")[2]] for t in registry.bronze_tables() if t.partition("_")[2] in records}
        self.ledger = SchemaLedger(spark, f"{out}/schemas")

    def _paths(self, table: str) -> tuple[str, str, str]:
        return f"{self.out}/bronze/{table}", f"{self.out}/quarantine/table={table}", f"{self.out}/checkpoints/{table}"

    def evolve(self) -> dict[str, list[str]]:
        """Add the columns that rescued data shows to the ledger. Call while no query runs, before ``start``."""
        added = {}
        for table, declared in self.declared.items():
            rows_path, refused_path, _ = self._paths(table)
            if not flows.holds_data(self.spark, refused_path):
                continue
            refused = self.spark.read.option("recursiveFileLookup", "true").parquet(refused_path).where("failure_reason = 'SCHEMA_RESCUED_DATA'")
            seen = seen_in_rescued(refused, member=None if table.startswith("file_") else "record")
            names = [f for f in seen.fields if f.name != "_line"]
            if new := self.ledger.extend(table, declared, StructType(names)):
                added[table] = new
        return added

    def schema(self, table: str) -> StructType:
        return self.ledger.schema(table, self.declared[table])

    def start(self, interval: str | None = None, files_per_batch: int | None = None) -> list[StreamingQuery]:
        queries = [self._table(t, interval, files_per_batch) for t in self.declared]
        return [*queries, *[self._invalid(kind, interval) for kind in ("cdc", "event")]]

    def _table(self, table: str, interval: str | None, files_per_batch: int | None) -> StreamingQuery:
        rows_path, refused_path, checkpoint = self._paths(table)
        flows.bind(self.spark, checkpoint, rows_path, refused_path)
        record = self.schema(table)

        def work(batch: DataFrame, batch_id: int) -> None:
            rows, bad = bronze.opened(batch, table, record, self.at)
            rows.persist()
            try:
                rows.write.mode("overwrite").parquet(f"{rows_path}/{flows.BATCH}={batch_id}")
                bronze.refused_rows(rows, bad, table, self.at).write.mode("overwrite").parquet(f"{refused_path}/{flows.BATCH}={batch_id}")
            finally:
                rows.unpersist()

        lines = bronze.landed_lines(self.spark, self.root, table, True, files_per_batch)
        return flows.each_batch(lines, work, checkpoint, interval)

    def _invalid(self, kind: str, interval: str | None) -> StreamingQuery:
        _, refused_path, checkpoint = self._paths(f"invalid_{kind}")
        invalid = landing.invalid_transport(self.spark, f"{self.root}/quarantine/{kind}", streaming=True)
        refused = bronze.refused_messages(invalid, kind, F.col("_metadata.file_path"), self.at)
        return flows.append_sink(refused, refused_path, checkpoint, interval)

    def table(self, name: str) -> DataFrame:
        """Rows landed so far, under the table's current schema: columns added later are null in earlier rows."""
        return self.spark.read.option("mergeSchema", "true").parquet(self._paths(name)[0]).drop(flows.BATCH)

    def quarantine(self) -> DataFrame:
        """Everything refused so far: all data sets and both kinds of invalid transport."""
        parts = [f"{self.out}/quarantine/table={t}" for t in [*self.declared, "invalid_cdc", "invalid_event"]]
        held = [p for p in parts if flows.holds_data(self.spark, p)]
        return bronze.ingestion_quarantine([self.spark.read.parquet(p).drop(flows.BATCH) for p in held])
