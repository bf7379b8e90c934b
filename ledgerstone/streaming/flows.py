"""Structured Streaming drivers around the batch operators.

Every ``foreachBatch`` write goes to a directory named by its batch id and
overwrites it, so a batch that is repeated after a failure leaves one copy.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerstone.operators.quality import Contract, passed, quarantined
from ledgerstone.operators.splice import AT, Splice, live

# Cadence and retention.
BRONZE_INTERVAL = "1 minute"
DOWNSTREAM_INTERVAL = "15 minutes"
DEDUPLICATION_WATERMARK = "7 days"

BATCH, BUCKET = "_batch", "_bucket"


def _trigger(interval: str | None) -> dict:
    """A processing interval, or (none given) drain what is there and stop."""
    return {"processingTime": interval} if interval else {"availableNow": True}


def holds_data(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists and has anything in it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(place) and len(files.listStatus(place)) > 0


def bind(spark: SparkSession, checkpoint: str, *outputs: str) -> None:
    """Refuse a new checkpoint over an output that has data.

    Batches of a new checkpoint are numbered from 0 again and would overwrite or skip
    what another one wrote. Replay into a fresh output, or keep the checkpoint.
    """

    if not holds_data(spark, f"{checkpoint}/offsets") and (taken := [p for p in outputs if holds_data(spark, p)]):
        raise ValueError(f"{', '.join(taken)} holds rows of another checkpoint than {checkpoint}")


def append_sink(stream: DataFrame, path: str, checkpoint: str, interval: str | None = None, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append-only Parquet table; the file sink's log makes each micro-batch appear once."""
    bind(stream.sparkSession, checkpoint, path)
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(**_trigger(interval)).start()


def inserts(spark: SparkSession, path: str) -> DataFrame:
    """New rows of an append-only Parquet table as a stream."""
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


def deduplicated(stream: DataFrame, keys: Sequence[str], moment: str = "processed_at", delay: str = DEDUPLICATION_WATERMARK) -> DataFrame:
    """Drop repeated deliveries of a key within the watermark; state older than it is evicted.

    Rows that arrive later than the watermark are not taken in and not counted;
    ``late.LateAwareTable`` keeps them apart instead.
    """
    return stream.withWatermark(moment, delay).dropDuplicatesWithinWatermark(list(keys))


def together(streams: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, streams)


def each_batch(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, interval: str | None = None) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
        .start()
    )


def split_sink(
    stream: DataFrame, contract: Contract, rules: Mapping[str, str | Column], passed_path: str, quarantine_path: str,
    checkpoint: str, interval: str | None = None,
) -> StreamingQuery:
    """Write passing rows and the quarantine envelope of failing rows from one read of each batch.

    The quarantine is shared: every entity writes below its own ``entity_name=`` directory.
    """

    bind(stream.sparkSession, checkpoint, passed_path, f"{quarantine_path}/entity_name={contract.name}")

    def work(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            passed(batch, rules).write.mode("overwrite").parquet(f"{passed_path}/{BATCH}={batch_id}")
            failures = quarantined(batch, contract, rules).drop("entity_name")
            failures.write.mode("overwrite").parquet(f"{quarantine_path}/entity_name={contract.name}/{BATCH}={batch_id}")
        finally:
            batch.unpersist()

    return each_batch(stream, work, checkpoint, interval)


class SplicedHistory:
    """Type 2 history kept up to date from a stream of validated changes, in any arrival order.

    Two append-only tables: the log of changes and signed runs (``operators.splice``). A
    batch splices its changes into the live runs of the keys it holds; late and
    out-of-order changes need no special case. A batch that runs again overwrites what
    it wrote and sees only what earlier batches wrote.
    """

    def __init__(self, spark: SparkSession, path: str, splice: Splice, buckets: int = 64) -> None:
        self.spark, self.splice, self.buckets = spark, splice, buckets
        self.log_path, self.runs_path = f"{path}/log", f"{path}/runs"

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.splice.keys), F.lit(self.buckets)).cast("int")

    def _before(self, path: str, batch_id: int | None, like: DataFrame | None = None) -> DataFrame | None:
        """Rows of earlier batches, of the buckets of ``like`` only."""
        if not holds_data(self.spark, path):
            return None
        rows = self.spark.read.parquet(path)
        rows = rows if batch_id is None else rows.where(F.col(BATCH) < batch_id)
        return rows if like is None else rows.join(like.select(self._bucket().alias(BUCKET)).distinct(), BUCKET, "left_semi")

    def apply(self, changes: DataFrame, batch_id: int) -> None:
        """Take in one batch of changes. Applying the same batch again has no further effect."""
        rows = self.splice.rows(changes)

        def log(split: DataFrame) -> DataFrame:
            """Earlier changes in the time that split runs span; none are read where no run is split."""
            at = self.splice.sequence
            span = split.agg(F.min(f"_from.{at}").alias("low"), F.max(f"_to.{at}").alias("high"), F.count("*").alias("n")).first()
            earlier = self._before(self.log_path, batch_id, split) if span["n"] else None
            if earlier is None:
                return rows.where("false")
            return earlier.where(F.col(f"{AT}.{at}").between(F.lit(span["low"]), F.lit(span["high"])))

        stored = self._before(self.runs_path, batch_id, rows)
        stored = None if stored is None else live(stored.drop(BUCKET), self.splice.keys, BATCH)
        for frame, path in ((rows, self.log_path), (self.splice.spliced(stored, changes, log), self.runs_path)):
            frame.withColumn(BUCKET, self._bucket()).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/{BATCH}={batch_id}")

    def read(self) -> DataFrame:
        """The current history."""
        return self.splice.versions(live(self.spark.read.parquet(self.runs_path).drop(BUCKET), self.splice.keys, BATCH))

    def follow(self, stream: DataFrame, checkpoint: str, interval: str | None = None) -> StreamingQuery:
        bind(self.spark, checkpoint, self.log_path)
        return each_batch(stream, self.apply, checkpoint, interval)
