"""Keyed deduplication of immutable records that loses no late row.

Spark's own stateful operator drops what is later than the watermark, unseen. Here the
running maximum of the event time is carried from batch to batch, and each micro-batch
is dealt into rows that are new, rows that repeat a key, and late rows, which go to an
output of their own. All are counted while they are written. Accepted rows and the keys
that only late rows hold are, whatever the arrival, the deduplicated records.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerstone.operators.ordered import top_by
from ledgerstone.streaming.flows import BATCH, bind, each_batch, holds_data

DAY, REASON = "_day", "_late_reason"
LATE, NO_TIME = "LATER_THAN_WATERMARK", "NO_EVENT_TIME"
DELAY = timedelta(days=7)


class LateAwareTable:
    """Records below ``path``, one per key within the delay, with late rows and counts beside them.

    A key is looked for among rows accepted from twice the delay before the newest event
    time on: a repeat that is not late itself, and not further than the delay from the
    row it repeats, is found. Of rows that share a key in one batch the earliest stays;
    ties go by the row's content. Rows without an event time count as late.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], moment: str = "processed_at", delay: timedelta = DELAY) -> None:
        self.spark, self.keys, self.moment, self.delay = spark, list(keys), moment, delay
        self.rows_path, self.late_path, self.counts_path = (f"{path}/{p}" for p in ("rows", "late", "counts"))

    def _high(self, batch_id: int):
        """The greatest event time of earlier batches; their numbers follow each other."""
        path = f"{self.counts_path}/{BATCH}={batch_id - 1}"
        return self.spark.read.parquet(path).first()["high"] if holds_data(self.spark, path) else None

    def _known(self, since, high) -> DataFrame | None:
        """Keys accepted in earlier batches from ``since`` on: only the days of that span are read."""
        days = ((since + timedelta(days=n)).date() for n in range((high.date() - since.date()).days + 1))
        held = [p for d in days if holds_data(self.spark, p := f"{self.rows_path}/{DAY}={d.isoformat()}")]
        return self.spark.read.option("basePath", self.rows_path).parquet(*held).select(*self.keys, BATCH) if held else None

    def _repeats(self, on_time: DataFrame, batch_id: int, high) -> DataFrame:
        """On-time rows, one per key, with ``_seen`` where an earlier batch accepted the key."""
        first = top_by(on_time, self.keys, [F.col(self.moment), F.xxhash64(*on_time.columns)], 1).drop("_rank")
        known = None if high is None else self._known(high - 2 * self.delay, high)
        if known is None:
            return first
        earlier = known.where(F.col(BATCH) < batch_id).alias("k")
        equal = [F.col(f"r.{k}").eqNullSafe(F.col(f"k.{k}")) for k in self.keys]
        return first.alias("r").join(earlier, equal, "left_anti").select("r.*")

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Deal one micro-batch. Applying the same batch again has no further effect."""
        high = self._high(batch_id)
        moment = F.col(self.moment)
        late: Column = moment.isNull() if high is None else moment.isNull() | (moment < F.lit(high - self.delay))
        reason = F.when(moment.isNull(), NO_TIME).otherwise(LATE)
        came, kept = Observation(), Observation()
        batch = batch.observe(came, F.count("*").alias("rows"), F.count_if(late).alias("late"), F.max(moment).alias("high"))
        refused = batch.where(late).withColumn(REASON, reason)
        refused.write.mode("overwrite").parquet(f"{self.late_path}/{BATCH}={batch_id}")
        accepted = self._repeats(batch.where(~late), batch_id, high).observe(kept, F.count("*").alias("rows"))
        dated = accepted.withColumns({DAY: F.to_date(moment), BATCH: F.lit(batch_id)})
        # a batch that runs again overwrites its own folders, whose days and rows are the same again
        dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY, BATCH).parquet(self.rows_path)
        seen, taken = came.get, kept.get
        highs = [h for h in (high, seen["high"]) if h is not None]
        counts = (seen["rows"], taken["rows"], seen["late"], seen["rows"] - seen["late"] - taken["rows"], max(highs, default=None))
        schema = "rows long, accepted long, late long, repeated long, high timestamp"
        self.spark.createDataFrame([counts], schema).write.mode("overwrite").parquet(f"{self.counts_path}/{BATCH}={batch_id}")

    def follow(self, stream: DataFrame, checkpoint: str, interval: str | None = None) -> StreamingQuery:
        bind(self.spark, checkpoint, self.counts_path)
        return each_batch(stream, self.apply, checkpoint, interval)

    def read(self) -> DataFrame:
        """Accepted rows, one per key within the delay."""
        return self.spark.read.parquet(self.rows_path).drop(DAY, BATCH)

    def late(self) -> DataFrame:
        """Late rows with the reason and their batch."""
        return self.spark.read.parquet(self.late_path)

    def counts(self) -> DataFrame:
        """One row per batch: rows that came, were accepted, were late, repeated a key; the event time reached."""
        return self.spark.read.parquet(self.counts_path)

    def reconciled(self) -> DataFrame:
        """Accepted and late rows together, one per key, the earliest: the answer of a batch over all rows."""
        whole = self.read().unionByName(self.late().drop(REASON, BATCH))
        return top_by(whole, self.keys, [F.col(self.moment).asc_nulls_last(), F.xxhash64(*whole.columns)], 1).drop("_rank")
