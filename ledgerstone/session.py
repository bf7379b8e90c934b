"""Session settings and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning is what lets one plan serve both a laptop and a cluster:
# partitions are coalesced when small and split when one of them is skewed.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Keyed stream state lives on disk with a memory cache, not on the JVM heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# The JVM never compiles a method above 8,000 bytes of bytecode. Many rules and
# typed columns fused into one generated method pass that size and would then run
# interpreted, several times slower; beyond the limit Spark generates one smaller
# class per operator instead.
CODEGEN_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")


def tune(spark: SparkSession) -> SparkSession:
    """Set the codegen limit on a session that brings none of its own."""
    key, value = CODEGEN_LIMIT
    if spark.conf.get(key) == "65535":  # Spark's default
        spark.conf.set(key, value)
    return spark


def local_session(name: str = "ledgerstone", cpus: str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    return (
        builder.config(*CODEGEN_LIMIT)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def settle(frame: DataFrame) -> DataFrame:
    """Compute ``frame`` once, as Parquet in the shared checkpoint folder, and cut its lineage.

    Used for frames that several downstream products read; each reader takes only the
    columns it needs. The folder is the one the cluster names in ``spark.checkpoint.dir``, so
    the result outlives a lost executor. A local session may go without one and gets a scratch folder.
    The shuffle files behind it are let go, which Spark does when the driver collects garbage.
    """
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(frame.sparkSession))
    path = f"{context.getCheckpointDir()}/settled-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    context._jvm.System.gc()
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; refused on a cluster without one, where each machine has its own /tmp."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return shared or tempfile.mkdtemp(prefix="run-", dir="/tmp")
