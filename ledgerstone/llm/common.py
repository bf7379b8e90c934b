"""Helpers shared by the operators: shared storage, Arrow batches of text, word hashes."""

from __future__ import annotations

import functools
import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Bytes of text that a task holds decoded at a time; one longer text is held alone.
SLICE_BYTES = 4 << 20

#: The six white-space bytes that separate words and are stripped from lines.
BLANKS = b" \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session, whose executors live in the driver, may go without it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` once to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = f"{shared_folder(frame.sparkSession)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of steps whose results are stored; it does so when the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def chosen(frame: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that others, whatever they are called, never meet derived ones."""
    return frame.select(*[F.col(f"`{n}`") for n in names])


def text_slices(batches: Iterator[pa.RecordBatch], text: int = 1) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut Arrow batches into slices of about SLICE_BYTES of text.

    Yields the slice, its text as one byte array (null counts as empty) and the
    texts' offsets in it.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        column = batch.column(text)
        if column.null_count:
            column = column.fill_null("")
        column = column.cast(pa.large_string())
        at = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        first = 0
        while first < len(column):
            last = max(first + 1, int(np.searchsorted(at, at[first] + SLICE_BYTES, "right")) - 1)
            yield batch.slice(first, last - first), data[at[first] : at[last]], at[first : last + 1] - at[first]
            first = last


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.cache
def _byte_values(fold: bool) -> np.ndarray:
    values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    if fold:
        values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


_powers: dict[str, np.ndarray] = {}
_BASE, _UNBASE = 0xD1342543DE82EF95, pow(0xD1342543DE82EF95, -1, 1 << 64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base modulo 2**64, and of its inverse."""
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", _UNBASE)):
            steps = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def rolling(data: np.ndarray, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(prefix, unscale): the hash of bytes i to j is (prefix[j] - prefix[i]) * unscale[i], wherever they stand."""
    up, down = powers(len(data) + 1)
    prefix = np.empty(len(data) + 1, np.uint64)
    prefix[0] = 0
    np.cumsum(_byte_values(fold)[data] * up[:-1], out=prefix[1:])
    return prefix, down


_is_blank = np.zeros(256, bool)
_is_blank[list(BLANKS)] = True


def word_spans(data: np.ndarray, at: np.ndarray, blank: np.ndarray = _is_blank) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, end, document) of each word between blank bytes, in order."""
    if len(data) == 0:
        none = np.empty(0, np.int64)
        return none, none, none
    solid = ~blank[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    ends[:-1] &= ~solid[1:] | edge[1:-1]
    first, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return first, end, np.searchsorted(at, first, "right") - 1


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words between white space: (hash with A-Z folded, first byte, end, document) of each, in order."""
    first, end, doc = word_spans(data, at)
    prefix, down = rolling(data, fold=True)
    return mixed((prefix[end] - prefix[first]) * down[first]), first, end, doc


def shingles(word: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words; whoever calls cuts at document borders."""
    n = len(word) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = out * np.uint64(0x9FB21C651E98DF25) + word[i : i + n]
    return mixed(out)


def shingle_sets(data: np.ndarray, at: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Per document its distinct k-word shingles as sorted hashes; all words as one where there are fewer."""
    word, _, _, doc = words(data, at)
    every = shingles(word, k)
    bounds = np.searchsorted(doc, np.arange(len(at)))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= k:
            yield np.unique(every[a : b - k + 1])
        else:
            yield shingles(word[a:b], b - a) if b > a else np.empty(0, np.uint64)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected links: (node, component), component the smallest node.

    Each round points every node at the smallest node that it or a neighbour points
    at (large star, then small star), so trees shrink by halves and a hub's many
    links stay one row each; rounds are stored, and end when nothing changes.
    """
    edges = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # every larger neighbour of u now hangs on the smallest node near u
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stored(lowest.select("u", F.col("m").alias("v")).unionByName(small).where("u <> v").distinct(), "links")
        if sums(after) == sums(edges):
            break
        edges = after
    return edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")


def sums(edges: DataFrame) -> tuple:
    """Count and order-free checksum of links: one row to the driver."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first())


def crc_of(column: Column) -> Column:
    """CRC-32 of a value as text."""
    return F.crc32(column.cast("string").cast("binary"))


def labelled(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(doc_id, label, text) of at most ``rows`` labelled documents, those with the smallest hashes of doc_id.

    The bound is a number of rows, so the ids may be broadcast whatever the input's size.
    """
    picked = chosen(labels, "doc_id", label).where(f"doc_id IS NOT NULL AND `{label}` IS NOT NULL").select("doc_id", F.col(label).cast("int").alias("label"))
    ids = picked.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)
    return chosen(docs, "doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", "text", "label")
