"""Link documents whose word-shingle sets have a Jaccard similarity of at least a threshold.

Parity-sketch join. Two sets with J >= 3/4 and sizes a <= b differ in at most
D = (a + b) / 7 shingles, and b <= 4a/3. Shingle hashes are dealt to parts by their high
bits, and each part keeps the XOR of its hashes; sketches of one bit a bucket (the
parity of its hashes) are the same idea at one bit a part. A shingle that only one of
two sets holds changes one part, so of more than D parts one stays equal:

1. Size bands double. A set emits leading parts of its band, and of the next one if a
   partner may be there, always some more than it can differ from a partner of that
   band; sets below ``SMALL`` shingles, whose parts would often be
   empty, emit their smallest n/4 + 1 hashes instead, of which two linked sets share
   one. Differences would have to reach every part that the other 6/7 of the hashes
   fill; with D + 16 parts that chance is below 1e-10 a pair.
2. Documents with an equal part meet in a bucket. Each is paired only with the bucket's
   smallest document: a group of near copies costs one pair a document, not its square.
3. The Hamming distance of two parity sketches is at most the sets' difference, so pairs
   beyond D go; the rest is verified on the exact sets, and links become components
   (first one pair a document, then those that still join two components).
4. What is left are pairs of different components that meet in a bucket away from its
   smallest document. They are joined in the bucket, sketches compared inside the join,
   verified, and join their components.

Without words, text or doc_id a document is linked with nothing (its component is its own
doc_id). Rows of one doc_id are one document for links; each row is returned with its own
set size. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ledgerstone.llm.common import chosen, components, mixed, release, shingle_sets, stored, text_slices

K = 5
#: Linked: LOW * union <= HIGH * intersection.
LOW, HIGH = 3, 4
SMALL = 64
#: Parts emitted beyond the largest difference, as parts may be empty.
SPARE = 16
#: Signatures keep their high 48 bits: chance meetings are rare and only cost a comparison, and a row is shorter.
KEPT_BITS = np.uint64(0xFFFFFFFFFFFF0000)
#: 64-bit words of the parity sketch that bucket joins compare.
SKETCH_WORDS = 16
#: Larger sets have a second sketch of some 4 to 8 bits a shingle; in the short one their differences cancel.
WIDE_FROM = 1024


def bands_of(n: int) -> list[int]:
    """The size bands whose parts a set of n shingles emits."""
    band = n.bit_length() - 1
    return [band, band + 1] if HIGH * n >= LOW << (band + 1) else [band]


def parts_in(band: int) -> int:
    return 2 * ((2 << band) - 1) // 7 + 4


def parts_needed(n: int, band: int) -> int:
    """How many leading parts of the band a set of n shingles emits: more than its largest difference to a partner there."""
    largest = min((2 << band) - 1, HIGH * n // LOW)
    return min(parts_in(band), (n + largest) // 7 + SPARE)


def signatures(hashes: np.ndarray) -> np.ndarray:
    """Keys under which two linked sets meet at least once."""
    n, out = len(hashes), []
    if 0 < n <= SMALL * HIGH // LOW:
        out.append(mixed(hashes[: n // 4 + 1] ^ np.uint64(0xA0761D6478BD642F)))
    if n >= SMALL:
        high = hashes >> np.uint64(32)
        for band in bands_of(n):
            part = (high * np.uint64(parts_in(band))) >> np.uint64(32)
            some = int(np.searchsorted(part, parts_needed(n, band)))
            start = np.flatnonzero(np.r_[True, part[1:some] != part[: some - 1]]) if some else np.empty(0, np.int64)
            parity = np.bitwise_xor.reduceat(hashes[:some], start) if some else hashes[:0]
            out.append(mixed(parity ^ mixed(part[start] + np.uint64(band << 32))))
    return np.concatenate(out) & KEPT_BITS if out else hashes


def sketch(hashes: np.ndarray, words: int) -> bytes:
    """Parity of the hashes in each of 64 * words buckets; a bucket is a hash's low bits, so halves fold onto each other."""
    bucket = (hashes & np.uint64(64 * words - 1)).astype(np.int64)
    return np.packbits((np.bincount(bucket, minlength=64 * words) & 1).astype(np.uint8)).tobytes()


def wide_sketch(hashes: np.ndarray) -> bytes | None:
    return sketch(hashes, 1 << max(0, (len(hashes) - 1) // 16).bit_length()) if len(hashes) >= WIDE_FROM else None


def wide_distance(x: bytes, y: bytes) -> int:
    """Hamming distance of two wide sketches, the longer one folded to the length of the other."""
    a, b = sorted((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)), key=len)
    return int(np.bitwise_count(a ^ np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)).sum())


def _texts(docs: DataFrame) -> DataFrame:
    return chosen(docs, "doc_id", "text").select("doc_id", F.col("text").cast("string").alias("text"))


def buckets(docs: DataFrame) -> DataFrame:
    """(sig, doc_id) for every signature of every document."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in text_slices(batches):
            keys = [signatures(s) for s in shingle_sets(data, at, K)]
            sig = np.concatenate(keys)
            ids = part.column(0).take(pa.array(np.repeat(np.arange(len(keys)), [len(k) for k in keys])))
            yield pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), ids], ["sig", "doc_id"])

    return _texts(docs).where(F.col("doc_id").isNotNull()).mapInArrow(emit, "sig long, doc_id long")


def facts(docs: DataFrame) -> DataFrame:
    """Per row doc_id, n (set size), a 128-bit fingerprint of the set (f1, f2), its sketch (s0, s1, ...) and the wide one."""
    names = ["n", "f1", "f2", *[f"s{i}" for i in range(SKETCH_WORDS)]]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in text_slices(batches):
            rows, wide = [], []
            for s in shingle_sets(data, at, K):
                wide.append(wide_sketch(s))
                rows.append(np.r_[np.array([len(s), np.bitwise_xor.reduce(mixed(s)), s.sum(dtype=np.uint64)], np.uint64), np.frombuffer(sketch(s, SKETCH_WORDS), np.uint64)])
            columns = np.ascontiguousarray(np.array(rows, np.uint64).view(np.int64).T)
            yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, columns), pa.array(wide, pa.binary())], ["doc_id", *names, "wide"])

    return _texts(docs).mapInArrow(emit, "doc_id long, " + ", ".join(f"{c} long" for c in names) + ", wide binary")


def may_link(a: str, b: str) -> Column:
    """What sizes and sketches allow: comparable sizes, and a Hamming distance within the largest difference."""
    x, y = F.col(f"{a}.n"), F.col(f"{b}.n")
    distance = sum((F.bit_count(F.col(f"{a}.s{i}").bitwiseXOR(F.col(f"{b}.s{i}"))) for i in range(SKETCH_WORDS)), F.lit(0))
    return (LOW * F.greatest(x, y) <= HIGH * F.least(x, y)) & ((HIGH + LOW) * distance <= (HIGH - LOW) * (x + y))


def texts_of(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The texts of documents that stand in a pair."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    return _texts(docs).join(wanted, "doc_id", "left_semi")


def verified(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose exact sets are similar enough."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                few = batch.slice(i, 64)
                x, y = ([s for _, data, at in text_slices([few], c) for s in shingle_sets(data, at, K)] for c in (2, 3))
                linked = []
                for p, q in zip(x, y):
                    both = len(np.intersect1d(p, q, assume_unique=True))
                    linked.append(bool(both) and LOW * (len(p) + len(q) - both) <= HIGH * both)
                yield few.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    first = pairs.join(texts.withColumnsRenamed({"doc_id": "a", "text": "x"}), "a")
    return first.join(texts.withColumnsRenamed({"doc_id": "b", "text": "y"}), "b").select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


def linked(docs: DataFrame) -> DataFrame:
    """Per row doc_id, n_shingles and component_id, the smallest doc_id that links reach."""
    spark = docs.sparkSession
    known = stored(facts(docs), "facts")
    of_id = known.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    # a set's fingerprint decides its sketches, so any row's will do
    sketches = [F.first(c).alias(c) for c in known.columns if c == "wide" or c.startswith("s")]
    reps = stored(of_id.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("doc_id"), *sketches), "reps")
    rep_of = reps.select("n", "f1", "f2", F.col("doc_id").alias("b"))
    copies = of_id.select(F.col("doc_id").alias("a"), "n", "f1", "f2").join(rep_of, ["n", "f1", "f2"]).where("a <> b").select("a", "b").distinct()

    in_bucket = Window.partitionBy("sig")
    met = buckets(docs).withColumns({"size": F.count("*").over(in_bucket), "hub": F.min("doc_id").over(in_bucket)}).where("size > 1").drop("size")
    met = stored(met, "buckets")
    release(spark)
    near = met.where("doc_id <> hub").select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).distinct()
    near = stored(_both_known(near, reps), "pairs")
    texts = stored(texts_of(docs, near), "texts")
    release(spark)
    # one hub a document first; the other hubs only where that left two components
    one = near.groupBy("a").agg(F.min("b").alias("b"))
    first = stored(components(stored(verified(texts, one).unionByName(copies), "links")), "components")
    rest = _with_component(near, first).where("ca <> cb").select("a", "b")
    first = extended(first, stored(verified(texts, rest), "links"))

    of_rep = reps.select("doc_id").distinct().join(first.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    grouped = met.select("sig", "doc_id").join(of_rep.select("doc_id", F.coalesce("component", "doc_id").alias("component")), "doc_id")
    mixed_buckets = grouped.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("sig")
    apart = stored(grouped.join(mixed_buckets, "sig"), "apart").join(reps.drop("wide"), "doc_id")
    release(spark)
    pairs = (
        apart.alias("x").join(apart.alias("y"), (F.col("x.sig") == F.col("y.sig")) & (F.col("x.component") < F.col("y.component")) & may_link("x", "y"))
        .select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")).distinct()
    )
    pairs = stored(pairs, "pairs").join(near, ["a", "b"], "left_anti").join(near.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"], "left_anti")
    pairs = stored(_both_known(pairs, reps), "pairs")
    further = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct().join(texts.select("doc_id"), "doc_id", "left_anti"), "wanted")
    more = stored(_texts(docs).join(further, "doc_id", "left_semi"), "texts")
    last = extended(first, stored(verified(texts.unionByName(more), pairs), "links"))
    node = F.coalesce("component", "doc_id").alias("component_id")
    return known.select("doc_id", F.col("n").alias("n_shingles")).join(last.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("doc_id", "n_shingles", node)


def _with_component(pairs: DataFrame, first: DataFrame) -> DataFrame:
    ends = pairs.join(first.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left").join(first.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
    return ends.withColumns({"ca": F.coalesce("ca", "a"), "cb": F.coalesce("cb", "b")})


def extended(first: DataFrame, late: DataFrame) -> DataFrame:
    """Components (node, component) with further links; a component's own smallest node is not listed."""
    if late.isEmpty():
        return first
    merged = stored(components(_with_component(late, first).select(F.col("ca").alias("a"), F.col("cb").alias("b"))), "merged")
    moved = first.join(merged.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left")
    return stored(moved.select("node", F.coalesce("to", "component").alias("component")).unionByName(merged), "components")


def _both_known(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs of representatives that sizes and both sketches allow."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(2).to_pylist(), *[(v.as_buffer() if v.is_valid else None for v in batch.column(c)) for c in (3, 4)])
            fits = [x is None or y is None or (HIGH + LOW) * wide_distance(x, y) <= (HIGH - LOW) * n for n, x, y in rows]
            yield batch.select(["a", "b"]).filter(pa.array(fits, pa.bool_()))

    x, y = reps.alias("x"), reps.alias("y")
    both = pairs.join(x, F.col("a") == F.col("x.doc_id")).join(y, F.col("b") == F.col("y.doc_id")).where(may_link("x", "y"))
    wide = both.select("a", "b", (F.col("x.n") + F.col("y.n")).alias("n"), F.col("x.wide").alias("x"), F.col("y.wide").alias("y"))
    return wide.mapInArrow(near, "a long, b long").distinct()


def representatives(docs: DataFrame) -> DataFrame:
    """The rows that stay when one document of each component does: the one that gives it its id, once.

    Rows without doc_id stay. Of rows that share a doc_id one stays, the one with the
    largest set of shingles.
    """
    kept = linked(docs).where("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    whole = docs.select(F.struct("*").alias("doc"))
    unknown = whole.where("doc.doc_id IS NULL")
    known = whole.where("doc.doc_id IS NOT NULL").join(kept, F.col("doc.doc_id") == F.col("kept_id"), "left_semi")
    return known.groupBy("doc.doc_id").agg(F.max_by("doc", F.struct(F.octet_length("doc.text"), "doc.text")).alias("doc")).select("doc").unionByName(unknown).select("doc.*")
