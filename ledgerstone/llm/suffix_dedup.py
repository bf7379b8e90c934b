"""Remove every byte that a repeated byte string of a given length covers, by suffix arrays.

Whole-corpus suffix sorting is cut into shards that never miss a match:

1. Every window of ``length`` bytes has one anchor: the leftmost run of ``GRAM`` bytes
   in it with the smallest hash. Equal windows have equal anchors at equal offsets, so
   windows can only match where their anchors' hashes (keys) are equal. Consecutive
   windows with one anchor form a fragment; a fragment whose key occurs once in the
   corpus holds no repeat and ends there.
2. Equal fragments go on as one with their count, so a passage that a third of all rows
   hold travels as one row per distinct surrounding.
3. Fragments are dealt to shards by key. Each shard is one text, 0xFF (never in UTF-8)
   behind each fragment. Its suffix array is made by induced sorting: suffixes are
   classified, the leftmost smaller ones sorted by their substrings, recursively, and
   all others induced from them. The permuted longest common prefixes then say which
   suffixes share ``length`` bytes, and their fragments' counts how often these occur.
4. A key with more than ``MAX_DISTINCT`` distinct fragments (the border of a very common
   passage, where every surrounding differs) would outgrow a shard; its windows are
   counted one by one by a 128-bit hash, which spreads them over all tasks.

A row is known by doc_id and the hash of its text: repeated rows count as repeats of
each other and get equal results. Null text is empty. A null doc_id is an id like any
other. Texts shorter than ``length`` bytes lose nothing. An empty table gives no rows.
Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from ledgerstone.llm.common import chosen, mixed, rolling, stored, text_slices

LENGTH, GRAM = 200, 32
#: Bytes of fragments that one task sorts at a time.
SHARD_BYTES = 1 << 20
MAX_DISTINCT = 4096
GAP = 255


# ---- anchors and fragments

def leftmost_least(value: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost smallest value in each run of ``width`` values."""
    best, at, span = value, np.arange(len(value), dtype=np.int32), 1
    while span < width:
        step = min(span, width - span)
        a, b = best[:-step], best[step:]
        left = a <= b
        at = np.where(left, at[:-step], at[step:])
        best = np.minimum(a, b)
        span += step
    return at


def fragments_of(data: np.ndarray, at: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(document, first byte in it, windows, key, fragment hash) of every fragment of a slice."""
    if len(data) < length:
        none = np.empty(0, np.int64)
        return none, none, none, none, none
    prefix, down = rolling(data)
    grams = mixed((prefix[gram:] - prefix[:-gram]) * down[: len(data) - gram + 1])
    anchor = leftmost_least((grams >> np.uint64(32)).astype(np.uint32), length - gram + 1)
    fits = np.zeros(len(anchor) + 1, np.int32)  # windows that stay within one document
    long_enough = at[1:] - at[:-1] >= length
    np.add.at(fits, at[:-1][long_enough], 1)
    np.add.at(fits, at[1:][long_enough] - length + 1, -1)
    window = np.flatnonzero(np.cumsum(fits)[:-1] > 0)
    if len(window) == 0:
        none = np.empty(0, np.int64)
        return none, none, none, none, none
    anchor = anchor[window]
    new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)])
    count = np.diff(np.r_[new, len(window)])
    first = window[new]
    end = first + count + length - 1
    key = grams[anchor[new]]
    whole = mixed((prefix[end] - prefix[first]) * down[first] + count.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    doc = np.searchsorted(at, first, "right") - 1
    return doc, first - at[doc], count, key.view(np.int64), whole.view(np.int64)


# ---- suffix arrays by induced sorting

def _types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the end counts as smallest."""
    n = len(t)
    differs = np.flatnonzero(np.r_[t[:-1] != t[1:], True])
    decides = differs[np.searchsorted(differs, np.arange(n))]  # the next place where neighbours differ
    rises = np.r_[t[:-1] < t[1:], False]
    return rises[decides]


def _dealt(symbols: np.ndarray, fill: np.ndarray, step: int) -> np.ndarray:
    """Places for symbols in the order given: the next free ones of their buckets."""
    order = np.argsort(symbols, kind="stable")
    ranked = symbols[order]
    group = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    size = np.diff(np.r_[group, len(ranked)])
    within = np.arange(len(ranked)) - np.repeat(group, size)
    place = np.empty(len(symbols), np.int64)
    place[order] = fill[ranked] + step * within
    fill[ranked[group]] += step * size
    return place


def _induced_by_bucket(t: np.ndarray, small: np.ndarray, lms: np.ndarray, head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """All suffixes from sorted leftmost smaller ones, a bucket at a time (small alphabets)."""
    n, k = len(t), len(head)
    sa = np.full(n, -1, np.int32)
    fill = head.copy()
    lms_symbol = t[lms]
    lms_bound = np.searchsorted(lms_symbol, np.arange(k + 1))
    larger = ~small

    def place(before: np.ndarray) -> None:
        before = before[before >= 0]
        before = before[larger[before]]
        if len(before):
            sa[_dealt(t[before], fill, 1)] = before

    place(np.array([n - 1], np.int32))
    for c in range(k):
        lo = head[c]
        while lo < fill[c]:
            lo, hi = fill[c], lo
            place(sa[hi:lo] - 1)
        if lms_bound[c] < lms_bound[c + 1]:
            place(lms[lms_bound[c] : lms_bound[c + 1]] - 1)
    larger_end, fill = fill, tail - 1

    def place_small(before: np.ndarray) -> None:
        before = before[before >= 0]
        before = before[small[before]]
        if len(before):
            sa[_dealt(t[before], fill, -1)] = before

    for c in range(k - 1, -1, -1):
        hi = tail[c] - 1
        while hi > fill[c]:
            hi, lo = fill[c], hi
            place_small(sa[hi + 1 : lo + 1][::-1] - 1)
        if head[c] < larger_end[c]:
            place_small(sa[head[c] : larger_end[c]][::-1] - 1)
    return sa


def _induced_one_by_one(t: np.ndarray, small: np.ndarray, lms: np.ndarray, head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """The same for large alphabets, where buckets hold a few suffixes each."""
    n = len(t)
    sa = np.full(n, -1, np.int64)
    symbol = t[lms]  # in order, so each bucket's ones stand together at its end
    last = np.searchsorted(symbol, symbol, "right")
    sa[tail[symbol] - (last - np.arange(len(lms)))] = lms
    sa = sa.tolist()
    # symbol of the suffix one before, if it is of the kind that is placed; -1 for none, and for empty places
    before = np.full(n + 1, -1, np.int64)
    before[1:n] = np.where(small[:-1], -1, t[:-1])
    larger = before.tolist()
    before[1:n] = np.where(small[:-1], t[:-1], -1)
    smaller = before.tolist()
    fill = head.tolist()
    c = int(t[n - 1])
    sa[fill[c]] = n - 1  # the last suffix is larger than the end and first of its bucket
    fill[c] += 1
    for j in sa:  # meets what it places further on
        c = larger[j]
        if c >= 0:
            i = fill[c]
            sa[i] = j - 1
            fill[c] = i + 1
    fill = (tail - 1).tolist()
    for j in reversed(sa):
        c = smaller[j]
        if c >= 0:
            i = fill[c]
            sa[i] = j - 1
            fill[c] = i - 1
    return np.array(sa, np.int32)


def suffix_array(t: np.ndarray, symbols: int) -> np.ndarray:
    """Start of each suffix of t in order; t holds 0 to symbols - 1, and the end counts as smallest."""
    n = len(t)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    t = t.astype(np.int32)
    small = _types(t)
    lms = np.flatnonzero(small & np.r_[False, ~small[:-1]]).astype(np.int32)
    tail = np.cumsum(np.bincount(t, minlength=symbols))
    head = np.r_[0, tail[:-1]]
    if len(lms) > 1:
        name, different = _names(t, small, lms, symbols)
        if different < len(lms):
            lms = lms[suffix_array(name, different)]
        else:
            ranked = np.empty_like(lms)
            ranked[name] = lms
            lms = ranked
    induced = _induced_by_bucket if n > 512 * symbols else _induced_one_by_one
    return induced(t, small, lms, head, tail)


def _names(t: np.ndarray, small: np.ndarray, lms: np.ndarray, symbols: int) -> tuple[np.ndarray, int]:
    """Ranks of the substrings from each leftmost smaller symbol to the next, equal ones alike, and their number.

    Symbols are compared with their types behind them, so no substring is the beginning
    of another. As many as fit a 64-bit key are compared at a time, later only among
    those that are still alike.
    """
    bits = int(2 * symbols + 1).bit_length()
    width = 64 // bits
    typed = np.zeros(len(t) + width, np.uint64)
    typed[: len(t)] = 2 * t.astype(np.uint64) + small + 1  # 0 stands behind the end
    start = lms.astype(np.int64)
    size = np.r_[start[1:] + 1, len(t)] - start
    rank = np.zeros(len(lms), np.int64)
    live, step = np.arange(len(lms)), 0
    while len(live):
        key = np.zeros(len(live), np.uint64)
        for i in range(width):
            inside = size[live] > step + i
            key = (key << np.uint64(bits)) | np.where(inside, typed[np.minimum(start[live] + step + i, len(t))], np.uint64(0))
        order = np.argsort(key, kind="stable") if step == 0 else np.lexsort((key, rank[live]))
        key, group = key[order], rank[live][order]
        new = np.r_[True, (key[1:] != key[:-1]) | (group[1:] != group[:-1])]
        at = np.flatnonzero(new)
        opened = np.r_[True, group[1:] != group[:-1]]
        base = np.maximum.accumulate(np.where(opened, np.arange(len(group)), 0))
        first = np.repeat(at, np.diff(np.r_[at, len(group)]))
        alike = np.repeat(np.diff(np.r_[at, len(group)]) > 1, np.diff(np.r_[at, len(group)]))
        rank[live[order]] = group + first - base
        live = live[order][alike]
        step += width
        live = live[size[live] > step]
    _, name = np.unique(rank, return_inverse=True)
    return name.astype(np.int32), int(name.max()) + 1


def permuted_prefixes(t: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(common prefix with the suffix before it in order, that suffix), by text position.

    Where the bytes before both suffixes agree the value is one less than that of the
    position before; only the others, whose lengths sum to n log n, are compared.
    """
    n = len(t)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    at = np.arange(n)
    carried = (at > 0) & (before > 0)
    carried[carried] = t[at[carried] - 1] == t[before[carried] - 1]
    starts = np.flatnonzero(~carried)
    padded = np.r_[t.astype(np.uint8), np.zeros(8, np.uint8)]
    eights = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, 8)).view("<u8").ravel()
    length = np.zeros(n, np.int64)
    live = starts[before[starts] >= 0]
    step = 0
    while len(live):
        x, y = live + step, before[live] + step
        inside = np.maximum(x, y) < n
        live, x, y = live[inside], x[inside], y[inside]
        differ = eights[x] ^ eights[y]
        lowest = np.bitwise_count((differ & -differ) - np.uint64(1)) >> 3  # equal bytes before the first that differs
        agree = np.where(differ == 0, 8, lowest)
        room = n - np.maximum(x, y)
        length[live] = step + np.minimum(agree, room)
        live = live[(agree == 8) & (room > 8)]
        step += 8
    origin = np.maximum.accumulate(np.where(carried, 0, at))
    return length[origin] - (at - origin), before


def repeated_windows(pieces: list[bytes], copies: list[int], length: int) -> list[tuple[list[int], list[int]]]:
    """For each piece the runs (first, end) of window starts whose string occurs at two places.

    Suffixes that share ``length`` bytes stand together in the suffix array; a piece that
    stands for several equal ones counts as often.
    """
    if not pieces:
        return []
    gap = bytes([GAP])
    t = np.frombuffer(gap.join(pieces) + gap, np.uint8)
    sa = suffix_array(t, 256)
    common, _ = permuted_prefixes(t, sa)
    group = np.cumsum(common[sa] < length)
    sizes = np.array([len(p) + 1 for p in pieces])
    counts = np.repeat(np.minimum(copies, 2), sizes)
    hit = np.empty(len(t), bool)
    hit[sa] = (np.bincount(group, counts[sa]) > 1)[group]
    out = []
    for start, size in zip((np.cumsum(sizes) - sizes).tolist(), sizes.tolist()):
        windows = hit[start : start + max(0, size - length)].astype(np.int8)
        edge = np.flatnonzero(np.diff(np.r_[0, windows, 0]))
        out.append((edge[::2].tolist(), edge[1::2].tolist()))
    return out


# ---- the Spark job

def _located(docs: DataFrame) -> DataFrame:
    return chosen(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")


def fragments(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in text_slices(batches, 2):
            doc, first, count, key, whole = fragments_of(data, at, length, gram)
            where = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, pa.int64()), pa.array(whole, pa.int64()), part.column(0).take(where), part.column(1).take(where), pa.array(first.astype(np.int32)), pa.array(count.astype(np.int32))],
                ["key", "whole", "doc_id", "text_hash", "first", "windows"],
            )

    return _located(docs).mapInArrow(cut, "key long, whole long, doc_id long, text_hash long, first int, windows int")


def _cut_out(length: int):
    """Bytes of the listed fragments of each document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text, listed = batch.column(0)[i].as_buffer(), batch.column(1)[i].values
                data = memoryview(text)
                starts, windows = listed.field("first").to_numpy(), listed.field("windows").to_numpy()
                pieces = pa.array([bytes(data[s : s + w + length - 1]) for s, w in zip(starts.tolist(), windows.tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays([listed.field("key"), listed.field("whole"), listed.field("copies"), listed.field("distinct"), pieces], ["key", "whole", "copies", "distinct", "piece"])

    return cut


def _sorted_shard(length: int):
    def run(table: pa.Table) -> pa.Table:
        names = list(zip(table.column("key").to_pylist(), table.column("whole").to_pylist()))
        copies, bytes_of = table.column("copies").to_pylist(), table.column("piece").to_pylist()
        first: dict[tuple, int] = {}
        pieces: list[bytes] = []
        counts: list[int] = []
        for name, many, piece in zip(names, copies, bytes_of):
            if name not in first:  # a repeated row brings its fragments again
                first[name] = len(pieces)
                pieces.append(piece)
                counts.append(many)
        runs = repeated_windows(pieces, counts, length)
        rows = [(key, whole, a, b) for (key, whole), i in first.items() for a, b in zip(*runs[i])]
        keys, wholes, starts, ends = zip(*rows) if rows else ((), (), (), ())
        return pa.table({"key": pa.array(keys, pa.int64()), "whole": pa.array(wholes, pa.int64()), "run": pa.array(starts, pa.int32()), "run_end": pa.array(ends, pa.int32())})

    return run


def _window_hashes(length: int):
    """128-bit hash of each window of fragments that are too many for a shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                piece = batch.column(3)[i].as_py()
                digests = [hashlib.blake2b(piece[j : j + length], digest_size=16).digest() for j in range(len(piece) - length + 1)]
                n = len(digests)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests, pa.binary()), *[batch.column(c).take(pa.array([i] * n, pa.int64())) for c in range(3)], pa.array(range(n), pa.int32())],
                    ["digest", "key", "whole", "copies", "run"],
                )

    return run


def repeated_runs(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES, max_distinct: int = MAX_DISTINCT) -> DataFrame:
    """(doc_id, text_hash, start, end): byte ranges covered by repeated windows; ranges may touch or overlap."""
    by_key = Window.partitionBy("key")
    found = stored(fragments(docs, length, gram).withColumn("n", F.count("*").over(by_key)).where("n > 1").drop("n"), "fragments")
    distinct = found.groupBy("key", "whole").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "text_hash", "first", "windows")).alias("at"))
    per_key = distinct.groupBy("key").agg(F.count("*").alias("distinct"))
    sample = stored(distinct.join(per_key, "key"), "distinct-fragments")
    size = sample.agg(F.sum(F.col("at.windows") + length)).first()[0] or 0
    shards = max(1, math.ceil(size / shard_bytes))
    listed = sample.groupBy("at.doc_id", "at.text_hash").agg(F.collect_list(F.struct("key", "whole", "copies", "distinct", "at.first", "at.windows")).alias("listed"))
    located = _located(docs)
    pieces = (
        located.join(listed, located["doc_id"].eqNullSafe(listed["doc_id"]) & (located["text_hash"] == listed["text_hash"]))
        .select(F.col("text").cast("binary").alias("text"), "listed")
        .mapInArrow(_cut_out(length), "key long, whole long, copies long, distinct long, piece binary")
    )
    pieces = stored(pieces, "pieces")
    in_shards = (
        pieces.where(F.col("distinct") <= max_distinct)
        .select(F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"), "key", "whole", "copies", "piece")
        .groupBy("shard").applyInArrow(_sorted_shard(length), "key long, whole long, run int, run_end int")
    )
    single = pieces.where(F.col("distinct") > max_distinct).select("key", "whole", "copies", "piece").dropDuplicates(["key", "whole"])
    hashed = stored(single.mapInArrow(_window_hashes(length), "digest binary, key long, whole long, copies long, run int"), "windows")
    again = hashed.groupBy("digest").agg(F.sum("copies").alias("all")).where(F.col("all") > 1).select("digest")
    one_by_one = hashed.join(again, "digest").select("key", "whole", "run", (F.col("run") + 1).alias("run_end"))
    runs = stored(in_shards.unionByName(one_by_one), "runs")
    return found.join(runs, ["key", "whole"]).select(
        "doc_id", "text_hash", (F.col("first") + F.col("run")).alias("start"), (F.col("first") + F.col("run_end") + length - 1).alias("end")
    )


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, sizes, gone, spans = [], [], [], []
        for text, starts, ends in zip(batch.column(1), batch.column(2), batch.column(3)):
            data = text.as_py()
            cover = np.zeros(len(data) + 1, np.int32)
            if starts.is_valid:
                np.add.at(cover, starts.values.to_numpy(), 1)
                np.add.at(cover, ends.values.to_numpy(), -1)
            stay = np.cumsum(cover)[:-1] == 0
            edge = np.diff(np.r_[1, stay.astype(np.int8), 1])
            kept.append(np.frombuffer(data, np.uint8)[stay].tobytes())
            sizes.append(len(data))
            gone.append(len(data) - len(kept[-1]))
            spans.append(int((edge == -1).sum()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, pa.int64()) for c in (sizes, gone, spans)], pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
        )


def deduplicated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES, max_distinct: int = MAX_DISTINCT) -> DataFrame:
    """Per row doc_id, n_bytes, n_removed, n_spans and kept, the bytes that stay (not always valid UTF-8)."""
    runs = repeated_runs(docs, length, gram, shard_bytes, max_distinct)
    per_doc = runs.distinct().groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "end")).alias("runs"))
    located = _located(docs)
    both = located.join(per_doc, located["doc_id"].eqNullSafe(per_doc["doc_id"]) & (located["text_hash"] == per_doc["text_hash"]), "left")
    return both.select(located["doc_id"], F.col("text").cast("binary").alias("text"), F.col("runs.start").alias("starts"), F.col("runs.end").alias("ends")).mapInArrow(
        _removed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def digests(docs: DataFrame) -> DataFrame:
    return deduplicated(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
