"""Score documents for quality with histogram gradient-boosted trees over text statistics.

Statistics are counted in numpy, a slice of text at a time. Trees are grown level by
level on binned statistics (logistic loss, second-order gains) from a bounded sample of
labelled rows: at most ``sample_rows`` with the smallest hashes of doc_id, which is the
only part of the job that the driver sees (20,000 rows of some 25 numbers). The trees
become flat arrays (statistic, threshold, children, value), and tasks walk all rows of a
slice through them at once.

Rows whose crc32(doc_id) mod 5 is 0 are held out: their labels are never read. Nothing
but the text enters a score. Null or empty text has all statistics 0 and is scored as
such. Without labels, or with labels of one kind, every score is the share of label 1 in
the sample (0.5 without any). Repeated rows are scored alike; of repeated labels each
counts. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerstone.llm.common import chosen, crc_of, labelled, mixed, text_slices, words

SAMPLE_ROWS = 20_000
HELD_OUT_OF = 5
THRESHOLD = 0.3
BINS, TREES, DEPTH, RATE, SHRINK, LEAST_ROWS = 64, 80, 4, 0.15, 1.0, 10

# Kinds of bytes: every byte has one.
KINDS = ("lower", "upper", "digit", "space", "feed", "bar", "shout", "stop", "symbol", "quote", "wide")
_kind = np.full(256, KINDS.index("wide"), np.uint8)
for _name, _bytes in {
    "lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "space": b" \t\x0b\x0c\r",
    "feed": b"\n", "bar": b"|", "shout": b"!?", "stop": b".,;:", "quote": b"'\"()[]{}<>-_/\\",
}.items():
    _kind[list(_bytes)] = KINDS.index(_name)
_kind[[b for b in range(128) if _kind[b] == KINDS.index("wide")]] = KINDS.index("symbol")

STATISTICS = (
    *(f"share_{k}" for k in KINDS), "log_bytes", "log_words", "word_bytes", "long_words", "short_words", "distinct_words", "same_as_before",
    "distinct_pairs", "distinct_triples", "words_a_line", "distinct_lines", "words_ending_in_marks",
)


def _per_document(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc, values, n)


def distinct_counts(doc: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Number of different values of each document."""
    order = np.lexsort((value, doc))
    d, v = doc[order], value[order]
    new = np.r_[True, (d[1:] != d[:-1]) | (v[1:] != v[:-1])] if len(d) else np.empty(0, bool)
    return np.bincount(d[new], minlength=n)


def statistics(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of STATISTICS for each document."""
    n = len(at) - 1
    size = np.diff(at)
    kind = _kind[data]
    columns = []
    for k in range(len(KINDS)):
        upto = np.r_[0, np.cumsum(kind == k)]
        columns.append((upto[at[1:]] - upto[at[:-1]]) / np.maximum(size, 1))
    word, first, end, doc = words(data, at)
    count = np.bincount(doc, minlength=n)
    some = np.maximum(count, 1)
    length = end - first
    inner = doc[1:] == doc[:-1]
    pair = mixed(word[1:] + word[:-1] * np.uint64(3))[inner]
    deep = inner[1:] & inner[:-1]
    triple = mixed(word[2:] + word[1:-1] * np.uint64(3) + word[:-2] * np.uint64(7))[deep] if len(word) > 2 else word[:0]
    feeds = np.flatnonzero(data == 10)
    line_start = np.union1d(feeds + 1, at[:-1])
    line_doc = np.searchsorted(at, line_start, "right") - 1
    alike = np.searchsorted(first, line_start)  # lines are compared by the sum of their words
    words_in = np.searchsorted(first, np.r_[line_start[1:], len(data)]) - alike
    sums = np.r_[np.uint64(0), np.cumsum(word, dtype=np.uint64)]
    line_hash = sums[alike + words_in] - sums[alike]
    lines = np.maximum(np.bincount(line_doc, minlength=n)[:n], 1)
    kept = line_doc < n
    columns += [
        np.log1p(size), np.log1p(count),
        _per_document(length, doc, n) / some, _per_document(length > 12, doc, n) / some, _per_document(length <= 3, doc, n) / some,
        distinct_counts(doc, word, n) / some,
        _per_document(word[1:][inner] == word[:-1][inner], doc[1:][inner], n) / some,
        distinct_counts(doc[1:][inner], pair, n) / np.maximum(count - 1, 1),
        distinct_counts(doc[2:][deep], triple, n) / np.maximum(count - 2, 1) if len(word) > 2 else np.zeros(n),
        count / lines,
        distinct_counts(line_doc[kept], line_hash[kept], n) / lines,
        _per_document(np.isin(kind[end - 1], [KINDS.index("shout"), KINDS.index("symbol"), KINDS.index("bar")]), doc, n) / some,
    ]
    return np.stack(columns, axis=1)


@dataclass
class Forest:
    """Trees as flat arrays; a leaf is its own child. All trees start at ``root``."""

    statistic: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    root: np.ndarray
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        row = np.arange(len(x))
        for root in self.root:
            node = np.full(len(x), root)
            for _ in range(DEPTH):
                down = x[row, self.statistic[node]] <= self.threshold[node]
                node = np.where(down, self.left[node], self.right[node])
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def grown(x: np.ndarray, y: np.ndarray) -> Forest:
    """Boost trees on a sample; each level takes, for every node, the split with the largest gain over all bins."""
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share))) if len(y) else 0.0
    nodes: list[list] = [[] for _ in range(5)]  # statistic, threshold, left, right, value
    roots: list[int] = []

    def node() -> int:
        i = len(nodes[0])
        for column, initial in zip(nodes, (0, np.inf, i, i, 0.0)):
            column.append(initial)
        return i

    if 0 < y.sum() < len(y):
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
        total = np.full(len(y), base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-total))
            gradient, curve = p - y, p * (1 - p)
            at = np.full(len(y), root := node())
            roots.append(root)
            level = [root]
            for _ in range(DEPTH):
                place = {i: k for k, i in enumerate(level)}
                local = np.array([place.get(i, -1) for i in range(root, len(nodes[0]))])[at - root]
                live = local >= 0
                best: dict[int, tuple] = {}
                for f, e in enumerate(edges):
                    cell = local[live] * BINS + binned[live, f]
                    sums = [np.bincount(cell, w, len(level) * BINS).reshape(-1, BINS) for w in (gradient[live], curve[live], np.ones(live.sum()))]
                    g, h, c = (s.cumsum(axis=1) for s in sums)
                    gain = g**2 / (h + SHRINK) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + SHRINK) - g[:, -1:] ** 2 / (h[:, -1:] + SHRINK)
                    gain[(c < LEAST_ROWS) | (c[:, -1:] - c < LEAST_ROWS)] = 0
                    gain[:, len(e) :] = 0
                    for k, cut in enumerate(gain.argmax(axis=1)):
                        if gain[k, cut] > best.get(k, (1e-6,))[0]:
                            best[k] = (gain[k, cut], f, cut)
                level_now, level = level, []
                for k, (_, f, cut) in best.items():
                    i = level_now[k]
                    left, right = node(), node()
                    nodes[0][i], nodes[1][i], nodes[2][i], nodes[3][i] = f, edges[f][cut], left, right
                    here = at == i
                    at[here] = np.where(binned[here, f] <= cut, left, right)
                    level += [left, right]
                if not level:
                    break
            ids, leaf = np.unique(at, return_inverse=True)
            step = -RATE * np.bincount(leaf, gradient) / (np.bincount(leaf, curve) + SHRINK)
            for i, v in zip(ids, step):
                nodes[4][i] = v
            total += step[leaf]
    kinds = (np.int64, float, np.int64, np.int64, float)
    return Forest(*[np.array(c, k) for c, k in zip(nodes, kinds)], np.array(roots, np.int64), base)


def fitted(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Forest:
    learnable = labels.where(crc_of(F.col("doc_id")) % HELD_OUT_OF != 0)
    names = [f"x{i}" for i in range(len(STATISTICS))]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in text_slices(batches):
            x = statistics(data, at)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), *[pa.array(x[:, i]) for i in range(x.shape[1])]], ["doc_id", "label", *names])

    sample = labelled(docs, learnable, "quality", sample_rows).mapInArrow(measured, "doc_id long, label int, " + ", ".join(f"{c} double" for c in names))
    rows = sample.limit(2 * sample_rows).toArrow()  # repeated rows may double a sample, not more
    x = np.stack([rows.column(c).to_numpy() for c in names], axis=1)
    order = np.lexsort((*x.T, rows.column("doc_id").to_numpy()))
    return grown(x[order], rows.column("label").to_numpy()[order].astype(float))


def scored(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row doc_id, held_out, score and predicted."""
    forest = fitted(docs, labels, sample_rows)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in text_slices(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(forest.scores(statistics(data, at)))], ["doc_id", "score"])

    scores = chosen(docs, "doc_id", "text").mapInArrow(score, "doc_id long, score double")
    return scores.select("doc_id", (crc_of(F.col("doc_id")) % HELD_OUT_OF == 0).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
