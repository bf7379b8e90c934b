"""Nearest neighbours by inner product with shifted space-filling curves.

Vectors are scaled to one length by an extra component (so the largest inner product is
the smallest distance), projected on ``DIMENSIONS`` random directions, shifted, and
numbered along a Hilbert curve; ``orderings`` curves use other directions and shifts.
Spark deals each ordering into ranges of neighbouring keys (blocks of about
``block_rows`` vectors; ties are broken by a hash of the id, so equal vectors spread).
Each query meets its own block and its neighbours on both sides, as many as ``reach``
says; every block returns its best, and all blocks' best are merged and ranked by exact
inner products. Result rows come from blocks only.

A query's own block of each ordering answers with its k best. Of the other blocks'
answers what scores below the k-th best id of the fitting sample is left out, as it
cannot be among the k nearest: answers grow with the rows that can matter, not with blocks.

Directions, block borders and ``reach`` are fitted on bounded samples: at most
``SAMPLE_ROWS`` vectors and ``SAMPLE_QUERIES`` queries, those with the smallest hashes of
their rows. Borders hold at least ``RANGE_SAMPLE`` sampled rows apart; where that leaves
more than ``block_rows`` vectors between two, the range is cut into blocks of equal width,
so blocks keep their size however many rows there are. Reach is the smallest at which the
sample's recall against brute force is at least ``RECALL``, for its share of the k nearest
of all rows. Where vectors fill all dimensions alike, a curve keeps few neighbours
together and reach grows to a large part of the blocks; where they are clustered it
stays small. Every row is indexed.

Vectors that are null, zero, of another length than most of the sample, or hold a null
or non-finite component take no part; neither do rows without vec_id. Rows that repeat
both vec_id and vector are one row. A vec_id with several vectors is one candidate and one
query, with the best score of any of them; a query has no row for its own vec_id. With
fewer candidates than ``k`` all that blocks within reach hold are returned. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ledgerstone.llm.common import chosen, mixed

QUERY_EVERY, K = 20, 20
ORDERINGS, DIMENSIONS, BITS = 4, 6, 8
BLOCK_ROWS, RANGE_SAMPLE = 1024, 8
SAMPLE_ROWS, SAMPLE_QUERIES, RECALL = 20_000, 200, 0.97
SEED = 20


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each cell (a row of integers below 2**bits) along the Hilbert curve."""
    x = cells.astype(np.int64).T.copy()
    top = 1 << (bits - 1)
    q = top
    while q > 1:  # undo the turns of each level
        low = q - 1
        for i in range(len(x)):
            turned = (x[i] & q) > 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, len(x)):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > 1:
        turn ^= np.where((x[-1] & q) > 0, q - 1, 0)
        q >>= 1
    x ^= turn
    place = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for row in x:
            place = (place << np.uint64(1)) | ((row >> b) & 1).astype(np.uint64)
    return place


def by_id(scores: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scores, ids) with one column for each of the sorted ids: the best of its columns."""
    start = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    return (scores, ids) if len(start) == len(ids) else (np.maximum.reduceat(scores, start, axis=1), ids[start])


@dataclass
class Curves:
    """What is fitted: the longest length seen, directions and shifts, block borders of each ordering."""

    longest: float
    directions: np.ndarray  # ordering, dimension, component
    low: np.ndarray
    span: np.ndarray
    shift: np.ndarray
    borders: list[np.ndarray]  # the outermost keys of the sample included
    ids: np.ndarray  # sorted
    sample: np.ndarray
    splits: int = 1
    reach: int = 0

    @property
    def count(self) -> int:
        return (len(self.borders[0]) - 1) * self.splits

    def cut_off(self, ids: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray:
        """The k-th best score that other ids of the sample reach for each query; -inf where there are fewer."""
        scores = vectors @ self.sample.T
        scores[ids[:, None] == self.ids[None, :]] = -np.inf
        scores, _ = by_id(scores, self.ids)
        return -np.partition(-scores, k - 1, axis=1)[:, k - 1] if scores.shape[1] >= k else np.full(len(ids), -np.inf)

    def keys(self, ordering: int, ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        extra = np.sqrt(np.maximum(self.longest**2 - (vectors**2).sum(axis=1), 0))
        flat = np.c_[vectors, extra] @ self.directions[ordering].T
        scaled = ((flat - self.low[ordering]) / self.span[ordering]).clip(0, 1) * 0.5 + self.shift[ordering]
        place = hilbert((scaled * ((1 << BITS) - 1)).astype(np.int64), BITS)
        spare = np.uint64(62 - BITS * DIMENSIONS)
        return (place << spare) | (mixed(ids.astype(np.uint64) + np.uint64(1)) >> (np.uint64(64) - spare))

    def blocks(self, ordering: int, ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """The block of each vector: a range between borders, cut into ``splits`` of equal width."""
        keys, borders = self.keys(ordering, ids, vectors), self.borders[ordering]
        at = np.searchsorted(borders[1:-1], keys, "right")
        keys = keys.clip(borders[0], borders[-1])  # rows beyond the sample's outermost stand with them
        width = np.maximum(borders[at + 1] - borders[at], np.uint64(1)).astype(float)
        part = ((keys - borders[at]).astype(float) / width * self.splits).astype(np.int64)
        return at * self.splits + part.clip(0, self.splits - 1)


def usable(vector: str) -> Column:
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & F.col("vec_id").isNotNull() & whole & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1) if len(column) else np.empty((0, 0))


def fitted(vectors: DataFrame, rows: int, block_rows: int, orderings: int, sample_rows: int) -> Curves:
    table = vectors.orderBy(F.xxhash64("vec_id", "vector"), "vec_id", "vector").limit(sample_rows).toArrow()
    ids, x = table.column("vec_id").to_numpy(), _matrix(table.column("vector").combine_chunks())
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    random = np.random.default_rng(SEED)
    longest = float(np.sqrt((x**2).sum(axis=1).max()))
    directions = random.standard_normal((orderings, DIMENSIONS, x.shape[1] + 1))
    directions = np.stack([np.linalg.qr(d.T)[0].T if d.shape[0] <= d.shape[1] else d for d in directions])
    extra = np.sqrt(np.maximum(longest**2 - (x**2).sum(axis=1), 0))
    flat = np.einsum("nc,odc->ond", np.c_[x, extra], directions)
    low, high = flat.min(axis=1), flat.max(axis=1)
    curves = Curves(longest, directions, low, np.maximum(high - low, 1e-9), random.random((orderings, DIMENSIONS)) * 0.5, [], ids, x)
    count = max(1, min(rows // block_rows, len(ids) // RANGE_SAMPLE))
    curves.splits = max(1, round(rows / block_rows / count))
    for o in range(orderings):
        keys = np.sort(curves.keys(o, ids, x))
        curves.borders.append(np.r_[keys[np.arange(count) * len(keys) // count], keys[-1]])
    curves.reach = _reach(curves, rows)
    return curves


def _reach(curves: Curves, rows: int) -> int:
    """The fewest blocks on each side at which the sample's recall is high enough."""
    ids, x = curves.ids, curves.sample
    queries = np.flatnonzero(ids % QUERY_EVERY == 0)
    if not len(queries):
        queries = np.arange(len(ids))
    queries = queries[:: max(1, len(queries) // SAMPLE_QUERIES)][:SAMPLE_QUERIES]
    block = np.stack([curves.blocks(o, ids, x) for o in range(len(curves.borders))])
    scores = x[queries] @ x.T
    scores[ids[queries][:, None] == ids[None, :]] = -np.inf
    # the sample stands for all rows: its share of the k nearest
    k = min(max(1, round(K * len(ids) / rows)), max(1, len(ids) - 1))
    best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    away = np.abs(block[:, queries, None] - block[np.arange(len(block))[:, None, None], best[None]]).min(axis=0)
    return int(np.quantile(away, RECALL, method="higher")) if curves.count > 1 else 0


def nearest(embeddings: DataFrame, k: int = K, every: int = QUERY_EVERY, orderings: int = ORDERINGS, block_rows: int = BLOCK_ROWS, sample_rows: int = SAMPLE_ROWS, vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found, nearest first, ties to the smaller vec_id."""
    good = chosen(embeddings, "vec_id", vector).select("vec_id", F.col(vector).cast("array<double>").alias("vector")).where(usable("vector")).distinct()
    sizes = good.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    spark = embeddings.sparkSession
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    good = good.where(F.size("vector") == sizes["size"])
    curves = fitted(good, sizes["n"], block_rows, orderings, sample_rows)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each vector to its block of each ordering, and as a query to the blocks within reach."""
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                few = batch.slice(i, 1024)
                ids, x = few.column(0).to_numpy(), _matrix(few.column(1))
                row = np.arange(len(ids))
                asks = row[ids % every == 0]
                floor = np.full(len(ids), -np.inf)
                if len(asks):
                    floor[asks] = curves.cut_off(ids[asks], x[asks], k)
                    floor[asks] -= 1e-9 * np.maximum(1, np.abs(floor[asks]))  # sums may be added up in another order
                for o in range(orderings):
                    block = curves.blocks(o, ids, x)
                    around = np.arange(-curves.reach, curves.reach + 1)
                    to = (block[asks][:, None] + around).ravel()
                    who = np.repeat(asks, len(around))
                    inside = (to >= 0) & (to < curves.count)
                    least = np.where(to == block[who], -np.inf, floor[who])
                    for rows, blocks, query, above in ((row, block, False, floor), (who[inside], to[inside], True, least[inside])):
                        for j in range(0, len(rows), 4096):
                            pick = pa.array(rows[j : j + 4096])
                            n = len(pick)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(blocks[j : j + 4096].astype(np.int64) * orderings + o), pa.array(np.full(n, query)), few.column(0).take(pick), pa.array(above[j : j + 4096]), few.column(1).take(pick)],
                                ["block", "query", "vec_id", "least", "vector"],
                            )

    def best(table: pa.Table) -> pa.Table:
        query = table.column("query").to_numpy()
        ids, x = table.column("vec_id").to_numpy(), _matrix(table.column("vector").combine_chunks())
        least = table.column("least").to_numpy()
        have, want = np.flatnonzero(~query), np.flatnonzero(query)
        have = have[np.argsort(ids[have], kind="stable")]
        found: list[tuple] = []
        for i in range(0, len(want), 256) if len(have) else ():
            ask = want[i : i + 256]
            scores = x[ask] @ x[have].T
            scores[ids[ask][:, None] == ids[have][None, :]] = -np.inf
            scores, named = by_id(scores, ids[have])
            most = min(k, len(named))
            floor = np.maximum(-np.partition(-scores, most - 1, axis=1)[:, most - 1 : most], least[ask][:, None])
            r, c = np.nonzero((scores >= floor) & (scores > -np.inf))  # ties of the last stay in
            order = np.lexsort((named[c], -scores[r, c], r))
            r, c = r[order], c[order]
            place = np.arange(len(r)) - np.searchsorted(r, r)
            r, c = r[place < most], c[place < most]
            found.append((ids[ask][r], named[c], scores[r, c]))
        q, v, s = (np.concatenate([f[i] for f in found]) if found else np.empty(0) for i in range(3))
        return pa.table({"query_id": pa.array(q.astype(np.int64)), "vec_id": pa.array(v.astype(np.int64)), "score": pa.array(s.astype(float))})

    rows = good.mapInArrow(dealt, "block long, query boolean, vec_id long, least double, vector array<double>")
    found = rows.groupBy("block").applyInArrow(best, "query_id long, vec_id long, score double")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
