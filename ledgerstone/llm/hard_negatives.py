"""Hard negatives for contrastive training, scored exactly with subset-sum tables.

Components become integers and a candidate becomes bit planes: bit b of eight
neighbouring dimensions is one byte. For an anchor and eight dimensions a table of 256
entries holds the sum of each subset of the anchor's components (the method of Four
Russians), so a plane's byte looks up what these dimensions add, planes are shifted by
their weight and added, the sign's plane subtracted: the exact integer inner product.

Anchors are scored against all rows in cells, a block of candidates with a block of
anchors: two joins on the cell, first with rows of the anchor's label for its positives,
then with all others for the negatives inside each positive's window. Of a cell only each
anchor's first few remain, so the merge is small. Blocks are dealt by a hash of distinct
rows, so neither a frequent label nor copies make a large one.

Rows with a null id, label or vector, or a null or non-finite component take no part, nor
do vectors of another length than most. Rows repeated in full are one row; other rows
with one vec_id are rows of their own, ordered by a hash of their content in ties. A
window of a negative positive score is empty by its definition. Anchors without positives
or negatives give no rows, nor does an empty table. Scores are 64-bit integers and wrap
beyond them. Columns other than the three named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ledgerstone.llm.common import chosen, stored

ANCHOR_EVERY, POSITIVES, NEGATIVES, LEAST_SHARE = 100, 5, 5, 80
SCALE, MOVE_LABEL_EVERY, LABELS = 256, 7, 10
#: Rows of a cell: candidates and anchors.
CANDIDATES, ANCHORS = 8192, 2048
#: Anchors whose tables a task holds at a time.
AT_ONCE = 64


def integers(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, label, v): rows that take part, their labels as they count, components as integers."""
    x = F.col(vector).cast("array<double>")
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = chosen(embeddings, "vec_id", "label", vector).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull()).where(whole)
    label = F.when(F.col("vec_id") % MOVE_LABEL_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return rows.select(F.col("vec_id").cast("long"), label.cast("long").alias("label"), F.transform(x, lambda c: F.floor(c * SCALE)).alias("v"))


def packed(v: np.ndarray, planes: int) -> np.ndarray:
    """Bit planes of rows of integers: bytes [row, plane, eight dimensions]; the last plane is the sign's."""
    bits = (v[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")


def unpacked(data: np.ndarray, size: int) -> np.ndarray:
    """The integers of bit planes."""
    planes = data.shape[1]
    weight = np.left_shift(np.int64(1), np.arange(planes))
    weight[-1] = -weight[-1]
    return (np.unpackbits(data, axis=2, count=size, bitorder="little").astype(np.int64) * weight[None, :, None]).sum(axis=1)


def subset_sums(v: np.ndarray, kind: np.dtype) -> np.ndarray:
    """Tables [eight dimensions, subset, anchor]: for each anchor the sum of each subset of eight components."""
    groups = -(-v.shape[1] // 8)
    padded = np.zeros((len(v), groups * 8), np.int64)
    padded[:, : v.shape[1]] = v
    sums = np.zeros((groups, 256, len(v)), kind)
    for bit in range(8):  # a subset with this bit is one without it plus the component
        sums[:, 1 << bit : 2 << bit] = sums[:, : 1 << bit] + padded.reshape(len(v), groups, 8)[:, :, bit].T[:, None, :].astype(kind)
    return sums


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Exact inner products [candidate, anchor] by lookups, shifts and additions."""
    total = np.zeros((len(planes), tables.shape[2]), tables.dtype)
    for b in range(planes.shape[1]):
        plane = tables[0][planes[:, b, 0]]
        for g in range(1, planes.shape[2]):
            plane += tables[g][planes[:, b, g]]
        plane <<= b
        total = total - plane if b == planes.shape[1] - 1 else total + plane
    return total


def _first(score: np.ndarray, among: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` highest scores among the given ascending places, ties to the smaller place."""
    if len(among) > count:
        least = -np.partition(-score[among], count - 1)[count - 1]
        among = among[score[among] >= least]
    return among[np.argsort(-score[among], kind="stable")][:count]


class Cell:
    """Candidates of one cell, in the order that ties take, and its anchors."""

    def __init__(self, candidates: pa.Table, anchors: pa.Table, size: int, planes: int, kind: np.dtype):
        def numbers(table: pa.Table, name: str) -> np.ndarray:
            return table.column(name).to_numpy()

        def bits(table: pa.Table) -> np.ndarray:
            data = b"".join(table.column("planes").to_pylist())
            return np.frombuffer(data, np.uint8).reshape(table.num_rows, planes, -1 if table.num_rows else 1)

        order = np.lexsort((numbers(candidates, "row"), numbers(candidates, "vec_id")))
        self.ids, self.rows, self.labels = (numbers(candidates, n)[order] for n in ("vec_id", "row", "label"))
        self.planes = bits(candidates)[order]
        self.anchors, self.anchor_rows, self.anchor_labels = (numbers(anchors, n) for n in ("vec_id", "row", "label"))
        self.v = unpacked(bits(anchors), size) if anchors.num_rows else np.empty((0, size), np.int64)
        self.kind = kind

    def scored(self, anchors: np.ndarray, among: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Each of the anchors with its scores of the candidates at the given places."""
        planes = self.planes[among]
        for i in range(0, len(anchors), AT_ONCE):
            few = anchors[i : i + AT_ONCE]
            found = scores(subset_sums(self.v[few], self.kind), planes).T.astype(np.int64)
            yield from zip(few.tolist(), found)

    def positives(self, count: int) -> Iterator[tuple[int, int, int]]:
        """(anchor, candidate, score) of the first ``count`` other rows with an anchor's label."""
        for label in np.unique(self.anchor_labels):
            among = np.flatnonzero(self.labels == label)
            if len(among):
                for a, score in self.scored(np.flatnonzero(self.anchor_labels == label), among):
                    other = np.flatnonzero((self.ids[among] != self.anchors[a]) | (self.rows[among] != self.anchor_rows[a]))
                    for c in _first(score, other, count).tolist():
                        yield a, int(among[c]), int(score[c])

    def negatives(self, windows: list[list[dict]], count: int, share: int) -> Iterator[tuple[int, dict, int, int]]:
        """(anchor, positive, candidate, score) of the first ``count`` rows of other labels in each positive's window."""
        for a, score in self.scored(np.arange(len(self.anchors)), np.arange(len(self.ids))):
            tops = [p["score"] for p in windows[a]]
            held = np.flatnonzero((self.labels != self.anchor_labels[a]) & (score <= max(tops)) & (100 * score >= share * min(tops)))
            for p in windows[a]:
                inside = held[(score[held] <= p["score"]) & (100 * score[held] >= share * p["score"])]
                for c in _first(score, inside, count).tolist():
                    yield a, p, c, int(score[c])


def _place(frame: DataFrame, keys: list[Column], score: str, ident: str, row: str, most: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), ident, row)
    return frame.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine(
    embeddings: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, least_share: int = LEAST_SHARE, every: int = ANCHOR_EVERY, candidates: int = CANDIDATES, anchors: int = ANCHORS, vector: str = "embedding"
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), a row per negative found."""
    empty = embeddings.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    rows = integers(embeddings, vector)
    bound = F.max(F.array_max(F.transform("v", lambda c: F.when(c < 0, -c - 1).otherwise(c))))
    shape = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n"), bound.alias("bound")).orderBy(F.desc("n"), "size").first()
    if shape is None or shape["size"] == 0:
        return empty
    size, planes = shape["size"], int(shape["bound"]).bit_length() + 1
    largest = size << (2 * planes)  # no partial sum of tables and planes goes beyond
    kind = np.dtype(np.int32 if largest < 1 << 31 else np.int64)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                few = batch.slice(i, 4096)
                v = few.column(2).flatten().to_numpy().reshape(few.num_rows, size)
                yield pa.RecordBatch.from_arrays([few.column(0), few.column(1), pa.array([r.tobytes() for r in packed(v, planes)], pa.binary())], ["vec_id", "label", "planes"])

    whole = rows.where(F.size("v") == size).mapInArrow(pack, "vec_id long, label long, planes binary").distinct()
    whole = stored(whole.withColumn("row", F.xxhash64("vec_id", "label", "planes")), "planes")
    is_anchor = F.col("vec_id") % every == 0
    counts = whole.agg(F.count("*").alias("rows"), F.count_if(is_anchor).alias("anchors")).first()
    if not counts["anchors"]:
        return empty
    across, down = -(-counts["rows"] // candidates), -(-counts["anchors"] // anchors)
    # each candidate meets every block of anchors, each anchor every block of candidates
    have = whole.withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(down - 1)))).withColumn("x", F.pmod("row", F.lit(across)).cast("int"))
    ask = whole.where(is_anchor)

    def cells(asking: DataFrame) -> DataFrame:
        return asking.withColumn("x", F.explode(F.sequence(F.lit(0), F.lit(across - 1)))).withColumn("y", F.pmod(F.xxhash64("row"), F.lit(down)).cast("int"))

    def first_pass(left: pa.Table, right: pa.Table) -> pa.Table:
        cell = Cell(left, right, size, planes, kind)
        found = np.array(list(cell.positives(positives)), np.int64).reshape(-1, 3)
        a, c = found[:, 0], found[:, 1]
        return pa.table({"anchor_row": cell.anchor_rows[a], "anchor_id": cell.anchors[a], "id": cell.ids[c], "row": cell.rows[c], "score": found[:, 2]})

    def second_pass(left: pa.Table, right: pa.Table) -> pa.Table:
        cell = Cell(left, right, size, planes, kind)
        windows = right.column("positives").to_pylist()
        found = [(cell.anchors[a], cell.anchor_rows[a], p["id"], p["row"], p["score"], cell.ids[c], cell.rows[c], s) for a, p, c, s in cell.negatives(windows, negatives, least_share)]
        names = ["anchor_id", "anchor_row", "positive_id", "positive_row", "positive_score", "negative_id", "negative_row", "negative_score"]
        return pa.table({n: pa.array([f[i] for f in found], pa.int64()) for i, n in enumerate(names)})

    def met(asking: DataFrame, function, schema: str) -> DataFrame:
        return have.groupBy("x", "y").cogroup(cells(asking).groupBy("x", "y")).applyInArrow(function, schema)

    near = met(ask, first_pass, "anchor_row long, anchor_id long, id long, row long, score long")
    near = _place(near, ["anchor_row", "anchor_id"], "score", "id", "row", positives)
    windows = near.groupBy("anchor_row", "anchor_id").agg(F.collect_list(F.struct("id", "row", "score")).alias("positives"))
    asking = ask.join(windows, (ask["row"] == windows["anchor_row"]) & (ask["vec_id"] == windows["anchor_id"])).select("vec_id", "label", "planes", "row", "positives")
    hard = met(stored(asking, "windows"), second_pass, "anchor_id long, anchor_row long, positive_id long, positive_row long, positive_score long, negative_id long, negative_row long, negative_score long")
    keys = ["anchor_id", "anchor_row", "positive_id", "positive_row", "positive_score"]
    return _place(hard, keys, "negative_score", "negative_id", "negative_row", negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
