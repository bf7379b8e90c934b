"""Grade documents for toxicity with a cumulative-link ordinal regression.

A text is the set of its hashed words and word beginnings (3 to 7 bytes), so inflected
and compounded forms of a term share a feature. From a bounded sample of labelled rows
(at most ``sample_rows``, those with the smallest hashes of doc_id) Spark counts, per
feature, the toxic and the clean documents that hold it; the ``FEATURES`` with the
strongest link to toxic ones enter the model. That table and the sample's rows over it
are all that the driver sees, and both have fixed bounds.

Severity has four grades. Grade 0 is a clean document. A toxic one has grade 1, 2 or 3
by how many marked features it holds, cut at the sample's terciles. One weight vector
serves all grades: P(severity >= g) = sigmoid(w x - cut_g) with ordered cuts. The result
is the expected severity, the sum of the three probabilities, and a document is toxic
where P(severity >= 1) is at least ``THRESHOLD``.

Null or empty text has no features and is graded from the cuts alone, but never called
toxic. Without toxic labels nothing is. Rows without label teach nothing; repeated rows
are graded alike. An empty table gives no rows. Other columns are not read by ``graded``
and kept by ``clean``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerstone.llm.common import chosen, labelled, mixed, rolling, text_slices, word_spans

SAMPLE_ROWS = 20_000
FEATURES = 4096
BEGINNINGS = (3, 4, 5, 6, 7)
#: A feature is a candidate if at least so many toxic documents hold it, at least such a share of its holders
#: is toxic, and its log-odds ratio is so many standard errors.
LEAST_DOCUMENTS, LEAST_SHARE, LEAST_Z = 3, 0.5, 3.0
THRESHOLD = 0.5
GRADES = 3
STEPS, RATE, SHRINK = 600, 0.1, 1e-6

_apart = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) of every word and word beginning, repeated ones too."""
    first, end, doc = word_spans(data, at, _apart)
    prefix, down = rolling(data, fold=True)
    base = prefix[first], down[first]
    docs, found = [doc], [mixed((prefix[end] - base[0]) * base[1])]
    for n in BEGINNINGS:
        longer = first + n < end
        docs.append(doc[longer])
        found.append(mixed((prefix[first[longer] + n] - base[0][longer]) * base[1][longer] + np.uint64(n)))
    return np.concatenate(docs), np.concatenate(found)


@dataclass
class Model:
    known: np.ndarray  # sorted features
    weight: np.ndarray
    cuts: np.ndarray

    def held(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, position in known) of the model's features, each once a document."""
        doc, found = features(data, at)
        if len(self.known) == 0:
            return doc[:0], doc[:0]
        place = np.minimum(np.searchsorted(self.known, found), len(self.known) - 1)
        hit = self.known[place] == found
        pair = np.unique(doc[hit].astype(np.int64) * len(self.known) + place[hit])
        return pair // len(self.known), pair % len(self.known)

    def reached(self, doc: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
        """P(severity >= 1, 2, 3), a row a document."""
        x = np.bincount(doc, self.weight[place], n)
        return 1 / (1 + np.exp(-np.clip(x[:, None] - self.cuts, -60, 60)))


def fit(doc: np.ndarray, place: np.ndarray, grade: np.ndarray, known: np.ndarray) -> Model:
    """Full-batch gradient steps (Adam) on the cumulative-link likelihood; cuts stay in order."""
    n, k = len(grade), len(known)
    share = np.array([(grade >= g).mean() if n else 0 for g in range(1, GRADES + 1)]).clip(1e-6, 1 - 1e-6)
    cuts = np.maximum.accumulate(np.log((1 - share) / share) + 1e-3 * np.arange(GRADES))
    weight = np.zeros(k)
    if k == 0 or not (grade > 0).any():
        return Model(known, weight, cuts)
    both = np.r_[weight, cuts]
    mean, spread = np.zeros(k + GRADES), np.zeros(k + GRADES)
    row = np.arange(n)
    for step in range(1, STEPS + 1):
        weight, cuts = both[:k], both[k:]
        x = np.bincount(doc, weight[place], n)
        s = 1 / (1 + np.exp(-np.clip(x[:, None] - cuts, -60, 60)))
        slope = s * (1 - s)
        upper = np.c_[np.ones(n), s][row, grade]  # P(severity >= grade)
        lower = np.c_[s, np.zeros(n)][row, grade]  # P(severity > grade)
        chance = np.maximum(upper - lower, 1e-9)
        d_upper = np.c_[np.zeros(n), slope][row, grade] / chance / n
        d_lower = np.c_[slope, np.zeros(n)][row, grade] / chance / n
        down = np.bincount(place, (d_lower - d_upper)[doc], k) + SHRINK * weight
        down_cuts = np.bincount(grade, d_upper, GRADES + 1)[1:] - np.bincount(grade, d_lower, GRADES + 1)[:-1]
        gradient = np.r_[down, down_cuts]
        mean = 0.9 * mean + 0.1 * gradient
        spread = 0.999 * spread + 0.001 * gradient**2
        both = both - RATE * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-9)
        both[k:] = np.maximum.accumulate(both[k:])
    weight, cuts = both[:k], both[k:]
    return Model(known, weight, cuts)


def fitted(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, most: int = FEATURES) -> Model:
    sample = labelled(docs, labels, "toxic", sample_rows)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in text_slices(batches):
            doc, found = features(data, at)
            order = np.lexsort((found, doc))
            doc, found = doc[order], found[order]
            new = np.r_[True, (doc[1:] != doc[:-1]) | (found[1:] != found[:-1])][: len(doc)]
            yield pa.RecordBatch.from_arrays([pa.array(found[new].view(np.int64)), part.column(2).take(pa.array(doc[new]))], ["feature", "label"])

    toxic = F.sum((F.col("label") > 0).cast("long"))
    total = sample.agg(toxic.alias("toxic"), F.count("*").alias("all")).first()
    sick, well = total["toxic"] or 0, (total["all"] or 0) - (total["toxic"] or 0)
    count = sample.mapInArrow(listed, "feature long, label int").groupBy("feature").agg(toxic.alias("a"), F.count("*").alias("c")).where((F.col("a") >= LEAST_DOCUMENTS) & (F.col("a") >= LEAST_SHARE * F.col("c")))
    a, b = F.col("a") + 0.5, F.col("c") - F.col("a") + 0.5
    rest_a, rest_b = F.lit(sick + 0.5) - F.col("a"), F.lit(well + 0.5) - (F.col("c") - F.col("a"))
    z = (F.log(a * rest_b) - F.log(b * rest_a)) / F.sqrt(1 / a + 1 / b + 1 / rest_a + 1 / rest_b)
    top = count.withColumn("z", z).where(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "feature").limit(most).select("feature").toArrow()
    known = np.sort(top.column("feature").to_numpy().view(np.uint64))
    blank = Model(known, np.zeros(len(known)), np.zeros(GRADES))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in text_slices(batches):
            doc, place = blank.held(data, at)
            bound = np.searchsorted(doc, np.arange(len(at)))
            held = pa.ListArray.from_arrays(pa.array(bound.astype(np.int32)), pa.array(place.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), held], ["doc_id", "label", "held"])

    rows = sample.mapInArrow(measured, "doc_id long, label int, held array<int>").limit(2 * sample_rows).toArrow().sort_by("doc_id")
    held = rows.column("held").combine_chunks()
    count_of = held.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    label = rows.column("label").to_numpy()
    return fit(np.repeat(np.arange(len(label)), count_of), held.flatten().to_numpy().astype(np.int64), graded_labels(label, count_of), known)


def graded_labels(label: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Ordered grades of labelled documents: 0, or by tercile of the number of marked features."""
    bad = label > 0
    grade = np.zeros(len(label), np.int64)
    if bad.any():
        grade[bad] = 1 + np.searchsorted(np.quantile(held[bad], [1 / 3, 2 / 3]), held[bad], "right")
    return grade


def graded(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row doc_id, severity (expected grade), grade (most probable) and toxic."""
    model = fitted(docs, labels, sample_rows)
    return chosen(docs, "doc_id", "text").mapInArrow(_grader(model), "doc_id long, severity double, grade int, toxic boolean")


def _grader(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in text_slices(batches):
            severity, grade, toxic = judged(model, data, at)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(severity), pa.array(grade), pa.array(toxic)], ["doc_id", "severity", "grade", "toxic"])

    return run


def judged(model: Model, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    doc, place = model.held(data, at)
    n = len(at) - 1
    reached = model.reached(doc, place, n)
    chance = np.c_[np.ones(n), reached] - np.c_[reached, np.zeros(n)]
    marked = np.bincount(doc, minlength=n) > 0
    return reached.sum(axis=1), chance.argmax(axis=1).astype(np.int32), (reached[:, 0] >= THRESHOLD) & marked


def clean(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows that are not toxic, whole."""
    model = fitted(docs, labels, sample_rows)
    names = docs.columns
    text = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in text_slices(batches, text):
            yield part.filter(pa.array(~judged(model, data, at)[2]))

    return docs.mapInArrow(run, docs.schema)
