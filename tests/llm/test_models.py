"""Learned operators by held-out accuracy, search by recall, scans by cases."""

import numpy as np
import pytest

from ledgerstone.llm import curve_search, decontamination, licences, quality, toxicity
from tests.llm.conftest import TESTDATA

LABELS = "doc_id long, quality int, toxic int, text string"


def test_quality_holds_out_and_separates(spark):
    docs, labels = (spark.read.parquet(f"{TESTDATA}/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = quality.scored(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    good, bad = out.score[out.quality == 1].to_numpy(), out.score[out.quality == 0].to_numpy()
    assert (good[:, None] > bad[None]).mean() > 0.97
    assert (out.predicted == out.quality).mean() > 0.95


def test_quality_of_messy_rows(spark, documents, messy):
    labels = spark.createDataFrame([(4, 1, 0, "x"), (9, 0, 0, None), (None, 1, None, None), (3, None, 1, None)], LABELS)
    out = quality.scored(documents(messy), labels).collect()
    assert len(out) == len(messy) and all(0 <= r.score <= 1 for r in out)
    none = quality.scored(documents(messy), labels.where("false")).collect()
    assert {r.score for r in none} == {0.5}


def test_flattened_trees_score_as_grown():
    random = np.random.default_rng(0)
    x = random.random((2000, 5))
    y = ((x[:, 0] > 0.4) ^ (x[:, 1] > 0.7)).astype(float)
    forest = quality.grown(x[:1500], y[:1500])
    assert ((forest.scores(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95


def test_toxicity_generalises(spark):
    docs, labels = (spark.read.parquet(f"{TESTDATA}/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.graded(docs, labels.where("doc_id % 3 <> 0")).withColumnRenamed("toxic", "called").join(labels.where("doc_id % 3 = 0"), "doc_id").toPandas()
    assert out.called[out.toxic == 1].mean() > 0.75
    assert out.called[out.toxic == 0].mean() < 0.02
    assert out.severity[out.toxic == 1].mean() > out.severity[out.toxic == 0].mean() + 1


def test_toxicity_of_messy_rows(spark, documents, messy):
    docs = documents(messy)
    labels = spark.createDataFrame([(4, 1, 0, "x"), (9, 0, 0, None)], LABELS)
    assert not any(r.toxic for r in toxicity.graded(docs, labels).collect())
    kept = toxicity.clean(docs, labels)
    assert kept.columns == docs.columns and kept.count() == len(messy)
    assert toxicity.graded(docs.where("false"), labels).collect() == []


def test_cuts_stay_in_order_and_weights_are_shared():
    doc, place, grade = np.arange(90), np.repeat([0, 1, 2], 30), np.repeat([0, 1, 3], 30)
    model = toxicity.fit(doc, place, grade, np.array([5, 6, 7], np.uint64))
    assert (np.diff(model.cuts) >= 0).all() and (np.diff(model.weight) > 0).all()
    reached = model.reached(np.array([0, 1, 2]), np.array([0, 1, 2]), 3)
    assert reached[0, 0] < 0.5 < reached[1, 0] and (np.diff(reached, axis=1) <= 0).all()


def test_hilbert_neighbours_touch():
    cells = np.array(np.meshgrid(*[range(8)] * 3)).reshape(3, -1).T
    place = curve_search.hilbert(cells, 3)
    assert sorted(place.tolist()) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def exact_neighbours(ids, x, query, k=20):
    """The k best other ids of a query and their scores, best first, ties to the smaller id."""
    best = {}
    for i, s in ((i, float(max(row @ y for row in x[ids == query]))) for i, y in zip(ids.tolist(), x)):
        if i != query:
            best[i] = max(best.get(i, -np.inf), s)
    return sorted(((s, i) for i, s in best.items()), key=lambda p: (-p[0], p[1]))[:k]


@pytest.mark.parametrize("sample_rows", [20_000, 200])
def test_search_recall_and_exact_scores(spark, sample_rows):
    table = spark.read.parquet(f"{TESTDATA}/sf0.1/embeddings.parquet")
    found = curve_search.nearest(table, block_rows=100, sample_rows=sample_rows).toPandas()
    rows = table.toPandas()
    ids, x = rows.vec_id.to_numpy(), np.stack(rows.embedding.to_numpy()).astype(float)
    right = 0
    for i in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[i]
        scores[i] = -np.inf
        mine = found[found.query_id == ids[i]].sort_values("rank")
        assert len(mine) == 20
        right += len(set(ids[np.argsort(-scores)[:20]]) & set(mine.vec_id))
        assert np.allclose(mine.score, scores[np.searchsorted(ids, mine.vec_id)]) and mine.score.is_monotonic_decreasing
    assert right / (20 * (ids % 20 == 0).sum()) >= 0.9


@pytest.mark.parametrize("repeats", ["rows", "vectors", "hot id"])
def test_search_of_repeated_rows(spark, repeats):
    """Rows stored twice, one vector under many ids, and one id with a third of all rows."""
    random = np.random.default_rng(3)
    ids, x = np.arange(300), random.standard_normal((300, 8))
    if repeats == "rows":
        ids, x = np.tile(ids, 2), np.tile(x, (2, 1))
    elif repeats == "vectors":
        x[:100] = x[0]
    else:
        ids = np.r_[ids, np.full(150, 40)]
        x = np.r_[x, random.standard_normal((150, 8))]
    table = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    found = curve_search.nearest(table, block_rows=64).toPandas()
    right = 0
    for query in range(0, 300, 20):
        mine = found[found.query_id == query].sort_values("rank")
        want = exact_neighbours(ids, x, query)
        assert mine["rank"].tolist() == list(range(1, 21)) and mine.vec_id.is_unique
        right += len({i for _, i in want} & set(mine.vec_id))
        if len(want) == len({i for _, i in want} & set(mine.vec_id)):
            assert mine.vec_id.tolist() == [i for _, i in want]
    assert right >= 0.9 * 20 * 15


def test_search_of_messy_vectors(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (3, [1.0, 0.0]), (4, [1.0, 0.0]), (5, None), (6, [0.0, 0.0]), (7, [1.0, None]), (8, [float("nan"), 1.0]), (9, [1.0]), (None, [1.0, 1.0]), (10, [float("inf"), 1.0])]
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, block int, query int")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in curve_search.nearest(table).collect()}
    assert got == {(0, 1): (3, 1.0), (0, 2): (4, 1.0), (0, 3): (20, 0.5), (20, 1): (0, 0.5), (20, 2): (3, 0.5), (20, 3): (4, 0.5)}
    assert curve_search.nearest(table.where("false")).collect() == []


def test_licences_by_canonical_digest(documents, messy):
    rows = messy + [(50, "Copyright (c) 2020 A\nLicensed under the Apache Licence, version 2.0"), (51, "text\n * Released under the MIT LICENSE!\nmore"), (52, "It is not licensed under the MIT License.")]
    out = {r.doc_id: r for r in licences.scanned(documents(rows)).collect() if r.doc_id is not None}
    assert out[50].text_licence == "Apache-2.0" and out[50].n_notices == 1
    assert out[51].text_licence is None and out[51].licences == "MIT"
    assert out[52].licences == "" and out[1].n_notices == 0
    assert licences.scanned(documents(rows).where("false")).collect() == []


def test_full_licence_texts_in_two_wrappings(documents):
    import re
    import textwrap

    def wrapped(text, width):
        parts = re.split(r"\n[ \t]*\n", text)
        return "\n\n".join(p if re.search("(?i)copyright +(\\(c\\)|<)", p) else textwrap.fill(p, width, break_long_words=False, break_on_hyphens=False) for p in parts)

    texts = licences.full_texts()
    rows, names = [], []
    for name, (text, *_) in texts.items():
        for one in (text, wrapped(text, 50), "Copyright (c) 2020 A. Holder\n" + wrapped(text, 100)):
            rows.append((len(rows), one))
            names.append(name)
    rows.append((len(rows), "code\n\n" + licences.KNOWN["ISC"][0].replace("this software", "this\n# software") + "\n\nmore"))
    out = {r.doc_id: r for r in licences.scanned(documents(rows)).collect()}
    assert [out[i].text_licence for i in range(len(names))] == names
    assert out[len(names)].licences == "ISC" and out[len(names)].n_notices == 1


@pytest.fixture
def benchmark(spark):
    rows = [
        (1, "If a train travels 120 km in 3 hours then how far will it travel in 7 hours when Anna joins it and Anna pays 12 euros for the trip"),
        (2, None), (3, ""), (4, "too short to match"), (1, "If a train travels 120 km in 3 hours then how far will it travel in 7 hours when Anna joins it and Anna pays 12 euros for the trip"),
    ]
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, hash string")


def test_reparameterised_items_are_caught(documents, messy, benchmark):
    rows = messy + [
        (60, "before it. If a train travels 250 km in 4 hours then how far will it travel in 9 hours when Bob joins it and Bob pays 31 euros for the trip. After"),
        (61, "If a train travels 250 km in 4 hours then how far will it travel in 9 hours when Bob joins it and Carl pays 31 euros for the trip"),
        (62, "and if a train travels 120 km in 3 hours then how far will it travel in 7 hours when Anna joins it and Anna pays 12 euros for the trip"),
    ]
    out = {r.doc_id: r for r in decontamination.leaks(documents(rows), benchmark).collect()}
    assert set(out) == {60, 62}
    assert not out[60].exact and out[60].n_slots >= 5 and out[62].exact
    docs = documents(rows)
    kept = decontamination.clean(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 2
    assert decontamination.leaks(docs.where("false"), benchmark).collect() == []
    assert decontamination.leaks(docs, benchmark.where("false")).collect() == []
