"""Packing by exact round trip, the pipeline stage by stage, and the subpackage's own guard."""

import re
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest

from ledgerstone.llm import packing
from tests.llm.conftest import TESTDATA, brute_components, brute_lines

PACKAGE = Path(packing.__file__).parent


@pytest.fixture(scope="session")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.vocabulary())


def checked(pieces, texts, tokenizer, window=1024):
    """Every id in exactly one piece, gapless sequences, no padding."""
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(bytes(p.ids), np.uint32)
        assert len(ids) == p.length > 0
        of_doc[p.doc_id].append((p.start, p.doc_tokens, ids))
        of_sequence[p.sequence_id].append((p.offset, p.length))
    assert set(of_doc) == set(texts)
    for i, text in texts.items():
        want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        got = sorted(of_doc[i], key=lambda p: p[0])
        assert np.concatenate([p[2] for p in got]).tolist() == want
        assert [p[0] for p in got] == np.r_[0, np.cumsum([len(p[2]) for p in got])][:-1].tolist() and {p[1] for p in got} == {len(want)}
    for parts in of_sequence.values():
        parts.sort()
        total = sum(n for _, n in parts)
        assert [o for o, _ in parts] == np.r_[0, np.cumsum([n for _, n in parts])][:-1].tolist()
        assert total <= window and total & (total - 1) == 0


ODD = ["a's b'll don't", "x\n\ny z\n", " lead", "tail ", "a  b", "a\n b \n c", "ab12 cd3.4,x", "é,\nÀ...\nB", "<|endoftext|> hi", "\n", "..., ,.", "x' x's's\nit's", "日本 語,ok", "a\tb c", "word.\n\nNext"]


def test_round_trip(spark, documents, messy, tokenizer):
    texts = {i: t for i, t in messy if i not in (None, 10, 11)} | {100 + n: t for n, t in enumerate(ODD)}
    checked(packing.pack(documents(list(texts.items()))).collect(), texts, tokenizer)
    assert packing.pack(documents([(1, "x")]).where("false")).collect() == []


def test_round_trip_of_a_table(spark, tokenizer):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    pieces = packing.pack(docs)
    checked(pieces.collect(), {r.doc_id: r.text for r in docs.collect()}, tokenizer)
    rows = packing.sequences(pieces).collect()
    assert {len(r.ids) // 4 for r in rows} <= {1 << k for k in range(11)}


def test_repeated_rows_are_packed_each(documents, messy):
    pieces = packing.pack(documents(messy)).collect()
    assert sum(p.length for p in pieces if p.doc_id == 10) == 2 * next(p.doc_tokens for p in pieces if p.doc_id == 10)


def test_windows_open_are_bounded():
    packer = packing.Packer(0, 64, 4)
    for i in range(200):
        packer.add(i, np.arange(1 + i * 37 % 150, dtype=np.uint32))
        assert len(packer.open) <= 4
    packer.finish()
    used = defaultdict(int)
    for row in packer.rows:
        used[row[4]] += row[2]
    assert all(n & (n - 1) == 0 and n <= 64 for n in used.values())


def test_pipeline_stages(spark, tokenizer):
    import corpus_pipeline

    folder = f"{TESTDATA}/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        columns = docs.columns
        docs = corpus_pipeline.stored(stage(spark, docs, folder), "test-stage")
        seen[name] = docs.count()
        after = docs.collect()
        if name == "line_dedup":
            assert sorted((r.doc_id, r.text) for r in after) == sorted((i, t) for i, _, _, t in brute_lines(before))
            assert all(r.n_chars == len(r.text) for r in after)
        elif name == "ngram_join":
            assert sorted(r.doc_id for r in after) == sorted({c for _, _, c in brute_components(before)})
        elif name == "packing":
            assert {r.doc_id for r in after} == {i for i, _ in before}
            assert sum(r.length for r in after) == sum(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for _, t in before)
        if name != "packing":
            assert docs.columns == columns and seen[name] <= len(before)
    assert seen["toxicity"] >= seen["line_dedup"] >= seen["ngram_join"] >= seen["decontamination"]


@pytest.mark.parametrize("path", sorted(PACKAGE.glob("*.py")), ids=lambda p: p.name)
def test_no_unbounded_driver_work(path):
    text = path.read_text()
    banned = [r"(?<!gc)\.collect\(\)", r"\.toPandas\(", r"\.toLocalIterator\(", r"localCheckpoint", r"crossJoin", r"\.coalesce\(1\)", r"\.sample\(", r"F\.rand\("]
    assert [p for p in banned if re.search(p, text)] == []
    assert all("limit" in line for line in text.splitlines() if "toArrow" in line)
    if path.name in ("licences.py", "line_dedup.py", "decontamination.py"):  # these stay on native functions
        assert not re.search(r"mapIn|applyIn|pandas|pyarrow|udf", text)


def test_every_operator_is_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert "pipeline" in names
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14))
