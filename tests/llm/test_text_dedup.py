"""Line, near-copy, passage and byte-string deduplication against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from ledgerstone.llm import line_dedup, ngram_join, passages, suffix_dedup
from tests.llm.conftest import brute_components, brute_lines


def in_order(rows):
    return sorted(rows, key=repr)


def near_copies(seed, sizes, vocabulary=300):
    """Texts of given sizes, each followed by edited copies."""
    random.seed(seed)
    rows, n = [], 0
    for size in sizes:
        base = [f"v{random.randrange(vocabulary)}" for _ in range(size)]
        for edits in (0, 0, 1, 2, size // 40, size // 20, size // 10):
            words = list(base)
            for _ in range(edits):
                words[random.randrange(len(words))] = f"e{random.randrange(9999)}"
            rows.append((n, " ".join(words)))
            n += 1
    return rows


def test_lines_match_brute_force(documents, messy):
    got = [tuple(r) for r in line_dedup.digests(documents(messy)).collect()]
    want = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute_lines(messy)]
    assert in_order(got) == in_order(want)


def test_deduplicated_keeps_columns(documents, messy):
    docs = documents(messy)
    out = line_dedup.deduplicated(docs)
    assert out.columns == docs.columns
    assert in_order((r.doc_id, r.text or "") for r in out.collect()) == in_order((i, t) for i, _, _, t in brute_lines(messy))


@pytest.mark.parametrize("seed,sizes", [(1, (1, 3, 5, 6, 9, 20, 40)), (2, (60, 63, 66, 80, 90, 100)), (3, (130, 200, 300, 520))])
def test_components_match_brute_force(documents, seed, sizes):
    rows = near_copies(seed, sizes)
    got = [tuple(r) for r in ngram_join.linked(documents(rows)).collect()]
    assert in_order(got) == in_order(brute_components(rows))


def test_components_of_messy_rows(documents, messy):
    got = [tuple(r) for r in ngram_join.linked(documents(messy)).collect()]
    assert in_order(got) == in_order(brute_components(messy))


def test_one_document_of_each_component_stays(documents, messy):
    kept = ngram_join.representatives(documents(messy)).collect()
    wanted = {c for i, _, c in brute_components(messy) if i is not None}
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(wanted)
    assert sum(r.doc_id is None for r in kept) == 2


@pytest.mark.parametrize("function", [line_dedup.digests, ngram_join.linked, passages.near_duplicates, suffix_dedup.digests])
def test_empty_table(documents, function):
    assert function(documents([(1, "x")]).where("false")).collect() == []


@given(st.lists(st.integers(0, 60), min_size=5, max_size=400, unique=False), st.integers(0, 6))
@settings(max_examples=60, deadline=None)
def test_linked_sets_share_a_signature(values, changes):
    from ledgerstone.llm.common import mixed

    base = np.unique(mixed(np.array(values, np.uint64) + np.arange(len(values), dtype=np.uint64) * np.uint64(61)))
    other = np.unique(np.r_[base[changes:], mixed(np.arange(changes, dtype=np.uint64) + np.uint64(10**6))])
    both = len(np.intersect1d(base, other))
    if 4 * both >= 3 * (len(base) + len(other) - both) and both:
        assert set(ngram_join.signatures(base).tolist()) & set(ngram_join.signatures(other).tolist())


@given(st.lists(st.integers(0, 9), min_size=1, max_size=80), st.integers(1, 12))
@settings(max_examples=100, deadline=None)
def test_compact_windows_are_cartesian_tree_nodes(values, width):
    value = np.array(values, np.uint32)
    got = {(a, c, b) for a, c, b in zip(*[x.tolist() for x in passages.compact_windows(value, width)]) if b - a + 1 >= width}
    want = set()
    for c, own in enumerate(values):
        a = b = c
        while a and values[a - 1] > own:
            a -= 1
        while b + 1 < len(values) and values[b + 1] >= own:
            b += 1
        if own and b - a + 1 >= width:
            want.add((a, c, b))
    assert got == want


def test_repeated_passages_are_found(documents, messy):
    random.seed(4)
    text = lambda n: " ".join(f"q{random.randrange(5000)}" for _ in range(n))
    passage = text(60)
    rows = [(i, f"{text(40 + i)} {passage} {text(90 - i)}") for i in range(100, 112)] + [(i, text(200)) for i in range(200, 206)] + messy
    found = passages.near_duplicates(documents(rows)).collect()
    assert set(range(101, 112)) <= {r.doc_id for r in found if r.first_word <= 40 + r.doc_id and r.last_word >= 99 + r.doc_id}
    assert not {r.doc_id for r in found} & set(range(200, 206))
    assert {r.doc_id for r in found if r.other_id == 9} == {10}


def classes_by_document(found):
    """The passage classes that each document stands in."""
    of = {}
    for r in found:
        for i in (r.doc_id, r.other_id):
            of.setdefault(i, set()).add((r.class_doc, r.class_word))
    return of


def test_passages_of_common_sentences_are_linked(documents):
    random.seed(7)
    text = lambda n: " ".join(f"q{random.randrange(10**6)}" for _ in range(n))
    rows, pairs, free = [], [], random.sample(range(10_000), 2000)
    for _ in range(8):
        sentences = [text(16) for _ in range(4)]
        pairs.append((free.pop(), free.pop()))
        rows += [(i, f"{text(60)} {' '.join(sentences)} {text(60)}") for i in pairs[-1]]
        rows += [(free.pop(), f"{text(50)} {s} {text(50)}") for s in sentences for _ in range(40)]
    of = classes_by_document(passages.near_duplicates(documents(rows)).collect())
    assert set(of) == {i for p in pairs for i in p}
    assert all(of[a] == of[b] for a, b in pairs) and len({c for x in of.values() for c in x}) == len(pairs)


def test_edited_families_with_interleaved_ids_are_one_class(documents):
    random.seed(8)
    text = lambda n: [f"q{random.randrange(10**6)}" for _ in range(n)]
    rows, families, free = [], [], random.sample(range(1000), 120)
    for _ in range(6):
        base, ids = text(100), [free.pop() for _ in range(20)]
        families.append(ids)
        for i in ids:
            words = list(base)
            for _ in range(1):
                words[random.randrange(100)] = text(1)[0]
            rows.append((i, " ".join(text(30) + words + text(30))))
    of = classes_by_document(passages.near_duplicates(documents(rows)).collect())
    for ids in families:
        assert len({frozenset(of.get(i, ())) for i in ids}) == 1 and of[ids[0]]


@given(st.binary(min_size=1, max_size=120).map(lambda b: bytes(x % 5 for x in b)))
@settings(max_examples=100, deadline=None)
def test_suffix_array_and_prefixes(data):
    t = np.frombuffer(data, np.uint8)
    order = sorted(range(len(data)), key=lambda i: data[i:])
    assert suffix_dedup.suffix_array(t, 256).tolist() == suffix_dedup.suffix_array(t, 5).tolist() == order
    common, _ = suffix_dedup.permuted_prefixes(t, np.array(order))
    for a, b in zip(order, order[1:]):
        n = 0
        while max(a, b) + n < len(data) and data[a + n] == data[b + n]:
            n += 1
        assert common[b] == n


def test_suffix_array_of_large_shards():
    random.seed(5)
    words = [bytes(random.choices(b"abcdefgh", k=random.randint(1, 9))) for _ in range(50)]
    data = b" ".join(random.choices(words, k=40_000))
    order = suffix_dedup.suffix_array(np.frombuffer(data, np.uint8), 256)
    assert sorted(order.tolist()) == list(range(len(data)))
    step = random.sample(range(len(data) - 1), 3000)
    assert all(data[order[i] :] < data[order[i + 1] :] for i in step)


def brute_bytes(rows, length):
    count = Counter((t or "").encode()[i : i + length] for _, t in rows for i in range(len((t or "").encode()) - length + 1))
    out = []
    for i, t in rows:
        data = (t or "").encode()
        cover = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if count[data[p : p + length]] > 1:
                cover[p : p + length] = b"\1" * length
        kept = bytes(x for x, c in zip(data, cover) if not c)
        spans = sum(1 for p in range(len(data)) if cover[p] and (p == 0 or not cover[p - 1]))
        out.append((i, len(data), len(data) - len(kept), spans, kept))
    return out


@pytest.mark.parametrize("max_distinct,shard_bytes", [(4096, 1 << 20), (4096, 700), (2, 700)])
def test_repeated_bytes_match_brute_force(documents, messy, max_distinct, shard_bytes):
    random.seed(6)
    common = "".join(random.choices("abcdé ", k=70))
    rows = [(i, "".join(random.choices("abcdefghé \n", k=60)) + common[i % 7 :] + "".join(random.choices("abcdefgh", k=50))) for i in range(100, 140)]
    rows += [(i, t) for i, t in messy if i not in (9, 10)] + [(300, "ab" * 200), (301, "z" * 90)]
    out = suffix_dedup.deduplicated(documents(rows), 40, 12, shard_bytes, max_distinct)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out.collect()]
    assert in_order(got) == in_order(brute_bytes(rows, 40))
