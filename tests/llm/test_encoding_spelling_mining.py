"""Encoding against the library, spelling groups and hard negatives against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerstone.llm import hard_negatives, merge_encoding, spelling
from tests.llm.conftest import TESTDATA


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(merge_encoding.vocabulary("word_bpe_49k.json"))


def encoded_by(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    text = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def test_encoding_of_a_table(spark, library):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in merge_encoding.digests(merge_encoding.decode(merge_encoding.encode(docs))).collect()}
    assert got == {r.doc_id: encoded_by(library, r.text) for r in docs.collect()}


def test_encoding_of_odd_texts(spark, documents, messy, library):
    odd = ["'''s don't WE'LL", "aaaa aaaaa aaaaaaaaaaaaaaaaa", "á ȩ́", "ΣΣ İi", "x\x1cy\x85z　​", "<|endoftext|>a<|startoftext|> <|END|>", "½ ²3", "<|endoftext|><|endoftext|>", "日本語 \U0001f600\U0001f600", "a" * 20_000]
    rows = [(i, t) for i, t in messy if i is not None] + [(100 + i, t) for i, t in enumerate(odd)]
    out = merge_encoding.decode(merge_encoding.encode(documents(rows)))
    got = Counter((r.doc_id, *tuple(r)[1:]) for r in merge_encoding.digests(out).collect())
    assert got == Counter((i, *encoded_by(library, t)) for i, t in rows)
    assert out.columns == ["doc_id", "ids", "text"]
    assert merge_encoding.encode(documents([(None, "a b")])).first().ids == library.encode("a b").ids
    assert merge_encoding.decode(merge_encoding.encode(documents(rows).where("false"))).collect() == []


def test_encoding_of_random_strings(library):
    known = merge_encoding.Chunks(merge_encoding.vocabulary("word_bpe_49k.json"))
    rng = random.Random(3)
    letters = [chr(c) for c in [*range(0x20, 0x7F), 0x1C, 0xA0, 0x2028, 0x301, 0x345, 0x3A3, 0x130, 0x3000, 0x200B, 0xB2, 0x1100, 0x1161, 0x212B]]
    texts = ["".join(rng.choice(letters) if rng.random() < 0.85 else chr(rng.randrange(0x20, 0xD800)) for _ in range(rng.randrange(14))) for _ in range(5000)]
    chunks = [known.of(t) for t in texts]
    known.learn(set().union(*chunks))
    for text, parts in zip(texts, chunks):
        assert np.frombuffer(b"".join(known[c] for c in parts), np.int32).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_latin_letters_are_split_without_the_library(library, monkeypatch):
    """Words of Latin-1 letters and printable ASCII need no call of the library's normaliser, and have its ids."""
    known = merge_encoding.Chunks(merge_encoding.vocabulary("word_bpe_49k.json"))
    rng = random.Random(5)
    letters = [*map(chr, [*range(0x21, 0x7F), *range(0xC0, 0x100)]), *"aest'sreÉéßüÿ0129"]
    called, normal = [], known.normal
    monkeypatch.setattr(known, "normal", lambda chunk: called.append(chunk) or normal(chunk))
    chunks = {"".join(rng.choices(letters, k=rng.randrange(1, 12))) for _ in range(4000)}
    known.learn(chunks)
    for chunk in chunks:
        assert np.frombuffer(known[chunk], np.int32).tolist() == library.encode(chunk, add_special_tokens=False).ids, chunk
    assert called and all(set(chunk) & {"\u00d7", "\u00f7"} for chunk in called)


def test_words_meet_the_merges_once(monkeypatch):
    """Chunks that share words, and words asked for lately when the memory is full, are not encoded again."""
    path = merge_encoding.vocabulary("word_bpe_49k.json")
    met, encoded = [], merge_encoding.Merges.encoded
    monkeypatch.setattr(merge_encoding.Merges, "encoded", lambda self, words: met.extend(words) or encoded(self, words))
    monkeypatch.setattr(merge_encoding, "CACHE_CHUNKS", 4)
    monkeypatch.setattr(merge_encoding, "CACHE_WORDS", 8)
    known = merge_encoding.Chunks(path)
    for chunks in ({"lake", "lake,"}, {"(lake)", "LAKE."}, {"lake", "hill"}, {"hill,", "lake"}):
        known.learn(chunks)
        assert all(len(known[c]) for c in chunks)
    assert sorted(met) == sorted({"lake", ",", "(", ")", ".", "hill"})
    assert len(known) + len(known.older) <= 8 and merge_encoding.remembered(path) is merge_encoding.remembered(path)


def test_vocabulary_that_one_pass_cannot_apply(tmp_path):
    import json

    vocab = {t: i for i, t in enumerate(["a", "b", "ab", "abb", "bb"])}
    model = {"vocab": vocab, "end_of_word_suffix": "", "merges": [["ab", "b"], ["a", "b"]]}
    path = tmp_path / "v.json"
    path.write_text(json.dumps({"model": model, "added_tokens": []}))
    with pytest.raises(ValueError, match="later merge"):
        merge_encoding.Merges(str(path))


def brute_words(rows, least=5):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= least}


def brute_groups(words):
    """Near words through all texts with one code point less: exact, and quick enough for some ten thousand words."""
    near, less = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            less[w[:i] + w[i + 1 :]].add((i, w))
    for short, held in less.items():
        by_place = defaultdict(list)
        for i, w in held:
            by_place[i].append(w)
            if short in words:
                near[w].add(short)
                near[short].add(w)
        for same in by_place.values():  # the same place was replaced
            for a in same:
                near[a].update(b for b in same if b != a)
    form = {}
    for w, n in words.items():
        first = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = first if first is not None and words[first] >= 5 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def test_spelling_groups_of_a_table(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet")
    words = brute_words([(r.doc_id, r.text) for r in docs.collect()])
    got = [tuple(r) for r in spelling.grouped(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    want = brute_groups(words)
    assert len(got) == len(want) > 1000 and set(got) == want
    assert any(f is not None and f != r for _, f, r, *_ in want)


def test_spelling_groups_of_made_words(spark, documents, messy):
    chain = [("colours", 700), ("colourz", 100), ("colourzz", 15), ("colouzz", 3), ("kolours", 700), ("coulors", 8), ("èlèveÈ", 30), ("èlève×", 6), ("abcdef", 5), ("bcdefg", 5)]
    rows = [(1000 + i * 7 + k, " ".join([w.upper() if k else w] * (n // 2 + k * (n % 2)))) for i, (w, n) in enumerate(chain) for k in range(2)]
    rows += messy + [(None, "straßenname " * 7)]
    want = brute_groups(brute_words(rows))
    got = [tuple(r) for r in spelling.grouped(documents(rows)).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(got) == len(want) and set(got) == want
    assert spelling.grouped(documents(rows).where("false")).collect() == []
    assert spelling.grouped(documents([(1, None), (2, "")])).collect() == []


@pytest.mark.parametrize("seed", range(2))
def test_near_words_share_a_signature(spark, seed):
    rng = random.Random(seed)
    pairs = []
    for _ in range(300):
        w = "".join(rng.choice("abcdeé") for _ in range(rng.randrange(6, 12)))
        at, c = rng.randrange(len(w)), rng.choice("abxé")
        v = rng.choice([w[:at] + c + w[at:], w[:at] + c + w[at + 1 :]])
        pairs.append((w, v))
    frame = spark.createDataFrame(pairs, "a string, b string")
    shared = frame.selectExpr("a", "b").select("a", "b", spelling.F.size(spelling.F.array_intersect(spelling.signatures(spelling.F.col("a")), spelling.signatures(spelling.F.col("b")))).alias("n"))
    assert all(r.n > 0 for r in shared.collect())


def brute_negatives(rows, positives=5, negatives=5):
    """All scores in Python integers; rows are (vec_id, vector, label)."""
    import math

    good = {}
    for i, x, label in rows:
        if i is not None and label is not None and x is not None and all(c is not None and math.isfinite(c) for c in x):
            good[i, tuple(math.floor(c * 256) for c in x), (label + 1) % 10 if i % 7 == 0 else label] = None
    good = list(good)
    out = []
    for a in good:
        if a[0] % 100:
            continue
        scored = sorted(((-sum(p * q for p, q in zip(a[1], b[1])), b) for b in good if b is not a), key=lambda s: (s[0], s[1][0]))
        for p_score, p in [(-s, b) for s, b in scored if b[2] == a[2]][:positives]:
            fits = [(-s, b) for s, b in scored if b[2] != a[2] and 80 * p_score <= -100 * s <= 100 * p_score][:negatives]
            out += [(a[0], p[0], k, b[0], p_score, s) for k, (s, b) in enumerate(fits, 1)]
    return out


def vectors(spark, rows):
    return spark.createDataFrame([(i, x, y, 1, "p", 0) for i, x, y in rows], "vec_id long, embedding array<float>, label int, row int, planes string, x int").repartition(3)


def test_hard_negatives_of_a_table(spark):
    table = spark.read.parquet(f"{TESTDATA}/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in table.collect()]
    want = brute_negatives(rows)
    for blocks in ({}, {"candidates": 37, "anchors": 2}):
        got = [tuple(r) for r in hard_negatives.mine(table, **blocks).collect()]
        assert len(got) > 20 and sorted(got) == sorted(want)


def test_hard_negatives_of_messy_rows(spark):
    rng = random.Random(5)
    rows = [(i, [rng.randrange(-8, 9) / 8 for _ in range(11)], rng.randrange(3)) for i in range(0, 500, 5)]
    rows += [(7, [1.0] * 11, None), (None, [1.0] * 11, 1), (8, None, 1), (9, [1.0] * 10 + [None], 1), (100, [float("nan")] * 11, 1), (11, [float("inf")] * 11, 0), (12, [1.0, 2.0], 1)]
    rows += [rows[0], rows[0], rows[40], (20, [300.25] * 11, 1), (21, [0.0] * 11, 0)]
    got = sorted(tuple(r) for r in hard_negatives.mine(vectors(spark, rows), candidates=16, anchors=2).collect())
    assert got == sorted(brute_negatives([r for r in rows if r[0] != 12])) and got
    assert hard_negatives.mine(vectors(spark, rows).where("false")).collect() == []
    assert hard_negatives.mine(vectors(spark, [(1, [1.0], 1), (3, [1.0], 2)])).collect() == []


def test_lookups_score_exactly():
    rng = np.random.default_rng(0)
    for size, span, kind in ((64, 150, np.int32), (13, 40_000, np.int64), (8, 1, np.int32)):
        v = rng.integers(-span, span + 1, (50, size))
        planes = int(span).bit_length() + 1
        bits = hard_negatives.packed(v, planes)
        assert (hard_negatives.unpacked(bits, size) == v).all()
        assert (hard_negatives.scores(hard_negatives.subset_sums(v[:7], np.dtype(kind)), bits) == v @ v[:7].T).all()


def test_no_table_of_words_is_broadcast(spark, documents):
    rows = [(i, "colours colourz kolours ") for i in range(40)] + [(i, "colours kolours " * 30) for i in range(40, 60)]
    groups = spelling.grouped(documents(rows))
    words = spelling.stored(spelling.vocabulary(documents(rows)), "words")
    for frame in (groups, spelling.near_pairs(words), spelling.forms(words)):
        frame.collect()
        assert "Broadcast" not in frame._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.word, r.form) for r in groups.collect()) == [("colours", None), ("colourz", "colours"), ("kolours", None)]
