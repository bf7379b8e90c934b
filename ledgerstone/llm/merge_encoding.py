"""Byte-pair encoding with an index of pair occurrences, and decoding.

The new words of a slice of a partition are laid out in one row of symbols. An index maps
each mergeable pair, by its rank, to all positions where it stands. Active ranks are
applied in ascending order: every occurrence is merged, and the pairs that the merged
symbol forms with its neighbours enter the lists of their own ranks. As no merge can
bring back a pair of a smaller rank (checked when a vocabulary is read), one pass over
the ranks gives each word the ids that it has on its own.

Words are what the vocabulary's own normaliser and splitting rule make of a chunk
between white space. No rule looks across white space, so chunks are looked up whole; a
bounded number of chunks and of words is remembered, by all tasks of one worker. Strings of special tokens in a text are those tokens, as
in the library with its default settings.

Nothing is shuffled and memory is one slice of text, its ids and the bounded memory of
chunks and words, so a task lost with its executor is simply run again. Null and empty text have no
ids and decode to an empty text. Repeated rows and null ids give a row each; an empty
table gives none. Columns other than the ones named are not read.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ledgerstone.llm.common import chosen, text_slices
from ledgerstone.llm.packing import vocabulary

#: Chunks between white space whose ids a worker remembers; beyond them the oldest half is dropped.
CACHE_CHUNKS = 400_000
#: Words whose ids it remembers besides, so that chunks that share them meet the merges once.
CACHE_WORDS = 200_000
#: Ids that are decoded at a time; one longer text is decoded alone.
DECODE_IDS = 1 << 20
#: Marks in a row of symbols: between words, and where a merge took the symbol.
GAP, TAKEN = -1, -2


class Merges:
    """Merge rules of a vocabulary: by pair its rank and what it makes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        model = parts["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        self.specials = {t["content"]: t["id"] for t in parts["added_tokens"]}
        self.tokens = [""] * (max([*self.ids.values(), *self.specials.values()]) + 1)
        for token, i in [*self.ids.items(), *self.specials.items()]:
            self.tokens[i] = token
        self.rules: list[tuple[int, int, int]] = []
        made_by: dict[int, int] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            rule = (self.ids[a], self.ids[b], self.ids[a + b])
            self.rules.append(rule)
            if made_by.setdefault(rule[2], r) != r:
                raise ValueError(f"{a + b!r} is made by two merges; ranks cannot be applied in one pass")
        if any(made_by.get(part, -1) > r for r, rule in enumerate(self.rules) for part in rule[:2]):
            raise ValueError("a merge uses a token that a later merge makes; ranks cannot be applied in one pass")
        keys = np.array([(a << 32) | b for a, b, _ in self.rules], np.int64)
        self.pair_ranks = np.argsort(keys)
        self.pairs = keys[self.pair_ranks]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, -1 where no rule joins them."""
        key = (left.astype(np.int64) << 32) | (right.astype(np.int64) & 0xFFFFFFFF)
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.pair_ranks[at], -1)

    def encoded(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word, all words merged together through the pair occurrence index."""
        row: list[int] = [GAP]
        for word in words:
            row += [self.ids[c] for c in word[:-1]]
            row.append(self.ids[word[-1] + self.end])
            row.append(GAP)  # no rule holds it, so no pair reaches the next word
        symbol = np.array(row, np.int64)
        right, left = np.arange(1, len(row) + 1), np.arange(-1, len(row) - 1)
        places: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def index(at: np.ndarray) -> None:
            """Enter the pairs that begin at these positions into the lists of their ranks."""
            rank = self.ranks(symbol[at], symbol[right[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(np.diff(rank)) + 1
            for r, few in zip(rank[np.r_[0, cuts]].tolist() if len(rank) else (), np.split(at, cuts)):
                if r not in places:
                    places[r] = []
                    heapq.heappush(active, r)
                places[r].append(few)

        index(np.arange(len(row) - 1))
        while active:
            r = heapq.heappop(active)
            a, b, made = self.rules[r]
            lists = places.pop(r)
            at = lists[0] if len(lists) == 1 else ordered(lists)  # a list is in order and names no place twice
            at = at[(symbol[at] == a) & (symbol[right[at]] == b)]  # the others lost a symbol to an earlier merge
            if not len(at):
                continue
            if a == b and len(at) > 1:  # of a chain of overlapping pairs every other one, from the left
                chained = np.r_[False, left[at[1:]] == at[:-1]]
                step = np.arange(len(at))
                at = at[(step - np.maximum.accumulate(np.where(chained, 0, step))) % 2 == 0]
            after = right[at]
            beyond = right[after]
            symbol[at], symbol[after] = made, TAKEN
            right[at], left[beyond] = beyond, at
            index(ordered([at, left[at]]))
        kept = symbol[symbol != TAKEN].astype(np.int32)
        ends = np.flatnonzero(kept == GAP)
        return [kept[i + 1 : j] for i, j in zip(ends[:-1].tolist(), ends[1:].tolist())]


def ordered(lists: list[np.ndarray]) -> np.ndarray:
    """The places of all lists, each once."""
    at = np.concatenate(lists)
    at.sort()
    return at[np.r_[True, at[1:] != at[:-1]]]


class Memory(dict):
    """What was asked for lately: when the newer half is full, the older half is dropped."""

    def __init__(self, size: int):
        self.half, self.older = size // 2, {}

    def unknown(self, names: set[str]) -> list[str]:
        """The names that are not remembered; the others stay until the next call at least."""
        if len(self) > self.half:
            self.older = dict(self)
            self.clear()
        absent = names.difference(self)
        fresh = absent.difference(self.older)
        absent -= fresh
        self.update(zip(absent, map(self.older.__getitem__, absent)))
        return list(fresh)


class Chunks(Memory):
    """Ids (as bytes) of chunks between white space."""

    def __init__(self, path: str):
        super().__init__(CACHE_CHUNKS)
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        self.normal, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.merges = Merges(path)
        #: The byte alphabet's form of Latin-1 letters in lower case
        self.bytes_of = {ord(c): self.split(c)[0][0] for c in map(chr, range(0xDF, 0x100)) if c.isalpha()}
        #: Ids (as bytes) of words
        self.known = Memory(CACHE_WORDS)
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.merges.specials, key=len, reverse=True))) + ")")
        #: Characters that Python splits at and the vocabulary's rule for white space does not
        self.joined = re.compile("[\x1c-\x1f]")
        self.white = re.compile("[\t-\r \x85\xa0  -     　]+")

    def of(self, text: str) -> list[str]:
        """The text's chunks in order, special tokens as chunks of their own."""
        if "<|" in text and len(parts := self.special.split(text)) > 1:
            return [c for p in parts for c in ([p] if p in self.merges.specials else self.of(p))]
        if self.joined.search(text):
            return [c for c in self.white.split(text) if c]
        return text.split()

    #: Printable ASCII and the letters of Latin-1, which the vocabulary's normaliser only puts into lower case
    PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
    #: The vocabulary's splitting rule for them, in lower case
    PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")

    def words(self, chunk: str) -> list[str]:
        if chunk.isascii():
            if chunk.isalpha():
                return [chunk.lower()]
            if chunk.isprintable():
                return self.PARTS.findall(chunk.lower())
        elif self.PLAIN.fullmatch(chunk):
            return [w if w.isascii() else w.translate(self.bytes_of) for w in self.PARTS.findall(chunk.lower())]
        return [w for w, _ in self.split(self.normal(chunk))]

    def learn(self, chunks: set[str]) -> None:
        """Encode the chunks that are not known yet, together."""
        fresh = self.unknown(chunks)
        specials, known = self.merges.specials, self.known
        parts = [() if c in specials else self.words(c) for c in fresh]
        new = known.unknown(set(chain.from_iterable(parts)))
        known.update((w, i.tobytes()) for w, i in zip(new, self.merges.encoded(new)))
        for c, ws in zip(fresh, parts):
            self[c] = known[ws[0]] if len(ws) == 1 else b"".join([known[w] for w in ws]) if ws else np.int32(specials[c]).tobytes() if c in specials else b""


#: What a worker keeps from task to task: the chunks it remembers, and the tokens of a vocabulary.
@functools.lru_cache(maxsize=1)
def remembered(path: str) -> Chunks:
    return Chunks(path)


@functools.lru_cache(maxsize=1)
def token_texts(path: str) -> pa.Array:
    return pa.array(Merges(path).tokens, pa.large_string())


def encode(docs: DataFrame, vocabulary_path: str | None = None) -> DataFrame:
    """(doc_id, ids): the token ids of each whole text."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = remembered(vocabulary_path or vocabulary("word_bpe_49k.json"))
        for part, _, _ in text_slices(batches):
            texts = part.column(1).to_pylist()
            chunks: set[str] = set()
            for t in texts:
                chunks.update(known.of(t or ""))
            known.learn(chunks)
            rows = [b"".join(map(known.__getitem__, known.of(t or ""))) for t in texts]  # cut again: a slice's chunks, one by one, take many times its text
            ends = np.cumsum([0, *(len(r) // 4 for r in rows)])
            ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(rows), np.int32)))
            yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    return chosen(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(encoded, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary_path: str | None = None) -> DataFrame:
    """(doc_id, ids, text): tokens of the ids, special ones included, joined by spaces (the vocabulary names no decoder)."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_texts(vocabulary_path or vocabulary("word_bpe_49k.json"))
        for batch in batches:
            column = batch.column(1).fill_null([]) if batch.column(1).null_count else batch.column(1)
            at = column.offsets.to_numpy()
            first = 0
            while first < batch.num_rows:
                last = max(first + 1, int(np.searchsorted(at, at[first] + DECODE_IDS, "right")) - 1)
                few = column.slice(first, last - first)
                lists = pa.ListArray.from_arrays(pa.array((at[first : last + 1] - at[first]).astype(np.int32)), tokens.take(few.flatten()))
                text = pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), few, text], ["doc_id", "ids", "text"])
                first = last

    return chosen(encoded, "doc_id", "ids").mapInArrow(decoded, "doc_id long, ids array<int>, text string")


def digests(decoded: DataFrame) -> DataFrame:
    """Counts and digests of the ids and of the text that they decode to."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
