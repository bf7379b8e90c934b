"""Pack documents into token sequences of a fixed window.

Bounded-space online packing. Each partition keeps a fixed number of open windows.
What a document has beyond whole windows goes to the open window that it fills best;
where none has room, the fullest is emitted, topped up with the head of the piece so
that no padding is left, and a new window opens. At the end of the partition the
leftover windows are merged into full ones, and the last one is cut into lengths that
are powers of two, which need no padding.

Nothing is shuffled: the order of rows in a file split is fixed, so a task that runs
again after an executor was lost packs the same pieces under the same numbers. Memory
is one slice of text, the open windows and a bounded cache of words.

Null or empty text is a document of its end id alone. Repeated rows are documents of
their own. A null doc_id stays null. An empty table gives no rows. Columns other than
the two named are not read.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ledgerstone.llm.common import chosen, text_slices

WINDOW, OPEN_WINDOWS, END_ID = 1024, 64, 0
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
#: Words whose ids a worker remembers; beyond them words are encoded again each time.
CACHE_WORDS = 400_000


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public vocabulary file, as this process sees it."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Token ids of whole texts, as the tokenizers library gives them for byte_bpe_50k.json.

    The vocabulary's splitting rule never joins a character to the space before the
    next word, so a text is the ids of its space-led words in a row, and words repeat:
    each is looked up, or encoded with the same vocabulary's merge ranks, which is
    several times faster on single words. Texts where a space stands before more white
    space are encoded whole, and those that may hold a special token by the tokenizers
    library itself.
    """

    WHOLE = re.compile(r" \s|<\|")

    def __init__(self, path: str, ranks_path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.ranked = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.tokenizer = Tokenizer.from_file(path)
        self.bare = Words(self, "")
        self.led = Words(self, " ")

    def encode(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids if "<|" in text else self.ranked.encode_ordinary(text)
        return array("I", ids).tobytes()

    def letters(self, text: str) -> bytes:
        """Letters, led by at most one space, are one unit to merge."""
        return array("I", self.ranked._encode_single_piece(text)).tobytes()

    def ids(self, text: str) -> np.ndarray:
        if self.WHOLE.search(text):
            return np.frombuffer(self.encode(text), np.uint32)
        head, *rest = text.split(" ")
        return np.frombuffer(b"".join([self.bare[head], *map(self.led.__getitem__, rest)]), np.uint32)


class Words(dict):
    """Ids of words with a lead (a space or nothing); a bounded number is remembered.

    Letters, the marks after them and a line feed before the next word are always
    units of their own, so a word is looked up by these parts.
    """

    MARKS = ".,!?%$&*#|;:"

    def __init__(self, encoder: Encoder, lead: str):
        self.encoder, self.lead = encoder, lead

    def __missing__(self, word: str) -> bytes:
        encoder, (left, feed, right) = self.encoder, word.partition("\n")
        if feed and left and right and not left[-1].isspace() and not right[0].isspace():
            return b"".join([self[left], encoder.bare["\n"], encoder.bare[right]])
        core = word.rstrip(self.MARKS)
        if not core.isalpha():
            ids = encoder.encode(self.lead + word)
        elif core == word:
            ids = encoder.letters(self.lead + word)
        else:
            ids = self[core] + encoder.bare[word[len(core) :]]
        if len(self) < CACHE_WORDS:
            self[word] = ids
        return ids


class Packer:
    """The open windows of one partition. A piece is (doc_id, start, ids, doc_tokens)."""

    def __init__(self, first_sequence: int, window: int, open_windows: int):
        self.sequence, self.window, self.limit = first_sequence, window, open_windows
        self.open: list[tuple[int, list]] = []  # (ids used, pieces)
        self.rows: list[tuple] = []

    def _emit(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, len(ids), total, self.sequence, offset, ids.tobytes()))
            offset += len(ids)
        self.sequence += 1

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        total, whole = len(ids), len(ids) // self.window * self.window
        for start in range(0, whole, self.window):
            self._emit([(doc, start, ids[start : start + self.window], total)])
        if whole < total:
            self._place((doc, whole, ids[whole:], total))

    def _place(self, piece: tuple) -> None:
        need = len(piece[2])
        used = [u for u, _ in self.open]
        fit = max((i for i, u in enumerate(used) if u + need <= self.window), key=used.__getitem__, default=None)
        if fit is None and len(self.open) >= self.limit:
            full, pieces = self.open.pop(max(range(len(used)), key=used.__getitem__))
            head, piece = _cut(piece, self.window - full)
            self._emit([*pieces, head])
            return self._place(piece)
        if fit is None:
            self.open.append((need, [piece]))
        elif used[fit] + need == self.window:
            self._emit([*self.open.pop(fit)[1], piece])
        else:
            self.open[fit] = (used[fit] + need, [*self.open[fit][1], piece])

    def finish(self) -> None:
        """Merge the leftovers, fullest first, into full windows; cut the last into powers of two."""
        left = [p for _, pieces in sorted(self.open, key=lambda w: -w[0]) for p in pieces]
        self.open, count = [], sum(len(p[2]) for p in left)
        while count:
            room = min(self.window, 1 << (count.bit_length() - 1)) if self.window & (self.window - 1) == 0 else min(self.window, count)
            count -= room
            now = []
            while room:
                head, rest = _cut(left.pop(0), room)
                now.append(head)
                room -= len(head[2])
                if len(rest[2]):
                    left.insert(0, rest)
            self._emit(now)

    def batch(self) -> pa.RecordBatch:
        names = [c.split()[0] for c in PIECES.split(", ")]
        columns = list(zip(*self.rows)) or [()] * len(names)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if n == "ids" else pa.int64()) for n, c in zip(names, columns)], names)


def _cut(piece: tuple, at: int) -> tuple[tuple, tuple]:
    doc, start, ids, total = piece
    return (doc, start, ids[:at], total), (doc, start + at, ids[at:], total)


def pack(docs: DataFrame, vocabulary_path: str | None = None, ranks_path: str | None = None, window: int = WINDOW, open_windows: int = OPEN_WINDOWS, end_id: int = END_ID) -> DataFrame:
    """One row per piece: where it stands in its document and in its sequence, and its ids (unsigned 32-bit, little-endian)."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary_path or vocabulary(), ranks_path or vocabulary("byte_bpe_50k.tiktoken"))
        packer = Packer(TaskContext.get().partitionId() << 40, window, open_windows)
        end = np.array([end_id], np.uint32)
        for part, data, at in text_slices(batches):
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                packer.add(doc, np.concatenate([encoder.ids(text or ""), end]))
            yield packer.batch()
        packer.finish()
        yield packer.batch()

    return chosen(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(packed, PIECES)


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = END_ID) -> DataFrame:
    """Training rows: each sequence's ids in order, padded to the window unless its length is a power of two."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    padded = F.when(F.bit_count(F.octet_length("ids")) == 1, F.col("ids")).otherwise(
        F.rpad(F.col("ids"), F.lit(4 * window), F.lit(int(pad_id).to_bytes(4, "little")))
    )
    joined = F.aggregate(parts, F.unhex(F.lit("")), lambda all_ids, part: F.concat(all_ids, part["ids"]))
    return pieces.groupBy("sequence_id").agg(joined.alias("ids")).select("sequence_id", padded.alias("ids"))
