"""Group spelling variants: words one code point apart, rarer ones on the frequent one's form.

A word's letters are a multiset: the binary vector that has one dimension for the first,
second, ... occurrence of each code point. One inserted or deleted code point changes one
dimension, a replaced one two. PartEnum signatures make this an equi-join: dimensions are
dealt into ``PARTS`` parts, at most two of which can differ, so for each choice of
``PARTS - 2`` parts the dimensions of a word in them are a signature, and two near words
agree on at least one. A signature also holds the word's first or its last three code
points, since one edit in a word of six leaves one of these as it is. Pairs that agree on
a signature are verified by their edit distance.

Counting reads each text once, in one pass that sums per task what fits a bounded table,
then by a map-side combined aggregate. All later steps work on distinct words. Forms are
followed by pointer jumping: a form has at least ``RATIO`` times its word's count, so
chains are short and a few joins, their number set by the largest count, reach the roots.
No side of a join is broadcast, as none has a bound.

Null texts and texts without runs have no words; a null doc_id is written as ``null`` in
the checksum. Repeated rows count each. An empty table gives no rows. Columns other than
the two named are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerstone.llm.common import chosen, stored

SHORTEST, LEAST, RATIO, DROP_EVERY = 6, 5, 5, 199
#: Parts of the dimensions; near words differ in at most two of them.
PARTS, APART = 5, 2
#: Code points at a word's end that one edit in a word of SHORTEST leaves as they are.
ENDS = SHORTEST // 2
#: Distinct words that a task sums before it hands them on.
TABLE_WORDS = 250_000


def runs(docs: DataFrame) -> DataFrame:
    """(word, n) partial counts of the letter runs of whole texts, every ``DROP_EVERY``-th (document, run) short of a code point.

    All letters looked for lie below U+0100, so texts are searched in Latin-1, a byte a
    code point, where every other character stands as a question mark.
    """
    # a run of SHORTEST can only become shorter, and shorter runs are no words
    pattern = re.compile(rb"[a-z\xc0-\xff]{%d,}" % SHORTEST)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: Counter[bytes] = Counter()

        def handed_on() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in table], pa.string())
            batch = pa.RecordBatch.from_arrays([words, pa.array(list(table.values()), pa.int64())], ["word", "n"])
            table.clear()
            return batch

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                found = pattern.findall((text.as_py() or "").encode("latin-1", "replace").lower())
                table.update(found)
                seed = zlib.crc32(b"%d:" % doc.as_py() if doc.is_valid else b"null:")
                for word in set(found):
                    code = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), seed)
                    if code % DROP_EVERY == 0:
                        at, n = code % len(word), found.count(word)
                        table[word] -= n
                        table[word[:at] + word[at + 1 :]] += n
                if len(table) > TABLE_WORDS:
                    yield handed_on()
        yield handed_on()

    return chosen(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(counted, "word string, n long")


def vocabulary(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(word, n) of each distinct word of at least ``SHORTEST`` code points and ``least`` occurrences."""
    return runs(docs).where(F.char_length("word") >= SHORTEST).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def signatures(word: Column) -> Column:
    """PartEnum signatures of a word, each with one of its two ends."""
    letters = F.array_sort(F.split(word, ""))
    dimensions = F.transform(letters, lambda c, i: F.concat(c, (i + 1 - F.array_position(letters, c)).cast("string")))

    def part(held: Column, p: int) -> Column:
        return F.array_join(F.filter(held, lambda d: F.pmod(F.crc32(d.cast("binary")), F.lit(PARTS)) == p), "")

    def signed(held: Column) -> Column:
        ends = F.left(word, F.lit(ENDS)), F.right(word, F.lit(ENDS))
        choices = list(combinations(range(PARTS), PARTS - APART))
        return F.array(*[F.xxhash64(F.lit(n * len(ends) + e), ends[e], *[held[p] for p in choice]) for n, choice in enumerate(choices) for e in range(len(ends))])

    # bound once each, as an array of one, so that no choice computes them again
    held = F.transform(F.array(dimensions), lambda d: F.array(*[part(d, p) for p in range(PARTS)]))
    return F.transform(held, signed)[0]


def unbounded(side: DataFrame) -> DataFrame:
    """A side that grows with the vocabulary is shuffled: Spark sizes it by its compressed file, and as if an explode added no rows."""
    return side.hint("merge")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n) of words that differ by one code point, each pair once, a before b in code-point order."""
    signed = words.select("word", "n", F.explode(signatures(F.col("word"))).alias("signature"))
    left, right = (signed.select("signature", F.col("word").alias(x), F.col("n").alias(f"{x}_n")) for x in "ab")
    met = left.join(unbounded(right), "signature").where((F.col("a") < F.col("b")) & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "a_n", "b", "b_n").distinct()


def forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, form, form_n, n_near): the form is the most frequent near word, where it is ``ratio`` times as frequent."""
    pairs = near_pairs(words)
    each = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"), F.col("a_n").alias("b_n")))
    best = each.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("minus_n"), F.col("b").alias("form"))).alias("first"))
    enough = -F.col("first.minus_n") >= ratio * F.col("n")
    return words.join(unbounded(best), "word", "left").select(
        "word", "n", F.when(enough, F.col("first.form")).alias("form"), F.when(enough, -F.col("first.minus_n")).alias("form_n"), F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near")
    )


def grouped(docs: DataFrame, least: int = LEAST, ratio: int = RATIO) -> DataFrame:
    """One row per word: its form, the root that its forms lead to, and counts."""
    words = stored(vocabulary(docs, least), "words")
    known = stored(forms(words, ratio), "forms")
    most = known.agg(F.max("n")).first()[0] or 1
    longest, count = 1, least  # forms in a row, each ``ratio`` times the one before
    while (count := count * ratio) <= most:
        longest += 1
    jumps = known.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while longest > 1:
        onward = jumps.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        jumps = stored(jumps.join(unbounded(onward), "root", "left").select("word", F.coalesce("beyond", "root").alias("root")), "roots")
        longest = (longest + 1) // 2
    return known.join(unbounded(jumps), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
