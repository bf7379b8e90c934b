import re
from collections import Counter, defaultdict
from pathlib import Path

import pytest

TESTDATA = Path("/root/testdata")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, sig long, line string, doc string"
BLANKS = " \t\n\x0b\x0c\r"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) pairs, with further columns named like derived ones."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", None, None, "k", 7, None, "d") for i, t in rows], SCHEMA).repartition(3)

    return make


@pytest.fixture
def messy():
    """Nulls, empty and very long texts, repeated rows and ties."""
    shared = "this line is shared by many documents, " + "x" * 30
    long = " ".join(f"w{i % 997}" for i in range(60_000))
    return [
        (1, None), (2, ""), (3, "\n\n"), (4, shared), (5, shared.upper() + "\nown five"), (6, "  " + shared + "\t\nown six"), (7, shared + "\n" + shared),
        (8, shared), (9, long), (10, long), (10, long), (11, "one"), (11, "two"), (None, shared), (None, None), (12, "é" * 45 + "\nÉ" * 45), (13, "a\nb\n"), (14, " \x0b\x0c "),
    ]


def fold(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def brute_lines(rows):
    """(doc_id, lines, dropped, text that stays) of each row."""
    of_key = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            of_key[fold(line.strip(BLANKS))].add(i)
    bad = {k: max((i for i in ids if i is not None), default=None) for k, ids in of_key.items() if len(k) >= 40 and len(ids) >= 5}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if (k := fold(x.strip(BLANKS))) not in bad or (i is not None and bad[k] == i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def brute_components(rows):
    """(doc_id, set size, component) of each row by exact sets."""
    sets = []
    for _, t in rows:
        w = re.findall("[^\x20\x09-\x0d]+", fold(t or ""))
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    above = {i: i for i, _ in rows if i is not None}

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    holders, both = defaultdict(list), Counter()
    for n, s in enumerate(sets):
        for x in s:
            holders[x].append(n)
    for held in holders.values():
        for q in range(len(held)):
            for p in range(q):
                both[held[p], held[q]] += 1
    for (p, q), c in both.items():
        if rows[p][0] is not None and rows[q][0] is not None and 100 * c >= 75 * (len(sets[p]) + len(sets[q]) - c):
            a, b = top(rows[p][0]), top(rows[q][0])
            above[max(a, b)] = min(a, b)
    return [(i, len(s), None if i is None else top(i)) for (i, _), s in zip(rows, sets)]
