"""Look documents up among known licence texts by canonical digest.

A text's canonical form is lower case without copyright lines, with equivalent
spellings made one, and with every run of punctuation and white space one space. Its
SHA-256 is joined with the digests of known licence texts: grants in a sentence or two, and
the full texts in ``licence_texts``, named by SPDX id, with and without their title. What is looked up whole is
the document, each of its lines and each block of lines between blank ones, so a file that
is a licence and a notice in a document are both found, however their lines are wrapped; a line or document that only mentions a licence is not.

Null or empty text matches nothing. Repeated rows give repeated rows. An empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, functions as F

from ledgerstone.llm.common import chosen

#: Texts by which well-known licences are granted, in their authors' words.
KNOWN = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Released under the Apache License, Version 2.0."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License v3.0."],
    "GPL-2.0": ["Licensed under the GNU General Public License, version 2.", "Licensed under the GNU General Public License v2.0."],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice "
        "and this permission notice appear in all copies.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}

#: Spellings that mean the same, in the order in which they are replaced.
EQUIVALENT = (
    ("licence", "license"), ("sub-licens", "sublicens"), ("organisation", "organization"), ("non-commercial", "noncommercial"), ("non commercial", "noncommercial"),
    ("merchantibility", "merchantability"), ("favour", "favor"), ("neighbour", "neighbor"), ("https://", "http://"), ("per cent", "percent"),
)
COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n]*(copyright|\(c\)|©|all rights reserved)[^\n]*$"
#: The query's own rule is narrower: wrapped lines of a licence's body may begin with these words, or with an item (c).
COPYRIGHT_HELD = (
    r"(?m)^[^\p{L}\p{N}\n]*((?i:\(c\)|©)(?=[^\n]*\d{4})|(?i:all rights reserved)[^\p{L}\p{N}\n]*$|(?i:copyright)(?=[^\p{L}\n]*\d{4}|\s*(?i:\(c\)|©)"
    r"|\s+(?!(?i:licen[sc]es?|notices?|holders?|owners?|laws?|act|treaty|interests?|statements?|disclaimers?|and|or)\b)\p{Lu}[^\n]*\p{Ll}))[^\n]*$"
)
BLOCK = r"\n[ \t\r]*\n"
APART = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    out = F.lower(F.regexp_replace(text, COPYRIGHT_HELD, ""))
    for spelling, one in EQUIVALENT:
        out = F.replace(out, F.lit(spelling), F.lit(one))
    return F.trim(F.regexp_replace(out, APART, " "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def full_texts() -> dict[str, list[str]]:
    """The full texts by SPDX id, each as it is and, where its first block is a title, without it."""
    out = {}
    for file in sorted((Path(__file__).parent / "licence_texts").glob("*.txt")):
        text = file.read_text()
        title, _, body = text.strip().partition("\n\n")
        out[file.stem] = [text, body] if file.stem != "Unlicense" else [text]
    return out


def known_digests(docs: DataFrame, known: dict[str, list[str]] = KNOWN) -> DataFrame:
    """(known_digest, licence) of the known texts, a fixed few."""
    rows = [(name, text) for group in (known, full_texts()) for name, texts in group.items() for text in texts]
    return docs.sparkSession.createDataFrame(rows, "licence string, text string").select(digest(F.col("text")).alias("known_digest"), "licence").dropDuplicates(["known_digest"])


def scanned(docs: DataFrame, known: dict[str, list[str]] = KNOWN) -> DataFrame:
    """Per row doc_id, text_digest, text_licence (null if none), n_notices and licences (names, comma-separated, '' if none)."""
    digests = known_digests(docs, known)
    texts = chosen(docs, "doc_id", "text").withColumns({"text_hash": F.xxhash64("text"), "text_digest": digest(F.coalesce("text", F.lit("")))})
    lines = texts.select("doc_id", "text_hash", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")).where(F.trim("line") != "")
    # blocks with words on one line only, besides copyright, are lines already
    blocks = texts.select("doc_id", "text_hash", F.posexplode(F.split("text", BLOCK, -1)).alias("pos", "line")).where(F.col("line").contains("\n"))
    blocks = blocks.where(F.size(F.filter(F.split(F.regexp_replace("line", COPYRIGHT_HELD, ""), "\n", -1), lambda l: l.rlike(r"[\p{L}\p{N}]"))) > 1)
    lines = lines.unionByName(blocks.withColumn("pos", -1 - F.col("pos")))
    found = (
        lines.select("doc_id", "text_hash", "pos", digest(F.col("line")).alias("known_digest")).join(digests, "known_digest")
        .groupBy("doc_id", "text_hash").agg(F.count_distinct("pos").alias("n_notices"), F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("licences"))
        .withColumnsRenamed({"doc_id": "found_id", "text_hash": "found_hash"})
    )
    whole = texts.drop("text").join(digests, F.col("text_digest") == F.col("known_digest"), "left")
    both = whole.join(found, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_hash") == F.col("found_hash")), "left")
    return both.select(
        "doc_id", "text_digest", F.col("licence").alias("text_licence"), F.coalesce("n_notices", F.lit(0)).alias("n_notices"), F.coalesce("licences", F.col("licence"), F.lit("")).alias("licences")
    )


def _sql(text: str) -> str:
    out = f"regexp_replace(lower({text}), '{COPYRIGHT_LINE}', '', 'g')"
    for spelling, one in EQUIVALENT:
        out = f"replace({out}, '{spelling}', '{one}')"
    return f"sha256(trim(regexp_replace({out}, '{APART}', ' ', 'g')))"


_VALUES = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, texts in KNOWN.items() for text in texts)
ORACLE = f"""
WITH known AS (SELECT DISTINCT {_sql("t")} AS digest, licence FROM (VALUES {_VALUES}) AS v(licence, t)),
d AS (SELECT doc_id, {_sql("coalesce(text, '')")} AS text_digest FROM documents),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS pos FROM documents),
f AS (SELECT doc_id, pos, {_sql("line")} AS digest FROM l WHERE trim(line) <> ''),
g AS (SELECT doc_id, count(DISTINCT pos) AS n_notices, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences FROM f JOIN known ON f.digest = known.digest GROUP BY doc_id)
SELECT d.doc_id, d.text_digest, k.licence AS text_licence, coalesce(g.n_notices, 0) AS n_notices, coalesce(g.licences, k.licence, '') AS licences
FROM d LEFT JOIN known k ON d.text_digest = k.digest LEFT JOIN g ON d.doc_id = g.doc_id
"""
