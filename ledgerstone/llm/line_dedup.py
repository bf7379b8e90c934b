"""Drop lines that many documents share, except in the last document that holds them.

Lines are exploded with their positions and normalised (blanks stripped at both ends,
A-Z lower-cased); a key is the 128-bit hash of a normalised line of at least
``min_chars`` code points. Keys are counted per distinct document, first within tasks,
so a line that a third of all rows hold arrives as one row per task. Keys over the
threshold go back to the lines that hold them through a salted join; only positions
travel, and each document drops its positions and joins the rest in order.

Null or empty text is one empty line. Rows with one doc_id are one document for the
count, and each keeps its own text; rows without doc_id count together as one document
and never keep a dropped line for themselves. Repeated rows give repeated rows. An
empty table gives no rows. Other columns are carried through untouched by
``deduplicated``, whatever they are called.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from ledgerstone.llm.common import BLANKS, chosen

MIN_CHARS, MIN_DOCUMENTS, SALTS = 40, 5, 16


def line_key(line: Column) -> Column:
    stripped = F.btrim(line, F.lit(BLANKS.decode()))
    return F.translate(stripped, string.ascii_uppercase, string.ascii_lowercase)


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(doc_id, text_hash, dropped): the positions that go, for each text that loses any."""
    each = chosen(docs, "doc_id", "text").select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    keyed = each.select("doc_id", "text_hash", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    hashed = keyed.select("doc_id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), F.col("key")).alias("h2"))
    common = (
        hashed.select("h1", "h2", "doc_id").distinct()
        .groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("doc_id").alias("last"))
        .where(F.col("n") >= min_documents)
        .select("h1", "h2", "last", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    salted = hashed.withColumn("salt", F.pmod(F.xxhash64("doc_id", "pos"), F.lit(SALTS)).cast("int"))
    return (
        salted.join(common, ["h1", "h2", "salt"])
        .where(F.col("doc_id").isNull() | (F.col("doc_id") != F.col("last")))
        .groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("dropped"))
    )


def with_kept(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Struct ``doc`` of the input's columns beside n_lines, n_dropped and kept (the text that stays)."""
    doc = docs.select(F.struct("*").alias("doc")).withColumn("text_hash", F.xxhash64("doc.text"))
    gone = dropped_lines(docs, min_chars, min_documents).withColumnsRenamed({"doc_id": "gone_id", "text_hash": "gone_hash"})
    both = doc.join(gone, F.col("doc.doc_id").eqNullSafe(F.col("gone_id")) & (F.col("text_hash") == F.col("gone_hash")), "left")
    lines = lines_of(F.col("doc.text"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped"))
    return both.select("doc", "dropped", lines.alias("lines")).select(
        "doc",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.coalesce("doc.text", F.lit("")))
        .otherwise(F.array_join(F.transform(stay, lambda i: F.get(F.col("lines"), i)), "\n"))
        .alias("kept"),
    )


def digests(docs: DataFrame) -> DataFrame:
    kept = with_kept(docs)
    return kept.select("doc.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The input with the lines that stay as its text (a text that lost none stays as it is, null too)."""
    text = F.when(F.col("n_dropped") == 0, F.col("doc.text")).otherwise(F.col("kept")).alias("text")
    return with_kept(docs).select(*[text if c == "text" else F.col(f"doc.`{c}`") for c in docs.columns])


ORACLE = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key FROM l),
c AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCUMENTS}),
j AS (SELECT k.doc_id, k.pos, k.line, (c.key IS NOT NULL AND k.doc_id <> c.last) AS gone FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, CAST(coalesce(sum(CASE WHEN gone THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
