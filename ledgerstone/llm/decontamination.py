"""Find documents that hold benchmark items, re-parameterised ones too.

Texts become templates: numbers, quantities (a number with its unit), units after a
number, and names (capitalised words inside a sentence) turn into typed placeholders,
other words are lower-cased without punctuation. Windows of ``WINDOW`` template tokens
are hashed and joined with the benchmark's. Windows that stand at one distance from
their item's belong together; their slots must agree one to one (the item's 12 is the
document's 17 everywhere, and nothing else is), and they must cover at least ``COVERAGE``
of the item's windows.

The benchmark is small beside the corpus; its windows are broadcast after they have been
counted, up to ``MOST_BROADCAST``, and shuffled beyond. Only documents with a hit are
read again with their words.

Null or empty texts and items of fewer than WINDOW tokens match nothing. Repeated
documents are reported with equal rows once per doc_id and text, repeated items by each
item_id. A null doc_id is reported as null. Other columns are not read by ``leaks`` and
kept by ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerstone.llm.common import chosen, stored

WINDOW, COVERAGE = 8, 0.5
MOST_BROADCAST = 500_000

#: Units of measure, as they are written in lower case.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb lbs oz ml cl l gal s sec ms min h hr hrs d w kw mw kwh j kj mj cal kcal n pa kpa hz khz mhz ghz "
    "v mv kv a ma k c f kb mb gb tb kmh mph kph usd eur gbp percent dollars euros pounds cents meters metres kilometers kilometres miles "
    "feet inches grams kilograms liters litres seconds minutes hours days weeks months years degrees"
).split()
_UNITS = ", ".join(f"'{u}'" for u in UNITS)
#: Everything but letters, digits and the marks that end sentences or belong to numbers.
APART = r"[^\p{L}\p{N}.!?%]+"
_MARKS = ".!?%"


def template(tokens: str) -> Column:
    """Template of a column of tokens; a token's neighbour before it decides on names and units."""
    core = f"btrim(w, '{_MARKS}')"
    before = f"get({tokens}, i - 1)"
    return F.expr(f"""transform({tokens}, (w, i) -> CASE
        WHEN {core} >= '0' AND {core} < ':' THEN CASE
            WHEN {core} RLIKE '^[0-9.]+$' THEN '<num>'
            WHEN lower(regexp_replace({core}, '^[0-9.]+', '')) IN ({_UNITS}) THEN '<qty>' ELSE lower({core}) END
        WHEN i > 0 AND {before} >= '0' AND {before} < ':' AND lower({core}) IN ({_UNITS}) THEN '<unit>'
        WHEN i > 0 AND substr({core}, 1, 1) <> lower(substr({core}, 1, 1)) AND right({before}, 1) NOT IN ('.', '!', '?') THEN '<name>'
        ELSE lower({core}) END)""")


def tokens_of(text: str) -> Column:
    spaced = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), APART, " ")
    return F.filter(F.split(spaced, " ", -1), lambda w: F.btrim(w, F.lit(_MARKS)) != "")


def _windows(window: int) -> Column:
    """(pos, hash) of each window of the column ``template``."""
    last = F.size("template") - window
    hashes = F.transform(F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>")), lambda i: F.xxhash64(F.slice("template", i + 1, window)))
    return F.posexplode(hashes)


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, text_hash, item_id, n_windows, item_windows, n_slots, exact) of each document and item that leaks into it."""
    items = chosen(benchmark, "item_id", "text").withColumn("item_words", tokens_of("text")).withColumn("template", template("item_words"))
    items = items.select("item_id", "item_words", "template", (F.size("template") - window + 1).cast("long").alias("item_windows"), F.xxhash64("text").alias("item_hash"))
    item_windows = stored(items.select("item_id", "item_hash", _windows(window).alias("item_pos", "hash")), "benchmark-windows")
    few = item_windows.count() <= MOST_BROADCAST
    known = item_windows.select("hash").distinct()

    texts = chosen(docs, "doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
    seen = texts.withColumn("tokens", tokens_of("text")).select("doc_id", "text_hash", template("tokens").alias("template"))
    hit = seen.select("doc_id", "text_hash", _windows(window).alias("pos", "hash")).join(F.broadcast(known) if few else known, "hash", "left_semi")
    hit = stored(hit.select("doc_id", "text_hash").distinct(), "hits").withColumnsRenamed({"doc_id": "hit_id", "text_hash": "hit_hash"})

    again = texts.join(hit, texts["doc_id"].eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash")), "left_semi").dropDuplicates(["doc_id", "text_hash"])
    again = stored(again.withColumn("words", tokens_of("text")).withColumn("template", template("words")).select("doc_id", "text_hash", "words", "template"), "suspects")
    placed = again.select("doc_id", "text_hash", _windows(window).alias("pos", "hash"))
    met = placed.join(F.broadcast(item_windows) if few else item_windows, "hash")
    runs = (
        met.groupBy("doc_id", "text_hash", "item_id", "item_hash", (F.col("pos") - F.col("item_pos")).alias("shift"))
        .agg(F.collect_set("item_pos").alias("at"))
        .join(items.select("item_id", "item_hash", "item_words", "item_windows", F.col("template").alias("item_template")).dropDuplicates(["item_id", "item_hash"]), ["item_id", "item_hash"])
        .where(F.size("at") >= coverage * F.col("item_windows"))
        .withColumnsRenamed({"doc_id": "id", "text_hash": "hashed"})
    )
    both = runs.join(again.select("doc_id", "text_hash", "words"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hashed")))
    covered = F.array_distinct(F.flatten(F.transform("at", lambda p: F.sequence(p, p + window - 1))))
    value = lambda words, i: F.lower(F.btrim(F.get(words, i), F.lit(_MARKS)))
    slots = F.transform(
        F.filter(covered, lambda i: F.get("item_template", i).isin("<num>", "<qty>", "<unit>", "<name>")),
        lambda i: F.struct(F.get("item_template", i).alias("kind"), value("item_words", i).alias("x"), value("words", i + F.col("shift")).alias("y")),
    )
    mapped = both.withColumn("slots", F.array_distinct(slots))
    consistent = (F.size("slots") == F.size(F.array_distinct(F.expr("transform(slots, s -> struct(s.kind, s.x))")))) & (
        F.size("slots") == F.size(F.array_distinct(F.expr("transform(slots, s -> struct(s.kind, s.y))")))
    )
    return (
        mapped.where(consistent).groupBy("doc_id", "text_hash", "item_id")
        .agg(F.max_by(F.struct(F.size("at").cast("long").alias("n"), "item_windows", F.size("slots").cast("long").alias("slots"), (~F.exists("slots", lambda s: s["x"] != s["y"])).alias("exact")), F.struct(F.size("at"), -F.col("shift"))).alias("best"))
        .select("doc_id", "text_hash", "item_id", F.col("best.n").alias("n_windows"), "best.item_windows", F.col("best.slots").alias("n_slots"), "best.exact")
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that hold no benchmark item, whole."""
    bad = leaks(docs, benchmark).select(F.col("doc_id").alias("leak_id"), F.col("text_hash").alias("leak_hash")).distinct()
    whole = docs.select(F.struct("*").alias("doc")).withColumn("text_hash", F.xxhash64("doc.text"))
    return whole.join(bad, F.col("doc.doc_id").eqNullSafe(F.col("leak_id")) & (F.col("text_hash") == F.col("leak_hash")), "left_anti").select("doc.*")


def _sql_template(tokens: str) -> str:
    core, before = f"trim(w, '{_MARKS}')", f"{tokens}[i - 1]"
    return f"""list_transform({tokens}, lambda w, i: CASE
        WHEN {core} >= '0' AND {core} < ':' THEN CASE
            WHEN regexp_matches({core}, '^[0-9.]+$') THEN '<num>'
            WHEN lower(regexp_replace({core}, '^[0-9.]+', '')) IN ({_UNITS}) THEN '<qty>' ELSE lower({core}) END
        WHEN i > 1 AND {before} >= '0' AND {before} < ':' AND lower({core}) IN ({_UNITS}) THEN '<unit>'
        WHEN i > 1 AND substr({core}, 1, 1) <> lower(substr({core}, 1, 1)) AND right({before}, 1) NOT IN ('.', '!', '?') THEN '<name>'
        ELSE lower({core}) END)"""


_SQL_TOKENS = f"list_filter(string_split(regexp_replace(coalesce(text, ''), '{APART}', ' ', 'g'), ' '), lambda w: trim(w, '{_MARKS}') <> '')"
ORACLE = rf"""
WITH d AS (SELECT doc_id, {_SQL_TOKENS} AS words FROM documents),
b AS (SELECT item_id, {_SQL_TOKENS} AS words FROM benchmark),
dt AS (SELECT doc_id, words, {_sql_template("words")} AS tpl FROM d),
bt AS (SELECT item_id, words, {_sql_template("words")} AS tpl FROM b),
dw AS (SELECT doc_id, pos, array_to_string(list_slice(tpl, pos, pos + {WINDOW - 1}), ' ') AS win FROM (SELECT doc_id, tpl, unnest(range(1, len(tpl) - {WINDOW - 2})) AS pos FROM dt)),
bw AS (SELECT item_id, pos, array_to_string(list_slice(tpl, pos, pos + {WINDOW - 1}), ' ') AS win FROM (SELECT item_id, tpl, unnest(range(1, len(tpl) - {WINDOW - 2})) AS pos FROM bt)),
m AS (SELECT doc_id, item_id, dw.pos - bw.pos AS shift, bw.pos AS spot FROM dw JOIN bw ON dw.win = bw.win),
r AS (SELECT doc_id, item_id, shift, count(DISTINCT spot) AS n FROM m GROUP BY doc_id, item_id, shift),
c AS (SELECT r.*, len(bt.tpl) - {WINDOW - 1} AS item_windows FROM r JOIN bt ON r.item_id = bt.item_id WHERE n >= {COVERAGE} * (len(bt.tpl) - {WINDOW - 1})),
p AS (SELECT DISTINCT c.doc_id, c.item_id, c.shift, m.spot + k.k AS i FROM c JOIN m ON c.doc_id = m.doc_id AND c.item_id = m.item_id AND c.shift = m.shift CROSS JOIN (SELECT unnest(range(0, {WINDOW})) AS k) k),
s AS (SELECT DISTINCT p.doc_id, p.item_id, p.shift, bt.tpl[p.i] AS kind, lower(trim(bt.words[p.i], '{_MARKS}')) AS x, lower(trim(dt.words[p.i + p.shift], '{_MARKS}')) AS y
  FROM p JOIN bt ON p.item_id = bt.item_id JOIN dt ON p.doc_id = dt.doc_id WHERE bt.tpl[p.i] IN ('<num>', '<qty>', '<unit>', '<name>')),
g AS (SELECT doc_id, item_id, shift, count(*) AS n_slots, count(DISTINCT kind || ' ' || x) AS nx, count(DISTINCT kind || ' ' || y) AS ny, sum(CASE WHEN x <> y THEN 1 ELSE 0 END) AS changed FROM s GROUP BY doc_id, item_id, shift),
o AS (SELECT c.doc_id, c.item_id, c.n AS n_windows, c.item_windows, coalesce(g.n_slots, 0) AS n_slots, coalesce(g.changed, 0) = 0 AS exact,
  row_number() OVER (PARTITION BY c.doc_id, c.item_id ORDER BY c.n DESC, c.shift) AS place
  FROM c LEFT JOIN g ON c.doc_id = g.doc_id AND c.item_id = g.item_id AND c.shift = g.shift WHERE g.n_slots IS NULL OR (g.n_slots = g.nx AND g.n_slots = g.ny))
SELECT doc_id, item_id, n_windows, item_windows, n_slots, exact FROM o WHERE place = 1
"""
