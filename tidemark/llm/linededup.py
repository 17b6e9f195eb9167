"""Line dedup by distinct-site spread, with HyperLogLog sketches. DataFrame functions only.

A line is boilerplate if it stands on many different sites, in documents that
are otherwise different.  Copies of a document share all their lines, so each
document has a body: the least hash of its own lines, those that few documents
have.  A document that besides the line at hand has too few words of its own is
taken for a copy and has none.  A line needs as many different bodies as sites; one that only copies
have is a matter for document-level dedup, and stays.

Per line hash, sketches of the sites and of the bodies merge by aggregation.
Lines whose estimates lie near a threshold are counted exactly.  The document
with the smallest doc_id keeps the line; the others lose it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import store

#: Sites on which a line is boilerplate; lines of ``LONG`` words or more need ``LONG_SITES``.
SITES, LONG, LONG_SITES = 5, 50, 3
#: Share of a document's words besides the line at hand that its own lines hold, at least, for it to count as a body of its own; else it is taken for a copy.
OWN = 0.5
#: Logarithm of a sketch's size, and how far (in shares) an estimate may be off before it needs an exact count.
LG_K, MARGIN = 11, 0.15


def lines(text: Column) -> Column:
    """The trimmed, non-empty lines of a text."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x)), lambda x: x != "")


def body_key(line: Column) -> Column:
    """60 bits of a line's MD5, as a number."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 15), 16, 10).cast("bigint")


def key(line: Column) -> Column:
    """124 bits, as two numbers: fixed-width groups need no sort."""
    return F.struct(body_key(line).alias("k1"), F.xxhash64(line).alias("k2"))


KEY = ["k1", "k2"]


def _occurrences(docs: DataFrame) -> DataFrame:
    """A row per document and distinct line: k1, k2, words, doc_id, source, whole (a number for the text)."""
    own = docs.select("doc_id", "source", F.xxhash64("text").alias("whole"), F.array_distinct(lines(F.col("text"))).alias("lines")).where(F.size("lines") > 0)
    keyed = own.select("doc_id", "source", "whole", F.transform("lines", lambda x: F.struct(body_key(x).alias("k1"), F.xxhash64(x).alias("k2"), F.size(F.split(x, " ")).alias("words"))).alias("lines"))
    return keyed.select("doc_id", "source", "whole", F.explode("lines").alias("line")).select("line.*", "doc_id", "source", "whole")


def _own_bodies(seen: DataFrame, often: DataFrame) -> DataFrame:
    """``__doc, __whole, __body, __own, __all``: of documents with lines of their own the least hash of those, their words, and the words of all lines."""
    marked = seen.join(often.select(*KEY, F.lit(True).alias("shared")), KEY, "left")
    alone = F.col("shared").isNull()
    by = marked.groupBy(F.col("doc_id").alias("__doc"), F.col("whole").alias("__whole")).agg(F.min(F.when(alone, F.col("k1"))).alias("__body"), F.sum(F.when(alone, F.col("words")).otherwise(0)).alias("__own"), F.sum("words").alias("__all"))
    return by.where("__body IS NOT NULL")


def removals(docs: DataFrame, sites: int = SITES, long: int = LONG, long_sites: int = LONG_SITES, own: float = OWN) -> DataFrame:
    """``docs(doc_id, text, source)`` -> ``k1, k2, doc_id``: the boilerplate lines that a document loses.

    A null source is no site; lines are compared trimmed of spaces.
    """
    seen = store.table(_occurrences(docs), "lines")
    # A line needs as many documents as sites: most lines go here, before any sketch is made.
    often = seen.groupBy(*KEY).agg(F.count("*").alias("documents"), F.min("doc_id").alias("keeper"), F.max("words").alias("words"))
    often = store.table(often.where(F.col("documents") >= min(sites, long_sites)), "often")
    bodied = _own_bodies(seen, often)
    rows = seen.drop("words").join(often, KEY)
    rows = rows.join(bodied, rows["doc_id"].eqNullSafe(bodied["__doc"]) & (rows["whole"] == bodied["__whole"]), "left")
    body = F.when(F.col("__own") >= own * (F.col("__all") - F.col("words")), F.col("__body"))
    rows = store.table(rows.withColumn("body", body).drop("whole", "__doc", "__whole", "__body", "__own", "__all"), "repeated")
    spread = rows.groupBy(*KEY, "documents", "keeper", "words").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("source", LG_K)).alias("sites"), F.hll_sketch_estimate(F.hll_sketch_agg("body", LG_K)).alias("bodies")
    )
    spread = spread.withColumn("need", F.when(F.col("words") >= long, long_sites).otherwise(sites))
    least = F.least("sites", "bodies")
    unlikely, certain = least < F.col("need") * (1 - MARGIN), least > F.col("need") * (1 + MARGIN)
    spread = store.table(spread.where(~unlikely).withColumn("certain", certain), "spread")
    near = spread.where("not certain").select(*KEY, "need")
    # Distinct pairs first: a line that is on every page of a hot site is one row here.
    asked = rows.join(near.select(*KEY), KEY, "left_semi")
    exact_sites = asked.select(*KEY, "source").where("source is not null").distinct().groupBy(*KEY).agg(F.count("*").alias("exact_sites"))
    exact_bodies = asked.select(*KEY, "body").where("body is not null").distinct().groupBy(*KEY).agg(F.count("*").alias("exact_bodies"))
    counted = near.join(exact_sites, KEY).join(exact_bodies, KEY).where("exact_sites >= need and exact_bodies >= need")
    bad = spread.where("certain").select(*KEY).unionByName(counted.select(*KEY))
    return rows.join(bad, KEY).where(~F.col("doc_id").eqNullSafe(F.col("keeper"))).select(*KEY, "doc_id")


def _fresh(docs: DataFrame, name: str) -> str:
    """``name``, longer as often as needed to clash with no column, in any case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _stripped(docs: DataFrame, sites: int, long: int, long_sites: int, own: float) -> tuple[DataFrame, str]:
    """``docs`` with ``text`` changed and another column, whose name is returned: the number of lines that went."""
    doc, bad, gone = (_fresh(docs, n) for n in ("__doc", "__bad", "__removed"))
    hit = removals(docs, sites, long, long_sites, own)
    # A document's own lines bound this list.
    per_doc = hit.groupBy(F.col("doc_id").alias(doc)).agg(F.collect_set(F.struct(*KEY)).alias(bad))
    joined = docs.join(per_doc, docs["doc_id"].eqNullSafe(per_doc[doc]), "left")
    raw = F.split("text", "\n")
    kept = F.filter(raw, lambda x: ~F.array_contains(bad, key(F.trim(x))))
    text = F.when(F.col(bad).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    removed = F.when(F.col(bad).isNull(), 0).otherwise(F.size(raw) - F.size(kept)).cast("long")
    return joined.select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns], removed.alias(gone)), gone


def dedup(docs: DataFrame, sites: int = SITES, long: int = LONG, long_sites: int = LONG_SITES, own: float = OWN) -> DataFrame:
    """Documents without boilerplate lines: all columns of ``docs``, ``text`` changed, and ``lines_removed``.

    Lines are cut at line feeds and compared without the spaces around them;
    other white space counts.  A document keeps its row even if no line is left.  A null text stays null
    and an empty one empty; rows that share a doc_id are one document; a null
    doc_id is a keeper only if no other document has the line.  Other columns
    pass unchanged, but for one that is called ``lines_removed``.
    """
    left, gone = _stripped(docs, sites, long, long_sites, own)
    return left.drop("lines_removed").withColumnRenamed(gone, "lines_removed")


def keep(docs: DataFrame) -> DataFrame:
    """``docs`` without boilerplate lines, with the columns it had; a document of which only boilerplate was there goes."""
    left, gone = _stripped(docs, SITES, LONG, LONG_SITES, OWN)
    left = left.where((F.col(gone) == 0) | (F.trim(F.translate("text", "\n\r\t", "   ")) != ""))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(F.col(gone) == 0, F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return left.select(docs.columns)


#: The same for DuckDB, with exact counts throughout.
SQL = f"""
WITH lines AS (
  SELECT doc_id, source, list_distinct(list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '')) AS ls
  FROM documents
), seen AS (
  SELECT *, len(string_split(line, ' ')) AS words FROM (SELECT doc_id, source, unnest(ls) AS line FROM lines)
), often AS (
  SELECT line, min(doc_id) AS keeper FROM seen GROUP BY line HAVING count(*) >= {min(SITES, LONG_SITES)}
), bodies AS (
  SELECT doc_id, min(CAST('0x' || substr(md5(line), 1, 15) AS bigint)) FILTER (often.line IS NULL) AS body, coalesce(sum(words) FILTER (often.line IS NULL), 0) AS own, sum(words) AS every
  FROM seen LEFT JOIN often USING (line) GROUP BY doc_id
), bad AS (
  SELECT line, any_value(keeper) AS keeper FROM seen JOIN often USING (line) LEFT JOIN bodies USING (doc_id) GROUP BY line
  HAVING least(count(DISTINCT source), count(DISTINCT body) FILTER (own >= {OWN} * (every - words))) >= CASE WHEN any_value(words) >= {LONG} THEN {LONG_SITES} ELSE {SITES} END
), hit AS (
  SELECT seen.doc_id, list(DISTINCT seen.line) AS bad FROM seen JOIN bad USING (line) WHERE seen.doc_id IS DISTINCT FROM bad.keeper GROUP BY seen.doc_id
)
SELECT d.doc_id,
  CASE WHEN h.bad IS NULL THEN d.text ELSE array_to_string(list_filter(string_split(d.text, chr(10)), lambda x: NOT list_contains(h.bad, trim(x, ' '))), chr(10)) END AS text,
  CASE WHEN h.bad IS NULL THEN 0 ELSE len(list_filter(string_split(d.text, chr(10)), lambda x: list_contains(h.bad, trim(x, ' ')))) END AS lines_removed
FROM documents d LEFT JOIN hit h ON d.doc_id IS NOT DISTINCT FROM h.doc_id
"""
