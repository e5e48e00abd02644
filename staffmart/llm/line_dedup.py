"""Removing lines that many documents share (operator 5).

A line's key is the line without blanks at its ends and with A-Z lowered. A
key of at least ``min_chars`` code points that ``min_docs`` documents hold
loses all its lines, but for those of the largest doc_id that holds it.

Texts are split and hashed once: the hashes of the keys (128 bits), with their
document and position, are a narrow table of their own. It is dealt out by
ranges of (hash, document), so that a hash that a third of all documents hold
is spread over many ranges, and sorted inside them by document, largest first,
and position; so a document's positions of a hash come out in order and once.
Which document holds a hash first is then the maximum over the ranges, from
one partial row per hash and task. What comes back is one bitmap per document,
written as run lengths (kept, dropped, kept, ...), not text.

Defined results: a null or empty text is one empty line; rows with a null
doc_id are one document smaller than all others; repeated rows (same doc_id
and text) count once and are treated alike; rows that share only their doc_id
count as documents of their own; very long texts are split whole, and each
line is a row; an empty table gives an empty result; extra columns of any name
are kept by ``without_shared_lines``.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffmart.llm.common import BLANKS, fresh, materialise

MIN_CHARS = 20
MIN_DOCS = 3


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def shared_lines(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """(doc_id, text_key, positions): the lines to drop, per key and document."""
    lines = docs.select("doc_id", text_key(F.col("text")).alias("text_key"),
                        F.posexplode(lines_of(F.col("text"))).alias("position", "line"))
    keys = (lines.withColumn("line", line_key(F.col("line")))
            .filter(F.char_length("line") >= min_chars)
            .select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"),
                    "doc_id", "text_key", "position"))
    # written first: dealing out by ranges reads its rows twice, once for the quantiles
    keys = materialise(keys, "line-keys")
    order = [F.col("h1"), F.col("h2"), F.col("doc_id").desc_nulls_last(), F.col("text_key")]
    ranged = keys.repartitionByRange(*order).sortWithinPartitions(*order, "position")
    # the ranges already hold each (hash, document) whole: no shuffle here
    held = ranged.groupBy("h1", "h2", "doc_id", "text_key").agg(
        F.array_distinct(F.collect_list("position")).alias("positions"))
    held = materialise(held, "line-hashes")
    first = held.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("holders"),
                                         F.max("doc_id").alias("keeper"))
    # written, so that the join below sees its true size and can split a hot hash
    shared = materialise(first.filter(F.col("holders") >= min_docs).drop("holders"), "shared-lines")
    return (held.join(shared, ["h1", "h2"])
            .filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
            .select("doc_id", "text_key", "positions"))


def runs_of(dropped: Column) -> Column:
    """Run lengths (kept, dropped, ..., dropped) of sorted positions, up to the last dropped line."""
    starts = F.filter(dropped, lambda p, i: (i == 0) | (F.get(dropped, i - 1) != p - 1))
    after = F.transform(
        F.filter(dropped, lambda p, i: (i == F.size(dropped) - 1) | (F.get(dropped, i + 1) != p + 1)),
        lambda p: p + 1)
    before = F.concat(F.array(F.lit(0)), after)
    runs = F.arrays_zip(starts.alias("start"), after.alias("after"), before.alias("before"))
    pairs = F.transform(F.filter(runs, lambda z: z["start"].isNotNull()),
                        lambda z: F.array(z["start"] - z["before"], z["after"] - z["start"]))
    return F.flatten(pairs)


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, text_key, runs) of the documents that lose a line."""
    drops = shared_lines(docs, min_chars, min_docs)
    merged = drops.groupBy("doc_id", "text_key").agg(
        F.array_sort(F.flatten(F.collect_list("positions"))).alias("dropped"))
    return merged.select("doc_id", "text_key", runs_of(F.col("dropped")).alias("runs"))


def apply_bitmap(lines: Column, runs: Column) -> Column:
    """The lines whose bit is kept; those after the last run are kept too."""
    bits = F.flatten(F.transform(runs, lambda n, i: F.array_repeat((i % 2).cast("int"), n)))
    marked = F.arrays_zip(lines.alias("line"), F.coalesce(bits, F.array().cast("array<int>")).alias("drop"))
    kept = F.filter(marked, lambda z: F.coalesce(z["drop"], F.lit(0)) == 0)
    return F.transform(kept, lambda z: z["line"])


def with_kept_lines(docs: DataFrame, kept: str, min_chars: int, min_docs: int) -> DataFrame:
    """``docs`` with an array column ``kept`` of the lines that stay."""
    key, runs, doc = fresh(docs, "text_key_"), fresh(docs, "runs_"), fresh(docs, "doc_id_")
    maps = keep_bitmaps(docs, min_chars, min_docs).select(
        F.col("doc_id").alias(doc), F.col("text_key").alias(f"{key}_"), F.col("runs").alias(runs))
    keyed = docs.withColumn(key, text_key(F.col("text")))
    joined = keyed.join(maps, keyed["doc_id"].eqNullSafe(maps[doc]) & (keyed[key] == maps[f"{key}_"]),
                        "left")
    return (joined.withColumn(kept, apply_bitmap(lines_of(F.col("text")), F.col(runs)))
            .drop(key, f"{key}_", runs, doc))


def without_shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS,
                         min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the shared lines taken out of ``text``; a null text stays null."""
    kept = fresh(docs, "kept_")
    out = with_kept_lines(docs, kept, min_chars, min_docs)
    text = F.when(F.col("text").isNotNull(), F.array_join(kept, "\n"))
    return out.withColumn("text", text).select(*[F.col(f"`{c}`") for c in docs.columns])


# --------------------------------------------------------------- the query


def op5_line_dedup(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    out = with_kept_lines(docs, "kept", MIN_CHARS, MIN_DOCS)
    n_lines = F.size(lines_of(F.col("text")))
    return out.select("doc_id", n_lines.cast("long").alias("n_lines"),
                      (n_lines - F.size("kept")).cast("long").alias("n_dropped"),
                      F.sha2(F.array_join("kept", "\n").cast("binary"), 256).alias("kept_sha256"))


OP5_SQL = f"""
WITH split AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS t,
         string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (
  SELECT row_id, doc_id, t, ls[CAST(p AS INT)] AS line, p,
         translate(trim(ls[CAST(p AS INT)], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key
  FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS p FROM split)),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM (SELECT DISTINCT key, doc_id, t FROM lines WHERE length(key) >= {MIN_CHARS})
  GROUP BY key HAVING count(*) >= {MIN_DOCS}),
judged AS (
  SELECT l.*, s.key IS NOT NULL AND l.doc_id IS DISTINCT FROM s.keeper AS dropped
  FROM lines l LEFT JOIN shared s ON l.key = s.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY row_id
"""
