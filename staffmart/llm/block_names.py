"""Exact duplicates by deterministic block names (operator 12).

A text without its blanks is cut into blocks of ``BLOCK_BYTES`` bytes. The
distinct blocks are sorted and numbered: equal blocks get one integer, others
another. Two adjacent names make a pair; the distinct pairs are sorted and
numbered in turn, and so on until each document has one name. The level at
which that happens follows from the number of blocks, so (level, name) is the
same for equal texts and for no others: no hash decides.

How it is spread:

- Only distinct blocks are shuffled as text (equal ones meet in the map tasks
  first), each into the sorted run of its partition; a name is the partition's
  number and the place in the run. Occurrences travel as (row, place, address)
  with a 128-bit address of the block, and meet the names there. An address
  decides nothing: a run whose blocks don't all have addresses of their own
  takes other ones (``_named_blocks``).
- A block that a third of all documents hold is one row among the names; its
  occurrences are joined to that row by a sort-merge join straight on both
  shuffles, which adaptive execution splits.
- Documents leave the loop at their own level; what goes on is a row of two
  integers per pair. The loop runs log2(blocks of the longest text) times.
- Each step is written to the shared folder, so a lost executor costs a
  reread.

Defined results: a null text is empty, and equal to a text of blanks only;
null and repeated doc_ids are rows of their own; of rows that also agree in
length and doc_id one stays (the smallest hash of the original text, then any
of the rows that agree in all of this), null ids come last; a very long text
is cut like any other; an empty table gives an empty result; extra columns of
any name are kept by ``distinct_documents`` and ignored by ``identities``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffmart.llm.common import BLANKS, discard, fresh, materialise

BLOCK_BYTES = 4096

# Stands for the missing right half of a pair; no name is negative.
ALONE = -1

Address = Callable[[Column, int], Column]


def two_hashes(block: Column, seed: int) -> Column:
    return F.struct(F.xxhash64(F.lit(2 * seed), block).alias("a"),
                    F.xxhash64(F.lit(2 * seed + 1), block).alias("b"))


def normalised(text: Column) -> Column:
    """The text without blanks; a null text is empty."""
    return reduce(lambda t, blank: F.replace(t, F.lit(blank), F.lit("")), BLANKS,
                  F.coalesce(text.cast("string"), F.lit("")))


def blocks_of(text: Column, size: int) -> Column:
    """The UTF-8 bytes in blocks of ``size``, the last one shorter; an empty text has one empty block."""
    def cut(data: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.octet_length(data), F.lit(1)), F.lit(size))
        return F.transform(starts, lambda at: F.substring(data, at, F.lit(size)))

    # bound to a variable, so that the text is worked out once and not once a block
    return F.get(F.transform(F.array(text.cast("binary")), cut), 0)


def numbered_in_order(distinct: DataFrame, by: list[str], name: str) -> DataFrame:
    """Add an integer per row of a frame of distinct rows, dealt out by a shuffle.

    Each partition is sorted and its rows numbered in that order, the
    partition's number in the upper bits: integers are unique, and a task that
    runs again gives the same ones.
    """
    return distinct.sortWithinPartitions(*by).withColumn(name, F.monotonically_increasing_id())


def _named_blocks(docs: DataFrame, size: int, address: Address) -> tuple[DataFrame, int]:
    """(a, b, name) of every distinct block, and the seed whose addresses (a, b) all differ.

    Should two blocks meet in one address, another seed is taken.
    """
    distinct = docs.select(F.explode(blocks_of(normalised(F.col("text")), size)).alias("block")).distinct()
    for seed in count():
        named = numbered_in_order(distinct, ["block"], "name").select(
            address(F.col("block"), seed).alias("at"), "name")
        named = materialise(named.select("at.*", "name"), "block-names")
        if named.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
            return named, seed
        discard(named)


def _upper_names(names: DataFrame, level: int) -> DataFrame:
    """Adjacent names of a document named as pairs; the last may stand alone."""
    halves = names.groupBy("row", F.shiftright("place", 1).alias("place")).agg(
        F.max(F.when(F.col("place") % 2 == 0, F.col("name"))).alias("left"),
        F.coalesce(F.max(F.when(F.col("place") % 2 == 1, F.col("name"))), F.lit(ALONE)).alias("right"),
        F.max("n").alias("n"))
    pairs = materialise(halves, f"pairs-{level}")
    named = materialise(numbered_in_order(pairs.select("left", "right").distinct(), ["left", "right"], "name"),
                        f"pair-names-{level}")
    return pairs.join(named, ["left", "right"]).select(
        "row", "place", "name", F.shiftright(F.col("n") + 1, 1).alias("n"))


def identities(docs: DataFrame, row: Column | None = None, size: int = BLOCK_BYTES,
               address: Address = two_hashes) -> DataFrame:
    """One row per document: row, doc_id, n_chars, text_sha256, order_key, level, name.

    (level, name) is equal for texts that are equal without blanks, and only
    for these. ``row`` must number the rows of ``docs``; without it they get
    numbers of their own. Results are the same for every ``size``; ``address``
    only spreads the blocks.
    """
    named, seed = _named_blocks(docs, size, address)
    original = F.coalesce("text", F.lit(""))
    rows = docs.select(
        (F.monotonically_increasing_id() if row is None else row).alias("row"), "doc_id",
        F.char_length(original).cast("long").alias("n_chars"),
        F.xxhash64(original).alias("order_key"), normalised(F.col("text")).alias("text"))
    rows = rows.select(
        "row", "doc_id", "n_chars", "order_key",
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
        F.transform(blocks_of(F.col("text"), size), lambda b: address(b, seed)).alias("at"))
    rows = materialise(rows, "rows")  # fixes the numbers
    places = rows.select("row", F.size("at").alias("n"), F.posexplode("at").alias("place", "at"))
    names = materialise(places.select("row", "n", "place", "at.*").join(named, ["a", "b"])
                        .select("row", "place", "name", "n"), "names-0")
    done: list[DataFrame] = []
    for level in count(1):
        done.append(names.filter("n = 1").select("row", F.lit(level - 1).alias("level"), "name"))
        rest = names.filter("n > 1")
        if rest.isEmpty():
            break
        names = materialise(_upper_names(rest, level), f"names-{level}")
    return rows.drop("at").join(reduce(DataFrame.unionByName, done), "row")


def groups(docs: DataFrame, row: Column | None = None, **options) -> DataFrame:
    """``identities`` with the group's keep_id and group_size, and ``kept``."""
    found = materialise(identities(docs, row, **options), "identities")
    best = F.min(F.struct((-F.col("n_chars")).alias("shorter"), F.col("doc_id").isNull().alias("no_id"),
                          "doc_id", "order_key", "row")).alias("best")
    stays = found.groupBy("level", "name").agg(best, F.count(F.lit(1)).alias("group_size")).select(
        "level", "name", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"))
    # written, so that the join below is one of two plain shuffles and a hot group can be split
    stays = materialise(stays.filter("group_size > 1"), "groups")
    alone = F.col("group_size").isNull()
    return found.join(stays, ["level", "name"], "left").select(
        *found.columns, F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"))


def distinct_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each group of equal texts."""
    row, kept = fresh(docs, "row_"), fresh(docs, "kept_")
    rows = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    stay = groups(rows, F.col(row), **options).filter("kept").select(F.col("row").alias(kept))
    return rows.join(stay, rows[row] == stay[kept], "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


# --------------------------------------------------------------- the query


def op12_exact_dedup(docs: DataFrame) -> DataFrame:
    return groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP12_SQL = """
WITH normal AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS n
  FROM documents),
placed AS (
  SELECT doc_id, n, count(*) OVER (PARTITION BY n) AS group_size,
         row_number() OVER best AS place, first_value(doc_id) OVER best AS keep_id
  FROM normal
  WINDOW best AS (PARTITION BY n ORDER BY length(t) DESC, doc_id ASC NULLS LAST))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(n) AS text_sha256 FROM placed
"""
