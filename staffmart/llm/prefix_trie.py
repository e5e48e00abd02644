"""The prefix trie of conversations, from sorted common prefixes (operator 11).

A conversation is the sequence of its turns; a turn is a 16-byte digest of
(role, text). Sorted by their digests, the conversations that start with one
prefix lie side by side, and two neighbours have as many turns in common as the
longest common prefix (LCP) of their keys. A prefix of d turns, met at some
row, reaches left and right as far as no LCP in between is below d. Every
candidate prefix finds both ends alone, by binary search over a sparse table
of range minima: no stack, no order among candidates.

All that a node reports is then a sum or a minimum over the rows of its
interval: members, the smallest member, children (rows that start one), leaves
(rows whose successor does not extend them), and the tokens that sharing
saves, for with W(j, d) the words of the first d turns of row j,

    saved(node of depth d) = sum of W(j, LCP(j)) over its rows but the first
                             - (members - 1) * W(d - 1).

How it is spread: rows are sorted by ranges of (key, conv_id), so that copies
of one conversation, whatever their number, are spread over ranges too. Each
range learns the last key before it and the first key behind it and builds its
own sparse table. Nodes that reach over a border, at most one per border and
depth, come out of each range as partial sums and are merged; all others are
complete. Tables are written to the shared folder between the steps, so a lost
executor costs a reread.

Defined results: a null role or text is empty; null turns come first, turns of
one number are ordered by their digest, and repeated turns count again; rows
without a conv_id belong to no conversation and to no node; a very long text
is only digested, a conversation's digests (16 bytes a turn) have to fit one
task; no conversations, no root: an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from staffmart.llm.common import WORD_PATTERN, materialise, n_words

DIGEST_BYTES = 16
# Turns of one range: large ones save borders, small ones keep more cores busy.
BLOCK_TURNS, LEAST_TURNS = 200_000, 10_000

# Fixed values of the query's rebuilding rule.
BASE_EVERY = 20
HEADS = 4


# --------------------------------------------------------------- sequences


def turn_lists(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): digests and words of each conversation's turns, in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    return (turns.filter(F.col("conv_id").isNotNull())
            .select(F.col("conv_id").cast("long").alias("conv_id"),
                    F.struct(F.col("turn").alias("turn"), digest.alias("digest"),
                             n_words(text).alias("words")).alias("item"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list("item")).alias("turns")))


def rebuilt(lists: DataFrame) -> DataFrame:
    """The first h turns of every conversation taken from the one that begins its group of ``BASE_EVERY``."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    bases = lists.filter(F.col("conv_id") % BASE_EVERY == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, HEADS - 1).alias("head"))
    own = lists.withColumn("base", F.col("conv_id") - F.col("conv_id") % BASE_EVERY).withColumn("h", h)
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return own.join(bases, "base", "left").select("conv_id", F.concat(head, rest).alias("turns"))


def sequences(lists: DataFrame) -> DataFrame:
    """(conv_id, key, words): the digests as one binary, the words per turn."""
    return lists.select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("key"),
        F.transform("turns", lambda t: t["words"]).alias("words"))


# ------------------------------------------------------- intervals of a range


def common_turns(a: bytes, b: bytes) -> int:
    """Turns that two keys have in common at their start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // DIGEST_BYTES
    differ = np.frombuffer(a, np.uint64, n // 8) != np.frombuffer(b, np.uint64, n // 8)
    return int(differ.argmax()) * 8 // DIGEST_BYTES


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """``table[k][i]`` is the minimum of the 2^k values from i on."""
    table = [values]
    while 2 ** len(table) <= len(values):
        half, last = 2 ** (len(table) - 1), table[-1]
        table.append(np.minimum(last[:-half], last[half:]))
    return table


def range_minimum(table: list[np.ndarray], first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Minimum of the values from ``first`` to ``last``, both included."""
    out = np.empty(len(first), table[0].dtype)
    level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
    for k in np.unique(level):
        own = level == k
        out[own] = np.minimum(table[k][first[own]], table[k][last[own] - 2 ** int(k) + 1])
    return out


def right_end(table: list[np.ndarray], row: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The last row that shares ``depth`` turns with ``row``: the LCPs behind it stay at least that."""
    at, n = row.copy(), len(table[0])
    for k in reversed(range(len(table))):
        step = 2 ** k
        can = np.flatnonzero(at + step < n)
        go = can[table[k][at[can] + 1] >= depth[can]]
        at[go] += step
    return at


def left_end(table: list[np.ndarray], row: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The first row that shares ``depth`` turns with ``row``."""
    at = row.copy()
    for k in reversed(range(len(table))):
        step = 2 ** k
        can = np.flatnonzero(at - step >= 0)
        go = can[table[k][at[can] - step + 1] >= depth[can]]
        at[go] -= step
    return at


def prefix_ids(key: bytes, depth: int) -> list[bytes]:
    """Digests of the key's prefixes of 0 to ``depth`` turns."""
    digest, out = hashlib.sha256(), []
    for d in range(depth + 1):
        out.append(digest.copy().digest()[:DIGEST_BYTES])
        digest.update(key[d * DIGEST_BYTES:(d + 1) * DIGEST_BYTES])
    return out


PARTIAL = ("node binary, depth long, conv_id long, n_convs long, n_children long, n_leaves long, shared long, "
           "words_before long, parent binary, parent_conv_id long, block long, ends string, ends_sha256 string")
_PARTIAL_TYPE = pa.schema([
    ("node", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("shared", pa.int64()), ("words_before", pa.int64()),
    ("parent", pa.binary()), ("parent_conv_id", pa.int64()), ("block", pa.int64()), ("ends", pa.string()),
    ("ends_sha256", pa.string())])


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def range_nodes(block: int, rows: list[tuple[bytes, int, list[int]]], before: bytes | None,
                behind: bytes | None) -> pa.Table:
    """The nodes of one range of sorted (key, conv_id, words).

    ``before`` and ``behind`` are the neighbouring keys, None at the ends of
    the table. A node that reaches over a border has ``node`` (its prefix's
    digest) and sums over this range alone; its other columns hold for all of
    it. A node whose parent does so has ``parent`` in place of parent_conv_id.
    """
    keys = [k for k, _, _ in rows]
    ids = np.array([c for _, c, _ in rows], np.int64)
    n = len(rows)
    length = np.array([len(k) // DIGEST_BYTES for k in keys], np.int64)
    lcp = np.array([-1 if before is None else common_turns(before, keys[0]),
                    *(common_turns(a, b) for a, b in zip(keys, keys[1:], strict=False))], np.int64)
    border = -1 if behind is None else common_turns(keys[-1], behind)
    following = np.append(lcp[1:], border)
    total = np.concatenate([[0], np.cumsum([w for _, _, ws in rows for w in ws], dtype=np.int64)])
    offset = np.concatenate([[0], np.cumsum(length)])[:-1]

    def words(row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Words of the first ``depth`` turns of ``row``."""
        return total[offset[row] + np.maximum(depth, 0)] - total[offset[row]]

    def before_row(values: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(values)])

    # candidates: each prefix at the row where it starts, and at row 0 those that started before it
    start = lcp + 1
    start[0] = 0
    n_own = length - start + 1
    first = np.concatenate([[0], np.cumsum(n_own)])[:-1]
    row = np.repeat(np.arange(n), n_own)
    depth = np.arange(len(row)) - first[row] + start[row]
    table = sparse_table(lcp)
    left, right = left_end(table, row, depth), right_end(table, row, depth)
    goes_on = (left == 0) & (depth <= lcp[0])  # started in an earlier range
    crosses = goes_on | ((right == n - 1) & (depth <= border))
    parent_row = left_end(table, row, np.maximum(depth - 1, 0))
    parent = first[parent_row] + depth - 1 - start[parent_row]

    members = right - left + 1
    smallest = range_minimum(sparse_table(ids), left, right)
    children = np.bincount(parent[~goes_on & (depth > 0)], minlength=len(row))
    leaves = before_row(following < length)
    common = before_row(words(np.arange(n), lcp))
    shared = common[right + 1] - common[left + np.where(goes_on, 0, 1)]

    # members that end at a node come first in it, and lie in a run of equal keys
    run_end = np.zeros(n, np.int64)
    same = (following == length) & np.append(length[1:] == length[:-1], False)
    last = n - 1
    for j in reversed(range(n)):
        last = last if same[j] else j
        run_end[j] = last
    names = [str(c) for c in ids.tolist()]
    ends = [",".join(names[r:run_end[r] + 1]) if length[r] == d else ""
            for r, d in zip(row.tolist(), depth.tolist(), strict=True)]

    at_left = prefix_ids(keys[0], max(0, int(lcp[0])))
    at_right = prefix_ids(keys[-1], max(0, border))

    def node_id(i: int) -> bytes:
        d = int(depth[i])
        return at_left[d] if goes_on[i] else at_right[d]

    crossing = crosses.tolist()
    has_parent = (depth > 0).tolist()
    of_parent = parent.tolist()
    open_parent = [h and crossing[p] for h, p in zip(has_parent, of_parent, strict=True)]
    return pa.Table.from_arrays([
        pa.array([node_id(i) if c else None for i, c in enumerate(crossing)], pa.binary()),
        pa.array(depth), pa.array(smallest), pa.array(members), pa.array(children),
        pa.array(leaves[right + 1] - leaves[left]), pa.array(shared), pa.array(words(row, depth - 1)),
        pa.array([node_id(p) if o else None for p, o in zip(of_parent, open_parent, strict=True)], pa.binary()),
        pa.array([int(smallest[p]) if h and not o else None for p, h, o in zip(
            of_parent, has_parent, open_parent, strict=True)], pa.int64()),
        pa.array(np.full(len(row), block)),
        pa.array([e if c and e else None for e, c in zip(ends, crossing, strict=True)], pa.string()),
        pa.array([None if c else sha256_hex(e) for e, c in zip(ends, crossing, strict=True)], pa.string()),
    ], schema=_PARTIAL_TYPE)


# ------------------------------------------------------------------ the trie


def _in_ranges(rows: DataFrame, ranges: int | None) -> DataFrame:
    """``rows`` with ``block``: ranges of (key, conv_id), numbered in order."""
    if ranges is None:
        turns = rows.agg(F.sum(F.size("words") + 1)).first()[0] or 0
        cores = rows.sparkSession.sparkContext.defaultParallelism
        ranges = max(1, math.ceil(turns / BLOCK_TURNS), min(cores, math.ceil(turns / LEAST_TURNS)))
    dealt = rows.repartitionByRange(ranges, "key", "conv_id")
    return materialise(dealt.withColumn("block", F.spark_partition_id().cast("long")), "ranges")


def _neighbours(ranges: DataFrame) -> DataFrame:
    """(block, before, behind): one row per range."""
    ends = ranges.groupBy("block").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    order = W.orderBy("block")
    return materialise(ends.select("block", F.lag("last").over(order).alias("before"),
                                   F.lead("first").over(order).alias("behind")), "borders")


def _range_task(rows: pa.Table, borders: pa.Table) -> pa.Table:
    order = sorted(zip(*(rows.column(c).to_pylist() for c in ("key", "conv_id", "words")), strict=True),
                   key=lambda r: r[:2])
    if not order:
        return _PARTIAL_TYPE.empty_table()
    return range_nodes(rows.column("block")[0].as_py(), order, borders.column("before")[0].as_py(),
                       borders.column("behind")[0].as_py())


def _streamed_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash per node over its ranges' lists; only the running hash is held."""
    node, digest, done = None, hashlib.sha256(), []
    for batch in batches:
        for key, ends in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if key == node:
                digest.update(b",")
            else:
                if node is not None:
                    done.append((node, digest.hexdigest()))
                node, digest = key, hashlib.sha256()
            digest.update(ends.encode())
    if node is not None:
        done.append((node, digest.hexdigest()))
    if done:
        yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in done], pa.binary()),
                                          pa.array([h for _, h in done], pa.string())],
                                         names=["node", "ends_sha256"])


def trie(rows: DataFrame, ranges: int | None = None) -> DataFrame:
    """One row per node of the trie of (conv_id, key, words); conv_id must not repeat.

    The result is the same for every number of ``ranges``; without one it
    follows the number of turns.
    """
    placed = _in_ranges(materialise(rows, "sequences"), ranges)
    parts = placed.groupBy("block").cogroup(_neighbours(placed).groupBy("block")).applyInArrow(
        _range_task, PARTIAL)
    parts = materialise(parts, "range-nodes")
    saved = (F.col("shared") - (F.col("n_convs") - 1) * F.col("words_before")).alias("saved_tokens")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", saved, "ends_sha256"]

    over = parts.filter("node IS NOT NULL")
    ends = (over.filter("ends IS NOT NULL").select("node", "block", "ends")
            .repartition("node").sortWithinPartitions("node", "block")
            .mapInArrow(_streamed_ends, "node binary, ends_sha256 string"))
    merged = over.groupBy("node").agg(
        F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "shared")],
        F.max("words_before").alias("words_before"), F.max("parent").alias("parent"))
    merged = merged.join(ends, "node", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(sha256_hex(""))))
    merged = materialise(merged, "border-nodes")
    parents = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))

    whole = parts.filter("node IS NULL")
    return (whole.filter("parent IS NULL").select(*columns)
            .unionByName(whole.filter("parent IS NOT NULL").drop("parent_conv_id")
                         .join(parents, "parent").select(*columns))
            .unionByName(merged.join(parents, "parent", "left").select(*columns)))


# --------------------------------------------------------------- the query


def op11_prefix_trie(turns: DataFrame) -> DataFrame:
    return trie(sequences(rebuilt(turn_lists(turns))))


OP11_SQL = f"""
WITH numbered AS (
  SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
         CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD_PATTERN}')) AS BIGINT) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
lists AS (
  SELECT conv_id, list(digest ORDER BY turn NULLS FIRST, digest) AS digests,
         list(words ORDER BY turn NULLS FIRST, digest) AS words,
         -- CRC-32 of the decimal conv_id, eight shifts a byte
         xor(list_reduce(list_prepend(4294967295::BIGINT,
               list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
             lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
               lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % {HEADS} AS h
  FROM numbered GROUP BY conv_id),
built AS (
  SELECT c.conv_id, coalesce(b.digests[1:c.h], []) || c.digests[c.h + 1:] AS digests,
         coalesce(b.words[1:c.h], []) || c.words[c.h + 1:] AS words
  FROM lists c LEFT JOIN lists b ON b.conv_id = c.conv_id - c.conv_id % {BASE_EVERY}),
prefixes AS (
  SELECT conv_id, d, array_to_string(digests[1:d], '') AS node, len(digests) = d AS ends,
         CASE WHEN d > 0 THEN array_to_string(digests[1:d - 1], '') END AS parent,
         CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words
  FROM (SELECT *, unnest(range(0, len(digests) + 1)) AS d FROM built)),
nodes AS (
  SELECT node, any_value(parent) AS parent, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         any_value(words) AS words,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
judged AS (
  SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.node = n.node),
-- every node with each prefix of its own, itself included: its ancestors
up AS (
  SELECT n_children, n_convs, words, substr(node, 1, 32 * a) AS ancestor
  FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM judged)),
below AS (
  SELECT ancestor, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
  FROM up GROUP BY ancestor)
SELECT j.conv_id, CAST(j.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, j.n_convs, j.n_children,
       b.n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, j.ends_sha256
FROM judged j JOIN below b ON b.ancestor = j.node LEFT JOIN judged p ON p.node = j.parent
"""
