"""Document fingerprints as invertible Bloom lookup sketches (operator 9).

A text is cut into pieces: its paragraphs (lines), these into sentences, and
long sentences into runs of ``PIECE_CHARS`` code points. Each piece, numbered
if it occurs again, has a 64-bit digest that is added to ``HASHES`` cells of a
small table (count, exclusive or of digests, exclusive or of checks). Two
tables are subtracted cell by cell; cells that hold one digest alone are
peeled until the table is empty, which yields the digests that differ. If
peeling gets stuck, both texts are sketched again with at least twice the
cells, until it succeeds. The tables of a slice of texts lie side by side and
are peeled together. The likeness of two texts is the share of their pieces that they
have in common.

Defined results: a null text is empty; two texts without pieces are equal
(likeness 1); equal texts have equal fingerprints; rows are followed by the
next larger doc_id, rows of one doc_id by a hash of their text, null ids come
first, and the last row is followed by the first; a single row follows itself;
an empty table gives an empty result; extra columns are ignored; a very long
text is a slice of its own and has to fit one task.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from staffmart.llm.common import materialise, slices

CELLS = 24
HASHES = 3
PIECE_CHARS = 160
_SENTENCE_ENDS = re.compile(r"(?<=[.!?])[ \t]+")
_MULTIPLY = np.uint64(0xBF58476D1CE4E5B9)
_SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
_CHECK = np.uint64(0xD6E8FEB86659FD93)
_OCCURRENCE = np.uint64(0x9FB21C651E98DF25)


def pieces(text: str) -> list[str]:
    out = []
    for line in text.split("\n"):
        for sentence in _SENTENCE_ENDS.split(line):
            if len(sentence) <= PIECE_CHARS:
                if sentence:
                    out.append(sentence)
            else:
                out += [sentence[i:i + PIECE_CHARS] for i in range(0, len(sentence), PIECE_CHARS)]
    return out


@dataclass(frozen=True)
class Digests:
    """The digests of several texts: those of text i are ``keys[starts[i]:starts[i + 1]]``, in order, each once."""

    keys: np.ndarray
    starts: np.ndarray

    def sizes(self) -> np.ndarray:
        return np.diff(self.starts)

    def take(self, which: np.ndarray) -> Digests:
        parts = [self.keys[self.starts[i]:self.starts[i + 1]] for i in which.tolist()]
        starts = np.concatenate([[0], np.cumsum(self.sizes()[which])]).astype(np.int64)
        return Digests(np.concatenate([np.zeros(0, np.uint64), *parts]), starts)


def digests_of(texts: Sequence[str]) -> Digests:
    """A set of digests per text, one per piece; the second occurrence of a piece differs from the first."""
    hashes, numbers, counts = [], [], []
    for text in texts:
        seen: dict[str, int] = {}
        before = len(hashes)
        for piece in pieces(text):
            n = seen.get(piece, 0)
            seen[piece] = n + 1
            hashes.append(xxhash.xxh3_64_intdigest(piece.encode("utf-8", "surrogatepass")))
            numbers.append(n)
        counts.append(len(hashes) - before)
    with np.errstate(over="ignore"):
        keys = _mix(np.array(hashes, dtype=np.uint64) + np.array(numbers, dtype=np.uint64) * _OCCURRENCE)
    # a table can only be peeled if no key is in it twice
    owner = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    first = np.ones(len(keys), bool)
    first[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    sizes = np.bincount(owner[first], minlength=len(counts))
    return Digests(keys[first], np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))


def digests(text: str) -> np.ndarray:
    return digests_of([text]).keys


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * _MULTIPLY
        return x ^ (x >> np.uint64(29))


def places(keys: np.ndarray, cells: np.ndarray | int) -> np.ndarray:
    """HASHES cells of each key, one in each part of its table of ``cells``."""
    part = (np.broadcast_to(cells, keys.shape) // HASHES).astype(np.uint64)[:, None]
    own = _mix(keys[:, None] ^ _SEEDS[None, :]) % part
    return (own + np.arange(HASHES, dtype=np.uint64)[None, :] * part).astype(np.int64)


def checks(keys: np.ndarray) -> np.ndarray:
    return _mix(keys ^ _CHECK) >> np.uint64(32)


class Sketches:
    """Tables of several texts side by side: count, key and check sums of their cells."""

    def __init__(self, of: Digests, cells: np.ndarray):
        self.sizes, self.cells = of.sizes(), cells
        self.starts = np.concatenate([[0], np.cumsum(cells)]).astype(np.int64)
        total = int(self.starts[-1])
        owner = np.repeat(np.arange(len(cells)), self.sizes)
        at = (places(of.keys, cells[owner]) + self.starts[owner][:, None]).ravel()
        self.counts = np.bincount(at, minlength=total).astype(np.int64)
        self.keys, self.checks = np.zeros(total, dtype=np.uint64), np.zeros(total, dtype=np.uint64)
        np.bitwise_xor.at(self.keys, at, np.repeat(of.keys, HASHES))
        np.bitwise_xor.at(self.checks, at, np.repeat(checks(of.keys), HASHES))

    def text(self, i: int = 0) -> str:
        own = slice(self.starts[i], self.starts[i + 1])
        raw = b"".join([self.counts[own].astype("<i4").tobytes(), self.keys[own].astype("<u8").tobytes(),
                        self.checks[own].astype("<u4").tobytes()])
        return f"{self.sizes[i]}:{self.cells[i]}:{base64.b64encode(raw).decode()}"

    @classmethod
    def parse(cls, text: str) -> Sketches:
        size, cells, raw = text.split(":")
        out, data, n = cls.__new__(cls), base64.b64decode(raw), int(cells)
        out.sizes, out.cells, out.starts = np.array([int(size)]), np.array([n]), np.array([0, n])
        out.counts = np.frombuffer(data, "<i4", n).astype(np.int64)
        out.keys = np.frombuffer(data, "<u8", n, 4 * n).astype(np.uint64)
        out.checks = np.frombuffer(data, "<u4", n, 12 * n).astype(np.uint64)
        return out

    def take(self, which: np.ndarray) -> Sketches:
        """Tables of equal size only."""
        out, n = Sketches.__new__(Sketches), int(self.cells[0]) if len(self.cells) else 0
        out.sizes, out.cells = self.sizes[which], self.cells[which]
        out.starts = np.arange(len(which) + 1, dtype=np.int64) * n
        for name in ("counts", "keys", "checks"):
            setattr(out, name, getattr(self, name).reshape(-1, max(n, 1))[which].ravel())
        return out


def sketch(keys: np.ndarray, cells: int = CELLS) -> Sketches:
    """The table of one text."""
    return Sketches(Digests(keys, np.array([0, len(keys)])), np.array([cells]))


def differences(a: Sketches, b: Sketches) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(recovered, only in a, only in b) per pair of tables, and all peeled (keys, pair * 2 + side).

    All pairs are peeled at once. A cell is peeled if it holds one key alone:
    its check agrees and the cell is one of the key's own, else the key is a
    sum of others whose checks agree by chance. A pair that yields more keys
    than both tables hold is such a case as well, and is given up; so every
    round brings each pair nearer to its end.
    """
    counts, keys, sums = a.counts - b.counts, a.keys ^ b.keys, a.checks ^ b.checks
    pair = np.repeat(np.arange(len(a.cells)), a.cells)
    only = np.zeros((len(a.cells), 2), dtype=np.int64)
    most = a.sizes + b.sizes
    given_up = np.zeros(len(a.cells), bool)
    all_keys, all_sides = [], []
    live = np.flatnonzero(counts)
    while len(live):
        pure = live[np.abs(counts[live]) == 1]
        pure = pure[(checks(keys[pure]) == sums[pure]) & ~given_up[pair[pure]]]
        at = places(keys[pure], a.cells[pair[pure]]) + a.starts[pair[pure]][:, None]
        own = (at == pure[:, None]).any(axis=1)
        pure, at = pure[own], at[own]
        if not len(pure):
            break
        order = np.lexsort((keys[pure], pair[pure]))
        pure, at = pure[order], at[order]
        once = np.ones(len(pure), bool)
        once[1:] = (keys[pure[1:]] != keys[pure[:-1]]) | (pair[pure[1:]] != pair[pure[:-1]])
        pure, at = pure[once], at[once].ravel()
        found, signs, of = keys[pure], counts[pure], pair[pure]
        np.subtract.at(counts, at, np.repeat(signs, HASHES))
        np.bitwise_xor.at(keys, at, np.repeat(found, HASHES))
        np.bitwise_xor.at(sums, at, np.repeat(checks(found), HASHES))
        side = (signs < 0).astype(np.int64)
        np.add.at(only, (of, side), 1)
        all_keys.append(found)
        all_sides.append(2 * of + side)
        given_up = only.sum(axis=1) > most
        live = np.unique(at)
    rest = (counts != 0) | (keys != 0) | (sums != 0)
    recovered = (np.bincount(pair[rest], minlength=len(a.cells)) == 0) & ~given_up
    none = np.zeros(0, np.int64)
    return (recovered, only[:, 0], only[:, 1], np.concatenate([none.astype(np.uint64), *all_keys]),
            np.concatenate([none, *all_sides]))


def difference(a: Sketches, b: Sketches) -> tuple[set[int], set[int]] | None:
    """Digests only in a, and only in b, of one pair; None if peeling gets stuck."""
    recovered, _, _, keys, sides = differences(a, b)
    if not recovered[0]:
        return None
    return set(keys[sides == 0].tolist()), set(keys[sides == 1].tolist())


def likenesses(x: Digests, y: Digests, a: Sketches, b: Sketches) -> np.ndarray:
    """Common share of the pieces per pair; a, b: the small sketches of the digests x, y."""
    sizes = np.stack([x.sizes(), y.sizes()])
    only = np.zeros((2, len(a.cells)), dtype=np.int64)
    cells = a.cells.copy()
    todo = np.arange(len(a.cells))
    while len(todo):
        recovered, left, right, *_ = differences(a, b)
        done = todo[recovered]
        only[0, done], only[1, done] = left[recovered], right[recovered]
        todo = todo[~recovered]
        # all pieces may differ: the first retry has room for that, later ones double
        cells[todo] = np.maximum(2 * cells[todo], HASHES * sizes.sum(axis=0)[todo] // 2)
        if len(todo):
            a, b = Sketches(x.take(todo), cells[todo]), Sketches(y.take(todo), cells[todo])
    common = sizes[0] - only[0]
    whole = common + only[0] + only[1]
    return np.where(whole > 0, common / np.maximum(whole, 1), 1.0)


def likeness(x: np.ndarray, y: np.ndarray, a: Sketches, b: Sketches) -> float:
    """``likenesses`` of one pair."""
    own = (Digests(k, np.array([0, len(k)])) for k in (x, y))
    return float(likenesses(*own, a, b)[0])


def edited_text(text: str, following: str) -> str:
    """The last quarter replaced by as many first code points of the next text, or all of it."""
    k = len(text) // 4
    return text[:len(text) - k] + following[:k]


def compared(rows: Sequence[tuple], own: np.ndarray) -> list[list]:
    """Result columns of the rows at ``own``, each compared to the row behind it; rows are (guest, doc_id, text)."""
    texts = [r[2] or "" for r in rows]
    edited = [edited_text(texts[i], texts[i + 1]) for i in own.tolist()]
    plain, changed = digests_of(texts), digests_of(edited)
    small = Sketches(plain, np.full(len(texts), CELLS))
    small_edited = Sketches(changed, np.full(len(edited), CELLS))
    mine, next_to = plain.take(own), plain.take(own + 1)
    mine_small = small.take(own)
    return [
        [rows[i][1] for i in own.tolist()], [len(texts[i]) for i in own.tolist()],
        [hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited],
        [small.text(i) for i in own.tolist()], [small_edited.text(i) for i in range(len(edited))],
        likenesses(mine, changed, mine_small, small_edited).tolist(),
        likenesses(mine, next_to, mine_small, small.take(own + 1)).tolist()]


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")
_RESULT_TYPE = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                          ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                          ("near_edited", pa.float64()), ("near_next", pa.float64())])
RANGES = 1


def range_of(doc_id: Column, bounds: list[int]) -> Column:
    """The number of bounds at or below the id, found in two short scans; null ids are in range 0."""
    if not bounds:
        return F.lit(0)
    width = max(1, int(len(bounds) ** 0.5))
    runs = [bounds[i:i + width] for i in range(0, len(bounds), width)]
    heads = F.array(*[F.lit(r[0]) for r in runs])
    body = F.array(*[F.array(*[F.lit(b) for b in r]) for r in runs])
    run = F.size(F.filter(heads, lambda b: b <= doc_id))
    inside = F.size(F.filter(F.get(body, run - 1), lambda b: b <= doc_id))
    return F.when(doc_id.isNull() | (run == 0), 0).otherwise((run - 1) * width + inside)


def with_next(docs: DataFrame) -> DataFrame:
    """Every row compared to its successor; texts are shuffled once.

    Ids are cut into ranges at quantiles, RANGES to each shuffle partition so
    that partitions come out even (the quantiles are all that the driver sees). Rows of the smallest id of
    a range are sent to the range before it as well, so that every task sees
    the successor of its last row.
    """
    spark = docs.sparkSession
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    ranges = RANGES * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    points = [i / ranges for i in range(1, ranges)]
    bounds = ids.agg(F.percentile_approx("doc_id", points, 10 * ranges)).first()[0] if points else None
    bounds = sorted(set(bounds or []))
    part = range_of(F.col("doc_id"), bounds)
    heads = ids.groupBy(part.alias("part")).agg(
        F.max(F.col("doc_id").isNull()).alias("nulls"), F.min("doc_id").alias("head"))
    heads = heads.withColumn("head", F.when(~F.col("nulls"), F.col("head")))
    # one row per range that holds rows: the range before it, the last before the first
    order = W.orderBy("part")
    before = F.coalesce(F.lag("part").over(order), F.max("part").over(W.partitionBy()))
    linked = materialise(heads.select("part", "head", before.alias("before")), "range-heads")
    # the rows that begin a range go to the range before it as well
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("part", range_of(F.col("doc_id"), bounds))
    at = rows.join(F.broadcast(linked), "part")  # at most `ranges` rows
    first = F.col("doc_id").eqNullSafe(F.col("head"))
    sent = at.select("doc_id", "text", F.explode(F.when(
        first, F.array(F.struct(F.col("part"), F.lit(False).alias("guest")),
                       F.struct(F.col("before").alias("part"), F.lit(True).alias("guest")))).otherwise(
            F.array(F.struct(F.col("part"), F.lit(False).alias("guest"))))).alias("to"))
    placed = (sent.select("to.part", "to.guest", "doc_id", "text")
              .repartition("part")
              .sortWithinPartitions("part", "guest", F.col("doc_id").asc_nulls_first(), F.xxhash64("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []  # the last row, until its successor comes
        for batch in batches:
            for chunk in slices(batch, "text"):
                rows = waiting + list(zip(*[chunk.column(c).to_pylist() for c in ("guest", "doc_id", "text")],
                                          strict=True))
                # a guest is only there for the row before it
                waiting = [] if rows[-1][0] else rows[-1:]
                own = np.flatnonzero([not r[0] for r in rows[:-1]])
                if len(own):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t.type) for c, t in zip(compared(rows, own), _RESULT_TYPE, strict=True)],
                        schema=_RESULT_TYPE)

    return placed.mapInArrow(run, RESULT)


# --------------------------------------------------------------- the query


def op9_fingerprints(docs: DataFrame) -> DataFrame:
    return with_next(docs)
