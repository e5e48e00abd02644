"""Removing repeated byte strings with a logarithmic index family (operator 6).

A byte goes when a string of ``LENGTH`` bytes that covers it also starts
anywhere else, in the same document or another one. Matches never cross
documents; overlaps count.

Sampled suffixes. Every window of ``LENGTH`` bytes names the suffix that
starts at its anchor, the leftmost ``GRAM``-byte gram with the smallest hash
in it. Equal windows have equal anchors at equal offsets, so only suffixes at
anchors (about one byte in 85) need to be indexed. A *run* is a stretch of
windows of one document with the same anchor; runs tile all windows.

The index family. Batches of documents arrive one after the other. The sorted
array of a batch's sampled suffixes (keyed by the hash of their first GRAM
bytes) is merge-scanned against the existing levels: suffixes found on both
sides are the starts of possible long matches. Levels of equal size merge into
one of the next size, so that a suffix is rewritten a logarithmic number of
times.

From starts to exact matches. Runs at a repeated anchor are compared whole:
equal runs (hash of all their bytes) match in every window. Where one anchor
has runs that differ, at the edges of copies, one copy of each goes, with its
bytes, to a task that compares their windows; anchors with more than
``GROUP_RUNS`` different runs are compared by a grouping of single windows
instead, so that no task holds a large group. Each text then loses the union
of its matched windows.

The repeated anchors reach the tasks as a bitmap of fixed size that only
spares work: runs it lets through by chance fall out in the joins.

Defined results: a null or empty text has no bytes; texts shorter than
``LENGTH`` keep all; rows are documents even if ids are null or repeated, so
repeated rows match each other; an empty table gives an empty result; extra
columns are ignored. Strings are compared by pairs of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staffmart.llm.common import discard, materialise, slices

LENGTH = 200
GRAM = 32
BATCHES = 4
SEED = 2024
# Windows handled at once: positions must fit into the low bits of a key.
CHUNK = 1 << 16
_LOW = np.uint64((1 << 20) - 1)
# Different runs of one anchor that one task may compare.
GROUP_RUNS = 20_000
# Bytes of runs that a task compares at once, group by group.
GROUP_BYTES = 300_000
SLICE_RUNS = 300_000
# Bits of the bitmap that spares work: 8 MB, whatever the input.
FILTER_BITS = 26
BUCKET_BITS = 32768

_rng = np.random.default_rng(SEED)
_BYTE = _rng.integers(1, 2**63, size=256, dtype=np.uint64)
_ODD = _rng.integers(1, 2**62, size=24, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(data: np.ndarray) -> dict[int, np.ndarray]:
    """Hashes of the strings of 1, 2, 4, ... 128 bytes at each place."""
    out, size, k = {1: _BYTE[data]}, 1, 0
    while size < 128:
        h = out[size]
        out[size * 2] = h[:len(h) - size] * _ODD[k] + h[size:]
        size, k = size * 2, k + 1
    return out


def _joined(h: dict[int, np.ndarray], length: int) -> np.ndarray:
    """Hashes of the strings of ``length`` bytes, put together from powers of two."""
    parts = [1 << b for b in range(7, -1, -1) if length >> b & 1]
    n = len(h[1]) - length + 1
    total, at = np.zeros(n, dtype=np.uint64), 0
    for j, size in enumerate(parts):
        total = total * _ODD[10 + j] + h[size][at:at + n]
        at += size
    return _mix(total)


class Runs:
    """The runs of some texts: row, first and last window, anchor hash, hash of all bytes."""

    def __init__(self, texts: list[bytes], hashes: bool = True):
        names = ("row", "first", "last", "anchor", "whole")
        columns: dict[str, list[np.ndarray]] = {k: [] for k in names}
        with np.errstate(over="ignore"):
            for rows, starts, data, lengths in _chunks(texts):
                self._add(columns, rows, starts, data, lengths, hashes)
        for k in names:
            kind = np.uint64 if k in ("anchor", "whole") else np.int64
            setattr(self, k, np.concatenate(columns[k]) if columns[k] else np.zeros(0, dtype=kind))

    def _add(self, columns: dict, rows: np.ndarray, starts: np.ndarray, data: np.ndarray,
             lengths: np.ndarray, hashes: bool) -> None:
        h = _powers(data)
        gram = _mix(h[GRAM])
        width = LENGTH - GRAM + 1  # grams in a window
        key = (gram & ~_LOW) | np.arange(len(gram), dtype=np.uint64)
        size = 1
        while size * 2 <= width:
            key = np.minimum(key[:len(key) - size], key[size:])
            size *= 2
        rest = width - size
        key = np.minimum(key[:len(key) - rest], key[rest:]) if rest else key
        anchor = (key & _LOW).astype(np.int64)  # per window
        # windows must not cross from one piece into the next
        piece = np.repeat(np.arange(len(lengths)), lengths)
        n = len(anchor)
        inside = piece[:n] == piece[LENGTH - 1:LENGTH - 1 + n]
        change = np.ones(n, dtype=bool)
        change[1:] = (anchor[1:] != anchor[:-1]) | (piece[1:n] != piece[:n - 1])
        first = np.flatnonzero(change & inside)
        ends = np.flatnonzero(inside & np.append(change[1:] | ~inside[1:], True))
        windows = _joined(h, LENGTH) if hashes else None
        at = piece[first]
        base = np.cumsum(lengths) - lengths
        columns["row"].append(rows[at])
        columns["first"].append(first - base[at] + starts[at])
        columns["last"].append(ends - base[at] + starts[at])
        columns["anchor"].append(gram[anchor[first]])
        columns["whole"].append(_mix(
            windows[first] * _ODD[20] + windows[ends] * _ODD[21]
            + (ends - first).astype(np.uint64) * _ODD[22]
            + (anchor[first] - first).astype(np.uint64) * _ODD[23]) if hashes
            else np.zeros(len(first), dtype=np.uint64))


def _chunks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, starts, bytes, lengths) of pieces put together up to about CHUNK bytes.

    A long text is cut into pieces that overlap by LENGTH - 1 bytes: every
    window lies in one. The cut splits a run only at a fixed place of its own
    document, so parts of a run may be compared window by window instead.
    """
    rows, starts, parts, size = [], [], [], 0
    for row, text in enumerate(texts):
        for at in range(0, len(text) - LENGTH + 1, CHUNK):
            piece = text[at:at + CHUNK + LENGTH - 1]
            rows.append(row)
            starts.append(at)
            parts.append(piece)
            size += len(piece)
            if size >= CHUNK:
                yield _together(rows, starts, parts)
                rows, starts, parts, size = [], [], [], 0
    if parts:
        yield _together(rows, starts, parts)


def _together(rows: list[int], starts: list[int], parts: list[bytes]) -> tuple:
    return (np.array(rows), np.array(starts), np.frombuffer(b"".join(parts), dtype=np.uint8),
            np.array([len(p) for p in parts]))


def _texts(part: pa.RecordBatch) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in part.column("text").to_pylist()]


def _mapped(docs: DataFrame, schema: str, make: Callable[[pa.RecordBatch, list[bytes]], pa.RecordBatch]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield make(part, _texts(part))

    return docs.mapInArrow(run, schema)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


# ------------------------------------------------------------ the index family


class IndexFamily:
    """Levels of sorted suffix keys (anchor, n); sizes are counted in batches."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.levels: list[tuple[int, DataFrame]] = []  # large to small
        self.found: list[DataFrame] = []

    def add(self, docs: DataFrame) -> None:
        """Index a batch: scan it against all levels, then merge levels of equal size."""
        array = suffix_array(docs)
        size, merging = 1, []
        while self.levels and self.levels[-1][0] == size:
            merging.append(self.levels.pop()[1])
            size *= 2
        if merging or self.levels:
            array = materialise(array, "suffix-batch")
        for _, level in self.levels:
            self.found.append(materialise(array.select("anchor").join(level.select("anchor"), "anchor"),
                                          "suffix-matches"))
        merged = array
        for level in merging:
            merged = merged.unionByName(level)
        if merging:  # the merge scans what it merges: equal suffixes meet here
            merged = merged.groupBy("anchor").agg(F.sum("n").alias("n")).sortWithinPartitions("anchor")
        merged = materialise(merged, "suffix-level")
        for old in ([array] if merging or self.levels else []) + merging:
            discard(old)
        self.levels.append((size, merged))

    def close(self) -> None:
        """Delete the files of all levels."""
        for old in [level for _, level in self.levels] + self.found:
            discard(old)
        self.levels, self.found = [], []

    def repeated(self) -> DataFrame:
        """Anchors of sampled suffixes that occur at least twice."""
        out = None
        for _, level in self.levels:
            own = level.filter("n > 1").select("anchor")
            out = own if out is None else out.union(own)
        for matches in self.found:
            out = out.union(matches)
        return out


def suffix_array(docs: DataFrame) -> DataFrame:
    """(anchor, n), sorted: the sampled suffixes of a batch with their counts."""
    def make(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        runs = Runs(texts, hashes=False)
        return pa.RecordBatch.from_arrays([_signed(runs.anchor)], names=["anchor"])

    keys = _mapped(docs.select("text"), "anchor long", make)
    return keys.groupBy("anchor").agg(F.count(F.lit(1)).cast("int").alias("n")).sortWithinPartitions("anchor")


def bitmap(anchors: DataFrame) -> np.ndarray:
    """Bits of pmod(anchor, 2^FILTER_BITS): at most 2,048 rows of 4 KB reach the driver."""
    value = F.pmod(F.col("anchor"), F.lit(1 << FILTER_BITS)) + 1  # Spark's buckets begin at 1
    rows = anchors.groupBy(F.bitmap_bucket_number(value).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits")).collect()
    out = np.zeros((1 << FILTER_BITS) // 8, dtype=np.uint8)
    for r in rows:
        bits = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
        start = (r["bucket"] - 1) * BUCKET_BITS // 8
        out[start:start + len(bits)] = bits
    return out


def in_bitmap(bits: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    place = (anchor & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


# ------------------------------------------------------------------ the matches


def repeated_runs(docs: DataFrame, index: IndexFamily) -> DataFrame:
    """(anchor, whole, doc_id, text_key, first, last): runs at repeated anchors, and a few others."""
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(index.repeated()))

    def make(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        runs = Runs(texts)
        on = in_bitmap(bits.value, runs.anchor)
        rows = pa.array(runs.row[on])
        return pa.RecordBatch.from_arrays(
            [_signed(runs.anchor[on]), _signed(runs.whole[on]), part.column("doc_id").take(rows),
             part.column("text_key").take(rows), pa.array(runs.first[on].astype(np.int32)),
             pa.array(runs.last[on].astype(np.int32))],
            names=["anchor", "whole", "doc_id", "text_key", "first", "last"])

    schema = "anchor long, whole long, doc_id long, text_key long, first int, last int"
    return materialise(_mapped(docs, schema, make), "repeated-runs")


def edge_runs(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """(anchor, whole, n, bytes): one copy of each run at anchors whose runs differ."""
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(mixed))

    def make(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        runs = Runs(texts)
        on = in_bitmap(bits.value, runs.anchor)
        cuts = [texts[r][a:b + LENGTH] for r, a, b in zip(
            runs.row[on].tolist(), runs.first[on].tolist(), runs.last[on].tolist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [_signed(runs.anchor[on]), _signed(runs.whole[on]), pa.array(cuts, pa.binary())],
            names=["anchor", "whole", "bytes"])

    found = _mapped(docs, "anchor long, whole long, bytes binary", make)
    return found.groupBy("anchor", "whole").agg(F.count(F.lit(1)).alias("n"), F.first("bytes").alias("bytes"))


def window_hashes(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(run, place, hash) of all windows of some runs."""
    data = np.frombuffer(b"".join(runs), dtype=np.uint8)
    lengths = np.array([len(r) for r in runs])
    with np.errstate(over="ignore"):
        windows = _joined(_powers(data), LENGTH)
    counts = lengths - LENGTH + 1
    run = np.repeat(np.arange(len(runs)), counts)
    place = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return run, place, windows[np.repeat(np.cumsum(lengths) - lengths, counts) + place]


PARTIAL = "anchor long, whole long, spans array<struct<start: int, end: int>>"


def matched_in_groups(rows: list[tuple[int, int, int, bytes]]) -> list[tuple[int, int, list]]:
    """Matched spans of the single runs among (anchor, whole, n, bytes) of whole groups."""
    run, place, windows = window_hashes([r[3] for r in rows])
    anchors = np.array([r[0] for r in rows], dtype=np.int64).view(np.uint64)
    with np.errstate(over="ignore"):
        keys = _mix(windows + anchors[run] * _ODD[19])
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    shared = np.zeros(len(keys), dtype=bool)
    shared[order[1:][same]] = True
    shared[order[:-1][same]] = True
    shared &= np.array([r[2] for r in rows])[run] == 1
    on = np.flatnonzero(shared)
    if not len(on):
        return []
    begins = np.ones(len(on), dtype=bool)
    begins[1:] = (run[on][1:] != run[on][:-1]) | (place[on][1:] != place[on][:-1] + 1)
    first = np.flatnonzero(begins)
    last = np.append(first[1:], len(on)) - 1
    spans: dict[int, list] = {}
    for r, a, b in zip(run[on][first].tolist(), place[on][first].tolist(), place[on][last].tolist(), strict=True):
        spans.setdefault(r, []).append({"start": a, "end": b + LENGTH})
    return [(rows[r][0], rows[r][1], s) for r, s in spans.items()]


def compare_groups(edges: DataFrame) -> DataFrame:
    """Rows come sorted by anchor; whole groups are compared, some at once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int, int, bytes]] = []
        size = 0

        def finish() -> Iterator[pa.RecordBatch]:
            found = matched_in_groups(rows) if len(rows) > 1 else []
            if found:
                columns = list(zip(*found, strict=True))
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                     pa.array(columns[2], kind)], names=["anchor", "whole", "spans"])

        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("anchor", "whole", "n", "bytes")], strict=True):
                if size >= GROUP_BYTES and row[0] != rows[-1][0]:
                    yield from finish()
                    rows, size = [], 0
                rows.append(row)
                size += len(row[3])
        yield from finish()

    return edges.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, PARTIAL)


def compare_windows(edges: DataFrame) -> DataFrame:
    """The same for anchors with many different runs: windows are rows, grouped and joined."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "bytes", SLICE_RUNS):
                run, place, windows = window_hashes(part.column("bytes").to_pylist())
                at = pa.array(run)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c).take(at) for c in ("anchor", "whole", "n")],
                     pa.array(place.astype(np.int32)), _signed(windows)],
                    names=["anchor", "whole", "n", "place", "window"])

    windows = edges.mapInArrow(make, "anchor long, whole long, n long, place int, window long")
    shared = windows.groupBy("anchor", "window").agg(F.count(F.lit(1)).alias("runs")).filter("runs > 1")
    places = F.array_sort(F.collect_set("place"))
    return (windows.filter("n = 1").join(shared, ["anchor", "window"]).groupBy("anchor", "whole")
            .agg(places.alias("places"))
            .select("anchor", "whole", F.transform("places", lambda p: F.struct(
                p.alias("start"), (p + LENGTH).alias("end"))).alias("spans")))


def matched_spans(docs: DataFrame, index: IndexFamily) -> DataFrame:
    """(doc_id, text_key, spans): per document [start, end) of its matched windows, unsorted."""
    runs = repeated_runs(docs, index)
    index.close()
    kinds = materialise(runs.groupBy("anchor", "whole").agg(F.count(F.lit(1)).alias("n"))
                        .groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"),
                                               F.max("n").alias("most"))
                        .filter("kinds > 1 OR most > 1"), "anchor-kinds")
    mixed = kinds.filter("kinds > 1 AND least = 1")
    crowded = materialise(mixed.filter(F.col("kinds") > GROUP_RUNS).select("anchor"), "crowded-anchors")
    edges = edge_runs(docs, mixed)
    if crowded.isEmpty():
        partial = compare_groups(edges)
    else:
        edges = materialise(edges, "edge-runs")
        partial = compare_groups(edges.join(crowded, "anchor", "left_anti")).unionByName(
            compare_windows(edges.join(crowded, "anchor", "left_semi")))
    partial = materialise(partial, "partial-runs")
    # a run whose anchor has no other kind, or that occurs twice, matches whole
    whole = runs.groupBy("anchor", "whole").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        "anchor", "whole", F.lit(None).cast("array<struct<start: int, end: int>>").alias("spans"))
    verdicts = whole.unionByName(partial)
    spans = F.when(F.col("spans").isNull(), F.array(F.struct(
        F.col("first").alias("start"), (F.col("last") + LENGTH).alias("end")))).otherwise(
            F.transform("spans", lambda p: F.struct((F.col("first") + p["start"]).alias("start"),
                                                    (F.col("first") + p["end"]).alias("end"))))
    out = materialise(runs.join(verdicts, ["anchor", "whole"])
                      .select("doc_id", "text_key", spans.alias("spans"))
                      .groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list("spans")).alias("spans")),
                      "matched-spans")
    discard(runs)
    return out


def cut(text: bytes, spans: list | None) -> tuple[bytes, int, int]:
    """The bytes outside the spans, the bytes inside, and the number of maximal runs of these."""
    kept, at, removed, count = [], 0, 0, 0
    for start, end in sorted((s["start"], s["end"]) for s in spans or []):
        if start > at or count == 0:
            kept.append(text[at:start])
            count += 1
            removed += end - start
            at = end
        elif end > at:
            removed += end - at
            at = end
    kept.append(text[at:])
    return b"".join(kept), removed, count


CUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def without_repeats(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the kept bytes of every row.

    Only texts that may lose something meet their spans in a shuffle; a bitmap
    of the others' keys lets these pass.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text")
    index = IndexFamily(docs.sparkSession)
    for b in range(batches):
        index.add(keyed.filter(F.pmod("text_key", F.lit(batches)) == b))
    spans = matched_spans(keyed, index)
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(spans.select(F.col("text_key").alias("anchor"))))

    def make(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        found = part.column("spans").to_pylist() if "spans" in part.schema.names else [None] * len(texts)
        done = [cut(t, s) for t, s in zip(texts, found, strict=True)]
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()),
             pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64()),
             pa.array([d[0] for d in done], pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    def of(part: pa.RecordBatch, hit: bool) -> pa.RecordBatch:
        keys = np.asarray(part.column("text_key")).view(np.uint64)
        return part.filter(pa.array(in_bitmap(bits.value, keys) == hit))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield of(part, True)

    def untouched(part: pa.RecordBatch, _: list[bytes]) -> pa.RecordBatch:
        part = of(part, False)
        return make(part, _texts(part))

    right = spans.select(F.col("doc_id").alias("span_id"), F.col("text_key").alias("span_key"), "spans")
    cuttable = keyed.mapInArrow(pick, keyed.schema)
    joined = cuttable.join(right, cuttable["doc_id"].eqNullSafe(right["span_id"])
                           & (cuttable["text_key"] == right["span_key"]), "left")
    return _mapped(joined.select("doc_id", "text", "spans"), CUT, make).unionByName(
        _mapped(keyed, CUT, untouched))


# --------------------------------------------------------------- the query


def op6_repeated_strings(docs: DataFrame) -> DataFrame:
    return without_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans",
                                        F.sha2("kept", 256).alias("kept_sha256"))


# Every window by itself: the whole text's 200-byte strings, grouped by their digests.
OP6_SQL = """
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS raw FROM documents),
windows AS (
  SELECT r, unnest(range(octet_length(raw) - 199)) AS i, raw FROM texts WHERE octet_length(raw) >= 200),
keyed AS (SELECT r, i, md5_number(raw[i + 1:i + 200]) AS k FROM windows),
matched AS (
  SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS previous
  FROM keyed SEMI JOIN (SELECT k FROM keyed GROUP BY k HAVING count(*) > 1) USING (k)),
numbered AS (
  SELECT r, i, count(*) FILTER (WHERE previous IS NULL OR i > previous + 200)
    OVER (PARTITION BY r ORDER BY i) AS span FROM matched),
spans AS (SELECT r, span, min(i) AS a, max(i) + 200 AS b FROM numbered GROUP BY r, span),
gaps AS (
  SELECT r, span, b - a AS n, coalesce(lag(b) OVER (PARTITION BY r ORDER BY span), 0) AS kept_from, a AS kept_to FROM spans),
cut AS (
  SELECT g.r, sum(g.n) AS n_removed, count(*) AS n_spans, max(s.b) AS last,
    string_agg(hex(t.raw[g.kept_from + 1:g.kept_to]), '' ORDER BY g.span) AS kept
  FROM gaps g JOIN spans s USING (r, span) JOIN texts t ON t.r = g.r GROUP BY g.r)
SELECT doc_id, octet_length(raw)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_spans, 0)::BIGINT AS n_spans,
  CASE WHEN kept IS NULL THEN sha256(raw)
    ELSE sha256(unhex(kept || hex(raw[last + 1:octet_length(raw)]))) END AS kept_sha256
FROM texts LEFT JOIN cut USING (r)
"""
