"""Similarity join of word shingles with Bayesian pruning (operator 8).

Two documents are linked when the Jaccard similarity of their sets of
``SHINGLE``-word shingles is at least ``THRESHOLD``. The steps:

1. Texts become MinHash signatures; documents with equal shingle sets are one
   node from here on, with a number of copies.
2. Signatures are cut into bands. Bands that two nodes share are candidates;
   at the threshold a pair shares none of the 40 bands with probability 1e-7.
   Nodes of one bucket (equal band) are compared there by the first
   ``SKETCH`` values of their signatures, a byte each, with the pruning of step
   4; only pairs that it leaves are joined, as a forest. So texts that share
   some passage, and a band here and there, don't hang together. The members
   of a bucket of more than ``BUCKET_ROWS`` rows are all joined to one of them.
3. The connected components of these joins are clumps: every link lies inside
   one. A clump is cut into blocks of bounded size, and each pair of blocks is
   one group of rows, so no task holds a large clump and no pair is a row.
4. Inside a group, pairs are compared a few MinHash values at a time. With
   ``m`` of ``n`` equal values and a uniform prior, the posterior probability
   of reaching the threshold is P(Bin(n + 1, t) <= m); pairs below
   ``TOLERANCE`` are dropped. The rest is verified on the whole shingle sets.
5. Groups return a row per node: the copies that it is linked to, and a root
   of its links. Connected components of the roots are the classes.

Result: one row per document with its class (the smallest doc_id of it) and
its number of links (documents at or above the threshold).

Defined results: texts with one to four words have one shingle, all their
words; texts without words (null, empty) are a class of their own and link to
nothing; copies of a text are linked; rows with a null doc_id take part, and
their class id is null only where no member has an id; repeated rows count as
copies; an empty table gives an empty result; extra columns of any name are
kept by ``one_of_each``.

Shingles and nodes are 64-bit hashes of their words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from staffmart.llm.common import fresh, materialise, slices

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 40, 5
HASHES = BANDS * ROWS
STEP = 20
TOLERANCE = 1e-7
SEED = 5
# Values of a signature that buckets see, and the rows up to which a bucket is compared.
SKETCH, BUCKET_ROWS = 100, 1500
# Bounds of a block: nodes, and words of their texts.
BLOCK_NODES = 1500
BLOCK_WORDS = 1_500_000
# Pairs compared at once, and cells of an incidence matrix.
PAIRS_AT_ONCE = 500_000
CELLS_AT_ONCE = 8_000_000

_FACTORS = np.random.default_rng(SEED).integers(1, 2**63, size=HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix64(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingles(texts: list[str | None], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of the texts, one after the other, and each text's number of them."""
    words_of = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
    ids: dict[bytes, int] = {}
    lengths = np.array([len(w) for w in words_of], dtype=np.int64)
    total = int(lengths.sum())
    flat = np.fromiter((ids.setdefault(w, len(ids)) for ws in words_of for w in ws), dtype=np.int64,
                       count=total)
    code = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in ids), dtype=np.uint64, count=len(ids))[flat]
    counts = np.where(lengths >= size, lengths - size + 1, np.minimum(lengths, 1))
    out = np.empty(int(counts.sum()), dtype=np.uint64)
    ends = np.cumsum(lengths)
    firsts, at = ends - lengths, np.cumsum(counts) - counts
    factor = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(0, total - size + 1), dtype=np.uint64)
        for j in range(size):
            rolled = rolled * factor + code[j:j + len(rolled)]
        rolled = mix64(rolled)
        long = np.flatnonzero(lengths >= size)
        # windows that do not cross from one text into the next, in order
        inside = np.ones(len(rolled) + 1, dtype=bool)
        for start, n in zip(firsts.tolist(), lengths.tolist(), strict=True):
            stop = start + n
            if n >= size:
                inside[stop - size + 1:stop] = False
            else:
                inside[start:stop] = False
        kept = rolled[inside[:len(rolled)]]
        places = np.repeat(np.isin(np.arange(len(texts)), long), counts)
        out[places] = kept
        for i in np.flatnonzero((lengths > 0) & (lengths < size)):
            value = np.uint64(lengths[i])
            for c in code[firsts[i]:ends[i]]:
                value = value * factor + c
            out[at[i]] = mix64(np.array([value], dtype=np.uint64))[0]
    return out, counts


def signatures(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """HASHES MinHash values (32 bits) per text; texts without shingles get zeros."""
    out = np.zeros((len(counts), HASHES), dtype=np.uint32)
    full = np.flatnonzero(counts > 0)
    if len(full):
        starts = (np.cumsum(counts) - counts)[full]
        with np.errstate(over="ignore"):
            for k in range(HASHES):
                least = np.minimum.reduceat(values * _FACTORS[k], starts)
                out[full, k] = (least >> np.uint64(32)).astype(np.uint32)
    return out


def band_values(signature: np.ndarray) -> np.ndarray:
    """One 64-bit bucket per band; the band's number is part of it."""
    parts = signature.reshape(len(signature), BANDS, ROWS).astype(np.uint64)
    value = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    with np.errstate(over="ignore"):
        for r in range(ROWS):
            value = mix64(value * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return value.view(np.int64)


def _sets(values: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    return [np.unique(x) for x in np.split(values, np.cumsum(counts)[:-1])] if len(counts) else []


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, node, n_words, buckets, sketch) of every document."""
    schema = "doc_id long, text_key long, node long, n_words long, buckets array<long>, sketch binary"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values, counts = shingles(part.column("text").to_pylist())
                sets = _sets(values, counts)
                nodes = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) if len(s) else 0 for s in sets],
                                 dtype=np.uint64).view(np.int64)
                signature = signatures(values, counts)
                buckets = band_values(signature)
                sketches = signature[:, :SKETCH].astype(np.uint8)
                flat = pa.array(buckets.ravel(), pa.int64())
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(sets) + 1) * BANDS, pa.int32()), flat)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"),
                     pa.array(nodes, pa.int64(), mask=counts == 0), pa.array(counts, pa.int64()), lists,
                     pa.array([row.tobytes() for row in sketches], pa.binary())],
                    names=["doc_id", "text_key", "node", "n_words", "buckets", "sketch"])

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text")
    return keyed.mapInArrow(sign, schema)


# ---------------------------------------------------------------- components


def _observed(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The written edges, and a digest of them that the write itself gathers."""
    seen = Observation()
    counted = edges.observe(seen, F.count(F.lit(1)).alias("n"),
                            F.bit_xor(F.xxhash64("u", "v")).alias("digest"))
    return materialise(counted, "components"), tuple(sorted(seen.get.items()))


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each connected component of (u, v).

    Alternates large-star and small-star steps (Kiveris et al., 2014), each an
    aggregation and a join, until the edges are stars. Edges only shrink.
    """
    def directed(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")) \
            .filter("u <> v").distinct()

    edges, now = _observed(directed(edges))
    seen = None
    while now != seen:
        seen = now
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = directed(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            joined.select("u", F.col("m").alias("v")))
        edges, now = _observed(directed(small))
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return leaves.union(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


# ---------------------------------------------------------------- comparison


def posterior(m: int, n: int, threshold: float = THRESHOLD) -> float:
    """P(similarity >= threshold) after m of n equal MinHash values, uniform prior."""
    i = np.arange(m + 1)
    logs = (math.lgamma(n + 2) - np.array([math.lgamma(x + 1) + math.lgamma(n - x + 2) for x in i])
            + i * math.log(threshold) + (n + 1 - i) * math.log1p(-threshold))
    return float(min(1.0, np.exp(logs).sum()))


def needed(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """Per step, the fewest equal values with which a pair goes on."""
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        m = 0
        while posterior(m, n, threshold) < tolerance:
            m += 1
        out.append(m)
    return out


NEEDED = needed()


def surviving(a: np.ndarray, b: np.ndarray, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (rows of a, rows of b) among ``alive`` that the pruning leaves."""
    matches = np.zeros(alive.shape, dtype=np.uint16)
    dense, i, j = True, None, None
    for step, least in enumerate(NEEDED[:a.shape[1] // STEP]):
        lo = step * STEP
        if dense:
            for k in range(lo, lo + STEP):
                matches += a[:, k, None] == b[None, :, k]
            alive &= matches >= least
            if alive.sum() * 8 < alive.size:
                dense = False
                i, j = np.nonzero(alive)
                matches = matches[i, j]
        else:
            matches = matches + (a[i, lo:lo + STEP] == b[j, lo:lo + STEP]).sum(axis=1, dtype=np.uint16)
            on = matches >= least
            i, j, matches = i[on], j[on], matches[on]
    return np.nonzero(alive) if dense else (i, j)


def intersections(left: list[np.ndarray], right: list[np.ndarray], i: np.ndarray,
                  j: np.ndarray) -> np.ndarray:
    """Exact sizes of the intersections left[i] & right[j]."""
    if len(i) <= 4 * (len(left) + len(right)):
        return np.array([len(np.intersect1d(left[x], right[y], assume_unique=True))
                         for x, y in zip(i.tolist(), j.tolist(), strict=True)], dtype=np.int64)
    sets = [*left, *right]
    column, place = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    common = np.bincount(place) > 1
    renumbered = np.cumsum(common) - 1
    row, place = row[common[place]], renumbered[place[common[place]]]
    width = max(1, CELLS_AT_ONCE // len(sets))
    total = np.zeros((len(left), len(right)), dtype=np.float32)
    for lo in range(0, int(common.sum()), width):
        own = (place >= lo) & (place < lo + width)
        m = np.zeros((len(sets), width), dtype=np.float32)
        m[row[own], place[own] - lo] = 1
        total += m[:len(left)] @ m[len(left):].T
    return total[i, j].astype(np.int64)


def find_root(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def linked_pairs(sets: list[np.ndarray], sigs: np.ndarray, left: np.ndarray,
                 right: np.ndarray, threshold: float = THRESHOLD) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All linked pairs between two lists of members, or inside one (left is right)."""
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    rows = max(1, PAIRS_AT_ONCE // max(1, len(right)))
    for lo in range(0, len(left), rows):
        part = left[lo:lo + rows]
        # right's columns up to this part's last row are enough inside one list
        x, y = sizes[part][:, None], sizes[right][None, :]
        alive = np.minimum(x, y) >= threshold * np.maximum(x, y)
        if left is right:
            alive &= np.arange(len(right))[None, :] > np.arange(lo, lo + len(part))[:, None]
        i, j = surviving(sigs[part], sigs[right], alive)
        if not len(i):
            continue
        used, at = np.unique(j, return_inverse=True)
        common = intersections([sets[p] for p in part], [sets[right[u]] for u in used], i, at)
        union = sizes[part[i]] + sizes[right[j]] - common
        ok = common >= threshold * union - 1e-9
        yield part[i[ok]], right[j[ok]]


def links_of_group(texts: list[str], copies: np.ndarray, block: np.ndarray, first: int,
                   second: int) -> tuple[np.ndarray, np.ndarray]:
    """Per member of one pair of blocks: linked copies, and the root of its links."""
    values, counts = shingles(texts)
    sets, sigs = _sets(values, counts), signatures(values, counts)
    left = np.flatnonzero(block == first)
    right = left if first == second else np.flatnonzero(block == second)
    links, parent = np.zeros(len(texts), dtype=np.int64), list(range(len(texts)))
    for a, b in linked_pairs(sets, sigs, left, right):
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            rx, ry = find_root(parent, x), find_root(parent, y)
            if rx != ry:
                parent[max(rx, ry)] = min(rx, ry)
    return links, np.array([find_root(parent, x) for x in range(len(texts))], dtype=np.int64)


def compare(groups: DataFrame) -> DataFrame:
    """(node, links, root) per member of each group (clump, first, second).

    Rows come sorted by group and node, so a task holds one group at a time;
    a group is bounded by two blocks. Links of a group (i, i) are inside block
    i, those of (i, j) between the two.
    """
    schema = "node long, links long, root long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def finish() -> Iterator[pa.RecordBatch]:
            if len(rows) < 2:
                return
            nodes = np.array([r[0] for r in rows], dtype=np.int64)
            links, root = links_of_group([r[3] for r in rows], np.array([r[1] for r in rows]),
                                         np.array([r[2] for r in rows]), key[1], key[2])
            on = links > 0
            if on.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[on]), pa.array(links[on]), pa.array(nodes[root[on]])],
                    names=["node", "links", "root"])

        for batch in batches:
            keys = zip(*[batch.column(c).to_pylist() for c in ("clump", "first", "second")], strict=True)
            rest = zip(*[batch.column(c).to_pylist() for c in ("node", "copies", "block", "text")],
                       strict=True)
            for k, row in zip(keys, rest, strict=True):
                if k != key:
                    yield from finish()
                    key, rows = k, []
                if not rows or rows[-1][0] != row[0]:  # repeated rows of one document
                    rows.append(row)
        yield from finish()

    ordered = (groups.repartition("clump", "first", "second")
               .sortWithinPartitions("clump", "first", "second", "node"))
    return ordered.mapInArrow(run, schema)


# --------------------------------------------------------- joins inside buckets


def _surviving_pairs(rows: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of sketches that the pruning leaves."""
    matches = np.zeros(len(i), dtype=np.uint16)
    for step, least in enumerate(NEEDED[:SKETCH // STEP]):
        part = slice(step * STEP, (step + 1) * STEP)
        matches = matches + (rows[i, part] == rows[j, part]).sum(axis=1, dtype=np.uint16)
        on = matches >= least
        i, j, matches = i[on], j[on], matches[on]
    return i, j


def forest(nodes: np.ndarray, sketches: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(u, v): a forest per bucket over the pairs that its members' sketches leave.

    Bucket k holds the rows from ``starts[k]`` to before ``starts[k + 1]``.
    Pairs of many small buckets are compared at once.
    """
    n = np.diff(starts)
    parent = list(range(len(nodes)))

    def join(i: np.ndarray, j: np.ndarray) -> None:
        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            rx, ry = find_root(parent, x), find_root(parent, y)
            if rx != ry:
                parent[max(rx, ry)] = min(rx, ry)

    for shift in range(1, int(n.max(initial=1))):
        # every pair of rows of a bucket that lie ``shift`` apart; none is left once a bucket hangs together
        big = np.flatnonzero(n > shift)
        first = np.concatenate([np.arange(starts[k], starts[k + 1] - shift) for k in big.tolist()])
        roots = np.array(parent)
        apart = roots[first] != roots[first + shift]
        first = first[apart]
        for lo in range(0, len(first), PAIRS_AT_ONCE // 10):
            part = first[lo:lo + PAIRS_AT_ONCE // 10]
            join(*_surviving_pairs(sketches, part, part + shift))
    root = np.array([find_root(parent, x) for x in range(len(nodes))], dtype=np.int64)
    own = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[own], nodes[root[own]]


def bucket_joins(members: DataFrame) -> DataFrame:
    """(u, v) of (bucket, node, sketch): what the members of each bucket are joined by."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None  # the last bucket, which the next batch may go on with
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            buckets = rows.column("bucket").to_numpy()
            last = int(np.searchsorted(buckets, buckets[-1])) if len(buckets) else 0
            yield from joined(rows.slice(0, last), buckets[:last])
            rest = rows.slice(last)
        if rest is not None and len(rest):
            yield from joined(rest, rest.column("bucket").to_numpy())

    def joined(rows: pa.Table, buckets: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(buckets):
            return
        sketches = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH)
        starts = np.append(np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1])), len(buckets))
        u, v = forest(rows.column("node").to_numpy(), sketches, starts)
        if len(u):
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return members.repartition("bucket").sortWithinPartitions("bucket", "node").mapInArrow(run, "u long, v long")


# -------------------------------------------------------------------- the join


def clumps_of(worded: DataFrame) -> DataFrame:
    """(node, clump) of the nodes that a bucket joins to another one."""
    member = worded.select("node", F.explode("buckets").alias("bucket"))
    shared = member.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("far"),
                                          F.count(F.lit(1)).alias("n"))
    shared = materialise(shared.filter("hub <> far").select("bucket", "hub", (F.col("n") > BUCKET_ROWS).alias("hot")),
                         "near-buckets")
    held = materialise(member.join(shared, "bucket").select("bucket", "node", "hub", "hot"), "near-members")
    spokes = held.filter("hot AND node <> hub").select(F.col("node").alias("u"), F.col("hub").alias("v"))
    # a sketch per node, sent to the buckets that it shares with others
    sketches = worded.groupBy("node").agg(F.any_value("sketch").alias("sketch"))
    members = held.filter("NOT hot").select("node", "bucket").distinct().join(sketches, "node")
    joins = spokes.union(bucket_joins(members.select("bucket", "node", "sketch")))
    return materialise(components(joins).withColumnRenamed("label", "clump"), "near-clumps")


def near_links(docs: DataFrame, signed_docs: DataFrame) -> DataFrame:
    """(node, links, root): verified links of nodes with different shingle sets."""
    worded = signed_docs.filter(F.col("node").isNotNull())
    clumps = clumps_of(worded)
    nodes = worded.join(clumps, "node").groupBy("node", "clump").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "text_key")).alias("at"),
        F.first("n_words").alias("n_words"))
    nodes = materialise(nodes, "near-nodes")
    sizes = nodes.groupBy("clump").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_NODES), F.ceil(F.sum("n_words") / BLOCK_WORDS),
                   F.lit(1).cast("long")).alias("blocks"))
    sizes = materialise(sizes, "near-sizes")
    placed = (nodes.join(sizes, "clump")
              .withColumn("block", F.pmod(F.xxhash64(F.lit(9), "node"), F.col("blocks"))))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"),
                        F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), "text")
    with_text = texts.join(
        placed, texts["doc"].eqNullSafe(placed["at.doc_id"]) & (texts["key"] == placed["at.text_key"]))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    groups = with_text.select("clump", "node", "copies", "block", "text", other.alias("other")).select(
        "clump", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"),
        "node", "copies", "block", "text")
    return compare(groups)


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, class_id, class_key, n_links) of every row of ``docs``.

    ``class_key`` is never null; rows of one class agree in it.
    """
    base = materialise(signed(docs), "near-signatures")
    links = materialise(near_links(docs, base), "near-links")
    counted = links.groupBy("node").agg(F.sum("links").alias("links"))
    labels = components(links.select(F.col("node").alias("u"), F.col("root").alias("v")))
    found = counted.join(labels, "node", "left")
    copies = base.filter(F.col("node").isNotNull()).groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id"))
    nodes = copies.join(found, "node", "left").select(
        "node", "first_id", F.coalesce("label", "node").alias("label"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    nodes = materialise(nodes, "near-nodes")
    firsts = nodes.groupBy("label").agg(F.min("first_id").alias("class_id"))
    of_node = materialise(nodes.join(firsts, "label").select("node", "label", "class_id", "n_links"),
                          "near-classes")
    out = base.select("doc_id", "text_key", "node").join(of_node, "node", "left")
    alone = F.col("node").isNull()
    return out.select(
        "doc_id", "text_key",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.concat(F.lit("-"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
        .otherwise(F.col("label").cast("string")).alias("class_key"),
        F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"), "node")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without near duplicates: of each class the smallest doc_id stays.

    Of rows without any words all stay; of repeated rows one.
    """
    key, text_key, place = fresh(docs, "id_"), fresh(docs, "text_key_"), fresh(docs, "place_")
    found = classes(docs)
    first = (found.filter(F.col("node").isNotNull()).groupBy("class_key")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("s"))
             .select(F.col("s.doc_id").alias(key), F.col("s.text_key").alias(f"{text_key}_")))
    first = materialise(first, "near-kept")
    rows = docs.withColumn(text_key, F.xxhash64(F.coalesce("text", F.lit(""))))
    worded = F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    kept = rows.filter(worded).join(
        first, rows["doc_id"].cast("long").eqNullSafe(first[key]) & (rows[text_key] == first[f"{text_key}_"]))
    once = W.partitionBy(key, text_key).orderBy(F.lit(0))
    kept = kept.withColumn(place, F.row_number().over(once)).filter(F.col(place) == 1)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return kept.select(*columns).union(rows.filter(~worded).select(*columns))


# --------------------------------------------------------------- the query


def op8_near_duplicates(docs: DataFrame) -> DataFrame:
    return classes(docs.select("doc_id", "text")).select("doc_id", "class_id", "n_links")


# Whole sets of shingles compared by what they have in common, and classes as closures of the links.
OP8_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
shingles AS (
  SELECT DISTINCT r, md5_number(array_to_string(words[i:i + 4], ' ')) AS s
  FROM (SELECT r, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM texts WHERE len(words) > 0)),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
common AS (
  SELECT a.r AS a, b.r AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.r <> b.r GROUP BY a.r, b.r),
links AS (
  SELECT c.a, c.b FROM common c JOIN sizes x ON x.r = c.a JOIN sizes y ON y.r = c.b
  WHERE 5 * c.n >= 4 * (x.n + y.n - c.n)),
reached(r, other) AS (
  SELECT r, r FROM texts UNION SELECT reached.r, links.b FROM reached JOIN links ON links.a = reached.other),
classes AS (SELECT reached.r, min(t.doc_id) AS class_id FROM reached JOIN texts t ON t.r = reached.other GROUP BY reached.r),
counted AS (SELECT a AS r, count(*) AS n_links FROM links GROUP BY a)
SELECT doc_id::BIGINT AS doc_id, class_id::BIGINT AS class_id, coalesce(n_links, 0)::BIGINT AS n_links
FROM texts JOIN classes USING (r) LEFT JOIN counted USING (r)
"""
