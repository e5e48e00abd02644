"""Packing into optimal length buckets (operator 7).

Documents are put into length buckets, padded to the longest of their bucket
and batched under a token budget. The bounds of the buckets come from dynamic
programming over the histogram of all lengths and minimise the padding.

The programme sees a histogram (count, sum and maximum per length class) of a
bounded size, whatever the corpus: a class is one length up to ``FINE`` tokens
and a ``1 / FINE_STEPS`` of a doubling above, some 2,000 classes at most. Then
the classes around each bound are cut finer and the programme runs again, until
no class there is wider than one length. So bounds up to ``FINE`` are optimal;
above it they are optimal among all lengths near the best class bounds.
Batches are runs of the bucket's documents in a fixed random order; their size
is the budget over the bucket's length.

Defined results: a null or empty text has no tokens and lies in the first
bucket; a document longer than the budget is a batch of its own, whole; null
and repeated ids are rows like any other; texts of one length are never parted
by a bound, and their order is that of a hash of the id; very long texts are
counted whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffmart.llm.common import materialise, n_words, numbered

BUCKETS = 12
TOKEN_BUDGET = 16_384
FINE = 512
FINE_STEPS = 64
SEED = 11


def length_class(length: Column) -> Column:
    """The length itself up to FINE; above, FINE_STEPS classes to each doubling."""
    octave = F.floor(F.log2(F.greatest(length, F.lit(FINE)) / F.lit(float(FINE))))
    width = F.pow(F.lit(2.0), octave) * (FINE / FINE_STEPS)
    step = F.floor((length - F.lit(float(FINE)) * F.pow(F.lit(2.0), octave)) / width)
    return F.when(length <= FINE, length).otherwise(FINE + 1 + octave * FINE_STEPS + step).cast("long")


def best_bounds(longest: np.ndarray, counts: np.ndarray, sums: np.ndarray,
                buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` runs of classes with the least padding.

    A run costs its longest length times its documents, less their tokens.
    Exact over the given classes: O(buckets x classes^2), vectorised.
    """
    m = len(longest)
    if m == 0:
        return []
    n = np.concatenate([[0], np.cumsum(counts, dtype=np.float64)])
    s = np.concatenate([[0], np.cumsum(sums, dtype=np.float64)])
    best = np.full(m + 1, np.inf)
    best[0] = 0.0
    cuts = []
    for _ in range(min(buckets, m)):
        new, cut = np.full(m + 1, np.inf), np.zeros(m + 1, dtype=np.int64)
        new[0] = 0.0
        for j in range(1, m + 1):
            cost = best[:j] + longest[j - 1] * (n[j] - n[:j]) - (s[j] - s[:j])
            cut[j] = int(np.argmin(cost))
            new[j] = cost[cut[j]]
        best = new
        cuts.append(cut)
    bounds, j = [], m
    for cut in reversed(cuts):
        if j == 0:
            break
        bounds.append(int(longest[j - 1]))
        j = int(cut[j])
    return sorted(set(bounds))


def class_start(number: int) -> int:
    """The smallest length of a class."""
    if number <= FINE:
        return number
    octave, step = divmod(number - FINE - 1, FINE_STEPS)
    return max(FINE + 1, (FINE << octave) + step * ((FINE << octave) // FINE_STEPS))


def class_number(length: int) -> int:
    if length <= FINE:
        return length
    octave = (length // FINE).bit_length() - 1
    return FINE + 1 + octave * FINE_STEPS + (length - (FINE << octave)) * FINE_STEPS // (FINE << octave)


@dataclass(frozen=True)
class Window:
    """Lengths from ``start`` to before ``stop``, in classes of ``step`` lengths."""

    start: int
    stop: int
    step: int


def windows_around(bounds: Sequence[int], before: Sequence[Window]) -> list[Window]:
    """Finer classes around each bound that lies among classes wider than one length."""
    out: list[Window] = []
    for bound in bounds:
        at = next((w for w in before if w.start <= bound < w.stop), None)
        if at is not None and at.step == 1:
            new = at
        elif at is not None:
            own = at.start + (bound - at.start) // at.step * at.step
            new = Window(max(at.start, own - at.step), min(at.stop, own + 2 * at.step), 0)
        elif bound <= FINE:
            continue
        else:
            own = class_number(bound)
            new = Window(class_start(own - 1), class_start(own + 2), 0)
        if out and new.start < out[-1].stop:  # neighbours share their window
            new = Window(out[-1].start, max(new.stop, out[-1].stop), 0)
            out.pop()
        out.append(new)
    return [w if w.step == 1 else Window(w.start, w.stop, max(1, (w.stop - w.start) // (3 * FINE_STEPS))) for w in out]


def length_histogram(lengths: DataFrame, windows: Sequence[Window] = ()) -> DataFrame:
    """Count, tokens and longest per class; lengths inside a window have classes of its step."""
    n, key = F.col("n_tokens"), length_class(F.col("n_tokens"))
    for w in windows:
        # below all other numbers, and no two windows meet
        own = -1 - F.lit(w.start) - F.floor((n - w.start) / w.step)
        key = F.when((n >= w.start) & (n < w.stop), own).otherwise(key)
    return lengths.groupBy(key.alias("class")).agg(
        F.count(F.lit(1)).alias("docs"), F.sum("n_tokens").alias("tokens"),
        F.max("n_tokens").alias("longest"))


def padding(longest: np.ndarray, counts: np.ndarray, sums: np.ndarray, bounds: Sequence[int]) -> float:
    """Padding of all documents under ``bounds``, each the longest length of a class."""
    index = np.searchsorted(np.array(bounds, dtype=np.float64), longest)
    return float((np.array(bounds, dtype=np.float64)[index] * counts - sums).sum())


# A window is some 20 times finer than the classes around it, so this many rounds are enough for any length.
ROUNDS = 8


def bucket_bounds(lengths: DataFrame, buckets: int) -> tuple[list[int], int]:
    """(upper bounds of the buckets, number of rows): the best of all rounds."""
    windows: list[Window] = []
    least, chosen, rows = math.inf, [0], 0
    for _ in range(ROUNDS):
        classes = sorted(length_histogram(lengths, windows).collect(), key=lambda r: r["longest"])
        if not classes:
            break
        rows = sum(r["docs"] for r in classes)
        columns = [np.array([r[c] for r in classes], dtype=np.float64) for c in ("longest", "docs", "tokens")]
        bounds = best_bounds(*columns, buckets)
        cost = padding(*columns, bounds)
        if cost < least:
            least, chosen = cost, bounds
        finer = windows_around(bounds[:-1], windows)
        if all(any(w.start <= f.start and f.stop <= w.stop and w.step <= f.step for w in windows) for f in finer):
            break
        windows = finer
    return chosen, rows


def packed(docs: DataFrame, buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET,
           seed: int = SEED) -> DataFrame:
    """doc_id, n_tokens, bucket, bucket_length, batch, slot of every row of ``docs``."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    lengths = materialise(
        docs.select("doc_id", n_words(F.col("text")).alias("n_tokens"), digest.alias("digest")),
        "pack-lengths")
    bounds, rows = bucket_bounds(lengths, buckets)
    index, length = F.lit(len(bounds) - 1), F.lit(bounds[-1])
    for i in range(len(bounds) - 2, -1, -1):
        inside = F.col("n_tokens") <= bounds[i]
        index, length = F.when(inside, i).otherwise(index), F.when(inside, bounds[i]).otherwise(length)
    bucketed = (lengths.withColumn("bucket", index.cast("int"))
                .withColumn("bucket_length", length.cast("long")).withColumn("band", F.lit(0)))
    placed = numbered(bucketed, ["bucket"], "band", "digest", "place", rows)
    room = F.greatest(F.floor(F.lit(token_budget) / F.greatest(F.col("bucket_length"), F.lit(1))), F.lit(1))
    return placed.select("doc_id", "n_tokens", "bucket", "bucket_length",
                         F.floor((F.col("place") - 1) / room).cast("long").alias("batch"),
                         ((F.col("place") - 1) % room).cast("long").alias("slot"))


# --------------------------------------------------------------- the query


def op7_pack_buckets(docs: DataFrame) -> DataFrame:
    return packed(docs)
