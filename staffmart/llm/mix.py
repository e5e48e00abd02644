"""Mixing sources to target weights by systematic sampling (operator 1).

Every source gets a share of the budget by its weight; a share stops at
``max_repeat`` times the source's size and the excess is shared again by
weight. All documents of a source have the same expected number of copies
(target / source size). They are laid out by size, each as long as its
expected copies, with one random offset before the first; a document is taken
once per whole number that its stretch crosses. Because the layout is ordered
by size, the words taken of a source differ from its target by less than its
largest document.

Defined results: a null or empty text has size 0 and takes no words; a null
source is a source of its own, the last one; null and repeated ids are rows
like any other; an empty table gives an empty mix; extra columns of any name
are kept by ``mixed`` and ignored by ``shares``.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from staffmart.llm.common import fresh, materialise, n_words, numbered

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MAX_REPEAT = 2
SEED = 20240607


def offset(seed: int) -> float:
    """The one random offset of a run, away from 0 and 1 so that rounding can't cross them."""
    return round(random.Random(seed).uniform(0.05, 0.95), 6)


def order_digest(doc_id: Column, seed: int) -> Column:
    """Orders rows of one size at random, the same in every run."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def targets(sources: DataFrame, weights: Sequence[int], budget: float,
            max_repeat: int) -> DataFrame:
    """Add ``target`` to (source, source_size), one row per source.

    Water-filling in one pass: by rising cap per weight, a source is capped
    while its cap is no more than its share of what the capped ones before
    left; ``level`` of the first uncapped one holds for all that follow. The
    windows run over one row per source.
    """
    n = len(weights)
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (place - 1) % n + 1)
    caps = (sources.withColumn("weight", weight)
            .withColumn("cap", F.col("source_size") * max_repeat)
            .withColumn("total", F.sum("source_size").over(W.partitionBy()) * F.lit(float(budget))))
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    filled = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing))
    level = (F.col("total") - filled) / left
    levels = caps.withColumn("level", level)
    open_level = F.max(F.when(F.col("cap") > F.col("weight") * F.col("level"), F.col("level")))
    return (levels.withColumn("level", open_level.over(W.partitionBy()))
            .select("source", "source_size",
                    F.coalesce(F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")),
                               F.col("cap").cast("double")).alias("target")))


def shares(docs: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = BUDGET,
           max_repeat: int = MAX_REPEAT, seed: int = SEED,
           row_key: Column | None = None) -> DataFrame:
    """One row per document: doc_id, row_key, source, size, source_size, target, copies.

    ``docs`` needs doc_id, text and source. Texts are read once; what follows
    works on a narrow table in the shared folder. ``row_key`` rides along so
    that the copies can be joined back.
    """
    key = F.lit(0).cast("long") if row_key is None else row_key
    narrow = docs.select(
        F.col("doc_id"), key.alias("row_key"), F.col("source").cast("string").alias("source"),
        n_words(F.col("text")).alias("size"),
        order_digest(F.col("doc_id"), seed).alias("digest"))
    narrow = materialise(narrow, "mix-sizes")
    grouped = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    # a key that is never null, for grouping and joining
    source_key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("source_key")
    plan = targets(grouped, weights, budget, max_repeat).select(source_key, "source_size", "target")
    laid = numbered(narrow.select("*", source_key), ["source_key"], "size", "digest", "place",
                    rows=narrow.count())
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    start = F.lit(offset(seed))
    crossed = F.floor(start + each * F.col("place")) - F.floor(start + each * (F.col("place") - 1))
    return (laid.join(plan, "source_key")
            .select("doc_id", "row_key", "source", "size", "source_size", "target",
                    F.least(crossed, F.ceil(each)).cast("long").alias("copies")))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it was taken."""
    key, occurrence, copies = (fresh(docs, c) for c in ("row_key_", "occurrence_", "copies_"))
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    taken = shares(docs, row_key=whole, **options).filter("copies > 0")
    # rows that agree in every column are told apart by number only
    taken = taken.select(
        F.col("row_key").alias(key), F.col("copies").alias(copies),
        F.row_number().over(W.partitionBy("row_key").orderBy(F.desc("copies"))).alias(occurrence))
    rows = docs.withColumn(key, whole).withColumn(
        occurrence, F.row_number().over(W.partitionBy(key).orderBy(F.lit(0))))
    return (rows.join(taken, [key, occurrence])
            .withColumn(copies, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


# --------------------------------------------------------------- the query


def op1_mix_sources(docs: DataFrame) -> DataFrame:
    return shares(docs).select("doc_id", "size", "source_size", "target",
                               (F.col("size") * F.col("copies")).alias("taken"))


OP1_SQL = f"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM documents),
per_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
caps AS (
  SELECT *, [{', '.join(map(str, WEIGHTS))}][CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1)
            % {len(WEIGHTS)} + 1 AS INT)] AS weight,
         source_size * {MAX_REPEAT} AS cap,
         CAST(sum(source_size) OVER () AS BIGINT) * CAST({BUDGET} AS DOUBLE) AS total
  FROM per_source),
levels AS (
  SELECT *, (total - CAST(coalesce(sum(cap) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, source ASC NULLS LAST
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT))
            / CAST(sum(weight) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, source ASC NULLS LAST
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS level
  FROM caps),
plan AS (
  SELECT source, source_size,
         coalesce(least(CAST(cap AS DOUBLE),
                  weight * max(CASE WHEN cap > weight * level THEN level END) OVER ()),
                  CAST(cap AS DOUBLE)) AS target
  FROM levels),
laid AS (
  SELECT s.doc_id, s.size, p.source_size, p.target,
         row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.digest) AS place,
         CASE WHEN p.source_size > 0 THEN p.target / p.source_size ELSE 0.0::DOUBLE END AS each
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       CAST(size * least(floor({offset(SEED)}::DOUBLE + each * place)
                  - floor({offset(SEED)}::DOUBLE + each * (place - 1)), ceil(each)) AS BIGINT) AS taken
FROM laid
"""
