"""Gold-layer operators: dimension lookups and the five mart aggregates.

Dimensions are narrowed to the needed columns and made distinct *before* the
join, so duplicate dimension rows cannot fan out the fact and the wide fact
is never de-duplicated; different rows for one key are an error
(``assert_unique_key``). The planner's size checks choose how to join — the
static ``autoBroadcastJoinThreshold`` on the estimated size and, at runtime,
adaptive execution on the measured size — with a sort-merge join beyond them.

Means are written ``sum(days) / (count(days) * 365.25)``: an exact integer
sum followed by one division, so the result does not depend on how rows are
spread over partitions (a mean of per-row quotients would).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffmart.functions.temporal import DAYS_PER_YEAR

HEADCOUNT = "total_employees"
MEAN_YEARS = "average_time_on_job_in_years"


def narrow_dimension(dim: DataFrame, columns: Sequence[str]) -> DataFrame:
    return dim.select(*columns).distinct()


# Partitions that rows without a key are spread over.
NULL_SPREAD = 1 << 16


def lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None,
           how: str = "left") -> DataFrame:
    """Left join a dimension. Same key name: one key column is kept; different
    names: both are kept. The planner's size checks choose the strategy.

    Rows without a key match nothing, but a shuffle by the key alone would send
    them all to one task. A second key, 0 for every real key on both sides,
    gives each of them a number of its own and so spreads them.
    """
    own = dim_key or fact_key
    same = own == fact_key
    keyed = dim.withColumnRenamed(own, "__key") if same else dim
    key = F.col("__key" if same else own)
    spread = F.when(F.col(fact_key).isNull(), 1 + F.pmod(F.xxhash64(*fact.columns), F.lit(NULL_SPREAD)))
    left = fact.withColumn("__spread", F.coalesce(spread, F.lit(0).cast("long")))
    right = keyed.withColumn("__at", F.when(key.isNull(), F.lit(-1)).otherwise(F.lit(0)).cast("long"))
    out = left.join(right, (left[fact_key] == right["__key" if same else own])
                    & (left["__spread"] == right["__at"]), how)
    return out.drop("__spread", "__at", "__key")


def key_conflicts(dim: DataFrame, key: str) -> DataFrame:
    """(key, rows) of the keys that have more than one row."""
    return (dim.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1"))


def split_by_key(dim: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows of keys that have one row, or none; rows of the other keys).

    Only the short list of conflicting keys is joined. Rows without a key
    match no fact and go with the first.
    """
    conflicts = key_conflicts(dim, key).select(key)
    return (dim.join(conflicts, key, "left_anti"), dim.join(conflicts, key, "left_semi"))


def assert_unique_key(dim: DataFrame, key: str) -> None:
    """Raise if a key has several rows; the message names ten of them at most."""
    found = [str(r[0]) for r in key_conflicts(dim, key).limit(10).collect()]
    if found:
        raise ValueError(f"different rows for one {key}: {', '.join(sorted(found))}")


def headcount(df: DataFrame, by: Sequence[str], id_column: str,
              alias: str = HEADCOUNT, approx_rsd: float | None = None) -> DataFrame:
    """Distinct non-null ids per group (a NULL group key is its own group).

    Exact by default (partial distinct per (group, id), then count). With
    ``approx_rsd`` a HyperLogLog++ sketch per group is merged instead: no
    shuffle of the ids, fixed memory per group, relative error ``approx_rsd``.
    """
    ids = F.col(id_column)
    if approx_rsd is not None:
        return df.groupBy(*by).agg(F.approx_count_distinct(ids, approx_rsd).alias(alias))
    return df.groupBy(*by).agg(F.count_distinct(ids).alias(alias))


def mean_years(df: DataFrame, by: Sequence[str], days_column: str,
               alias: str = MEAN_YEARS) -> DataFrame:
    """Mean of ``days / 365.25`` per group, NULL days skipped."""
    days = F.col(days_column)
    n = F.count(days)
    mean = F.when(n > 0, F.sum(days).cast("double") / (n * F.lit(DAYS_PER_YEAR)))
    return df.groupBy(*by).agg(mean.alias(alias))


def mean_years_from_sums(df: DataFrame, by: Sequence[str], days_sum: str, days_count: str,
                         alias: str = MEAN_YEARS) -> DataFrame:
    """``mean_years`` over rows that already carry partial sums and counts of
    days (e.g. pre-aggregated per join key before a large join)."""
    n = F.sum(F.col(days_count))
    mean = F.when(n > 0, F.sum(F.col(days_sum)).cast("double") / (n * F.lit(DAYS_PER_YEAR)))
    return df.groupBy(*by).agg(mean.alias(alias))


def ranked(df: DataFrame, metric: str) -> DataFrame:
    """Largest first (NULL last), equal ones by their group."""
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c != metric]
    return df.orderBy(F.col(metric).desc_nulls_last(), *rest)
