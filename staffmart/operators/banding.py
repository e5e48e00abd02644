"""Bands given as a table: a gate for overlaps and holes, and the join that assigns them.

``functions.generation`` has fixed bands; here they are rows (name, from, to),
both ends included, which users keep themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from staffmart.functions.bands import UNKNOWN

NAME, FROM, TO = "band", "band_from", "band_to"
# Values of one step of the join.
STEP = 16


def band_problems(bands: DataFrame) -> DataFrame:
    """(problem, band, at): bands without a bound or name, reversed, overlapping, or with a hole before them.

    ``at`` is the first value concerned. Bands are a small table that is
    sorted as a whole.
    """
    bad = F.col(FROM).isNull() | F.col(TO).isNull() | F.col(NAME).isNull()
    broken = bands.filter(bad | (F.col(FROM) > F.col(TO))).select(
        F.when(bad, F.lit("incomplete")).otherwise(F.lit("reversed")).alias("problem"), NAME,
        F.col(FROM).cast("long").alias("at"))
    order = W.orderBy(FROM, TO, NAME)
    reach = F.max(TO).over(order.rowsBetween(W.unboundedPreceding, -1))
    sound = bands.filter(~bad & (F.col(FROM) <= F.col(TO))).withColumn("__reach", reach)
    gap = F.col(FROM) - F.col("__reach")
    between = sound.filter(gap != 1).select(
        F.when(gap < 1, F.lit("overlap")).otherwise(F.lit("hole")).alias("problem"), NAME,
        F.when(gap < 1, F.col(FROM)).otherwise(F.col("__reach") + 1).cast("long").alias("at"))
    return broken.unionByName(between)


class BandError(ValueError):
    pass


def assert_bands(bands: DataFrame) -> None:
    """Raise if the bands don't follow one another; the message names ten problems at most."""
    found = [f"{r['problem']} at {r['at']} ({r[NAME]})" for r in band_problems(bands).limit(10).collect()]
    if found:
        raise BandError("; ".join(sorted(found)))


def with_band(df: DataFrame, value: str, bands: DataFrame, out: str, step: int = STEP) -> DataFrame:
    """Add the name of the band that ``value`` lies in; "Unknown" without one.

    The bands are checked first. Each is written out once per ``step`` values
    that it covers, and rows meet those of their own step by equality, so that
    neither a cross join nor a loop over all bands is needed. A value without a
    band (or NULL) keeps its row.
    """
    assert_bands(bands)
    steps = F.sequence(F.floor(F.col(FROM) / step), F.floor(F.col(TO) / step))
    laid = bands.select(F.col(NAME).alias("__name"), F.col(FROM).alias("__from"), F.col(TO).alias("__to"),
                        F.explode(steps).alias("__step"))
    at = F.floor(F.col(value) / step)
    inside = (at == laid["__step"]) & F.col(value).between(laid["__from"], laid["__to"])
    return (df.join(laid, inside, "left").withColumn(out, F.coalesce("__name", F.lit(UNKNOWN)))
            .drop("__name", "__from", "__to", "__step"))
