"""Partial states of the marts, kept per month, so that gold can be made without the silver rows.

A state row holds what its rows add to a mart and nothing of them: integer
sums of days, and a sketch of the people's tokens. States of any months merge
to the same mart as the rows themselves would give, exactly for the means,
within the sketch's error for the headcounts; a month whose rows change is
computed again alone (``merge_partitions`` swaps it in).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffmart.operators import marts

DAYS, SPELLS, PEOPLE = "days", "spells", "people"
# Registers of a sketch, as a power of two: a relative standard error of 1.04 / sqrt(2^12), some 1.6 %.
LOG_REGISTERS = 12
STANDARD_ERROR = 1.04 / 2 ** (LOG_REGISTERS / 2)


def spell_states(spells: DataFrame, month: Sequence[str], by: Sequence[str], days: str) -> DataFrame:
    """Sums of days and numbers of spells per month and group."""
    return spells.groupBy(*month, *by).agg(F.sum(days).alias(DAYS), F.count(days).alias(SPELLS))


def people_states(people: DataFrame, month: Sequence[str], by: Sequence[str], token: str) -> DataFrame:
    """A sketch of the distinct tokens per month and group."""
    sketch = F.hll_sketch_agg(F.col(token), F.lit(LOG_REGISTERS))
    return people.groupBy(*month, *by).agg(sketch.alias(PEOPLE))


def merged_spells(states: DataFrame, by: Sequence[str]) -> DataFrame:
    """The sums per group over all months; ``by`` are columns of the states."""
    return states.groupBy(*by).agg(F.sum(DAYS).alias(DAYS), F.sum(SPELLS).alias(SPELLS))


def merged_people(states: DataFrame, by: Sequence[str]) -> DataFrame:
    """A sketch per group of the people of all months; ``by`` are columns of the states."""
    return states.groupBy(*by).agg(F.hll_union_agg(PEOPLE).alias(PEOPLE))


def means_of(states: DataFrame, by: Sequence[str]) -> DataFrame:
    """Exact means over all months of the states."""
    return marts.mean_years_from_sums(states, by, DAYS, SPELLS)


def headcounts_of(states: DataFrame, by: Sequence[str]) -> DataFrame:
    """People per group over all months: a person in two months counts once."""
    return states.groupBy(*by).agg(
        F.hll_sketch_estimate(F.hll_union_agg(PEOPLE)).alias(marts.HEADCOUNT))
