"""Row filters: allowed values, fragments of broken lines, required cells."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffmart.functions.text import is_code


def keep_in_set(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Keep rows whose ``column`` is one of a short, fixed list of values.

    An ``IN`` list reaches the Parquet scan as a pushed filter.
    """
    return df.filter(F.col(column).isin(list(values)))


def is_fragment(column: str, code_min_len: int = 2) -> Column:
    """True for the tail half of a line broken in two: its first cell is empty
    or an all-capitals code that belongs to a later column."""
    c = F.col(column)
    return c.isNull() | is_code(c, code_min_len)


def drop_fragments(df: DataFrame, column: str, code_min_len: int = 2) -> DataFrame:
    return df.filter(~is_fragment(column, code_min_len))


def keep_not_null(df: DataFrame, column: str) -> DataFrame:
    """Drop rows with an empty ``column`` (the head half of a broken line)."""
    return df.filter(F.col(column).isNotNull())
