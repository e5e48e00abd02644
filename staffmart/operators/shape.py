"""Projection operators: drop filler columns, rename by map, typed projection."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spark's positional names for cells under an empty header name.
FILLER_PATTERN = r"^_c\d+$"


def drop_filler_columns(df: DataFrame, pattern: str = FILLER_PATTERN) -> DataFrame:
    """Drop every column whose name matches ``pattern`` (default ``_c<N>``)."""
    regex = re.compile(pattern)
    return df.drop(*[c for c in df.columns if regex.match(c)])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map in one projection; names absent from ``df`` are ignored."""
    present = {src: dst for src, dst in mapping.items() if src in df.columns}
    return df.withColumnsRenamed(present) if present else df


def select_renamed(df: DataFrame, columns: Sequence[str],
                   mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Keep ``columns`` in that order, then rename them by ``mapping``."""
    mapping = mapping or {}
    return df.select([F.col(c).alias(mapping.get(c, c)) for c in columns])


def to_typed(df: DataFrame, types: Mapping[str, str | T.DataType]) -> DataFrame:
    """Cast the listed columns with ``try_cast`` (bad cells become NULL)."""
    exprs = []
    for c in df.columns:
        if c in types:
            exprs.append(F.col(c).try_cast(types[c]).alias(c))
        else:
            exprs.append(F.col(c))
    return df.select(exprs)
