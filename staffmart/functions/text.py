"""Text clean-up expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_leading(c: Column | str, char: str = "@") -> Column:
    """Remove a run of ``char`` in front of a value made of other characters."""
    ch = re.escape(char)
    return F.regexp_replace(_col(c), f"^{ch}+([^{ch}]+)$", "$1")


def correct(c: Column | str, corrections: Mapping[str, str]) -> Column:
    """Replace each known misspelling by its correction (literal, anywhere)."""
    out = _col(c)
    for wrong, right in corrections.items():
        out = F.replace(out, F.lit(wrong), F.lit(right))
    return out


def title_case(c: Column | str) -> Column:
    """First letter of each space-separated word upper, the rest lower."""
    return F.initcap(_col(c))


def is_code(c: Column | str, min_len: int = 2) -> Column:
    """An all-capitals token such as a position code (``FIIV``, ``OPV``)."""
    return _col(c).rlike(f"^[A-Z]{{{min_len},}}$")
