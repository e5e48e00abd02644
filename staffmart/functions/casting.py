"""Safe casts and "does this text look like X" tests.

With ANSI mode on (Spark 4 default) ``cast`` throws on bad input, so a cast
can no longer double as a type test. These use ``try_cast`` and regular
expressions instead; none of them ever fails a job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_int(c: Column | str) -> Column:
    return _col(c).try_cast("int")


def try_decimal(c: Column | str, precision: int = 18, scale: int = 2) -> Column:
    return _col(c).try_cast(f"decimal({precision},{scale})")


def exact_decimal(c: Column | str, precision: int = 18, scale: int = 2) -> Column:
    """``try_decimal`` of plain number text that the type holds to the last digit, else NULL.

    A cast rounds "10.999" to 11.00; here more decimals than ``scale`` (zeros
    apart), like too many digits, give NULL, so that the text can be rejected.
    """
    text = F.trim(_col(c).cast("string"))
    plain = text.rlike(rf"^[+-]?[0-9]*\.?[0-9]{{0,{scale}}}0*$")
    return F.when(plain, text.try_cast(f"decimal({precision},{scale})"))


def is_digits(c: Column | str, min_len: int = 1) -> Column:
    return _col(c).rlike(f"^[0-9]{{{min_len},}}$")
