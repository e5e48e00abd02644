"""Date helpers: Excel serials, day-first text dates, tenure and age.

Every "now" is an explicit ``as_of`` date so that a rerun of the same input
gives the same answer and all rows of a run share one reference day.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. Day zero of Excel's 1900 date system (serial 1 = 1899-12-31,
# with the phantom 1900-02-29 folded in), and the mean year length used to
# turn a day count into years.
EXCEL_EPOCH = "1899-12-30"
DAYS_PER_YEAR = 365.25
DAY_FIRST_FORMAT = "dd/MM/yyyy"
# A serial as text, and the serials of 0001-01-01 and 9999-12-31.
SERIAL_PATTERN = r"^-?[0-9]+(\.[0-9]+)?$"
FIRST_SERIAL, LAST_SERIAL = -693_593, 2_958_465


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(value: date | str | Column) -> Column:
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(str(value)).cast("date")


def excel_serial_to_date(serial: Column | str) -> Column:
    """Excel serial (text or number, fraction = time of day) to a date.

    Only plain digits with an optional sign and fraction, of the years 1 to
    9999, are serials; any other text gives NULL. Days before the epoch are
    kept, so that the date rules can reject them.
    """
    text = F.trim(_col(serial).cast("string"))
    days = F.when(text.rlike(SERIAL_PATTERN), F.floor(text.try_cast("double")))
    return F.date_add(F.lit(EXCEL_EPOCH).cast("date"),
                      F.when(days.between(FIRST_SERIAL, LAST_SERIAL), days).cast("int"))


def parse_day_first(text: Column | str, fmt: str = DAY_FIRST_FORMAT) -> Column:
    """``dd/MM/yyyy`` text to a date; anything else gives NULL."""
    return F.try_to_date(_col(text), fmt)


def tenure_days(start: Column | str, end: Column | str, as_of: date | str | Column) -> Column:
    """Days from ``start`` to ``end``; an open spell (NULL end) runs to ``as_of``."""
    return F.datediff(F.coalesce(_col(end), as_date(as_of)), _col(start))


def age_in_full_years(birth: Column | str, as_of: date | str | Column) -> Column:
    """Completed years between ``birth`` and ``as_of`` (bigint)."""
    return F.floor(F.months_between(as_date(as_of), _col(birth)) / F.lit(12))
