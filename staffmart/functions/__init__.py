from staffmart.functions.bands import GENERATION_BANDS, UNKNOWN, generation
from staffmart.functions.casting import exact_decimal, is_digits, try_decimal, try_int
from staffmart.functions.temporal import (
    DAYS_PER_YEAR,
    EXCEL_EPOCH,
    age_in_full_years,
    as_date,
    excel_serial_to_date,
    parse_day_first,
    tenure_days,
)
from staffmart.functions.text import correct, is_code, strip_leading, title_case
from staffmart.functions.tokens import TokenKey, key_from_conf, token

__all__ = [
    "GENERATION_BANDS", "UNKNOWN", "generation", "exact_decimal", "is_digits",
    "try_decimal", "try_int", "DAYS_PER_YEAR", "EXCEL_EPOCH", "age_in_full_years",
    "as_date", "excel_serial_to_date", "parse_day_first", "tenure_days", "correct",
    "is_code", "strip_leading", "title_case", "TokenKey", "key_from_conf", "token",
]
