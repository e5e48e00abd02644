"""Generation bands by age, as a native CASE expression (no Python UDF).

A NULL or out-of-range age is "Unknown" instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Generation name and inclusive age range, in order.
GENERATION_BANDS = [
    ("Gen Z", 0, 24),
    ("Millennial", 25, 40),
    ("Gen X", 41, 56),
    ("Boomer", 57, 75),
    ("Silent", 76, 100),
]
UNKNOWN = "Unknown"


def generation(age: Column | str, bands=GENERATION_BANDS) -> Column:
    age_col = F.col(age) if isinstance(age, str) else age
    expr = None
    for name, low, high in bands:
        cond = age_col.between(low, high)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(UNKNOWN))
