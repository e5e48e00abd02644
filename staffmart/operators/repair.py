"""Repair of rows whose values slipped sideways.

Two shapes of the same defect occur in delimited HR files:

* ``realign`` — an extra empty cell pushed every later value one column to
  the right, so the row has one more cell than the header. Read with an
  overflow column (see ``sources.read_delimited``), the row is recognised by
  its filled overflow cell or by values under the wrong header, the spurious
  gap is located and the cells right of it move back. One projection of ``CASE`` expressions per column: no
  neighbour-order cascade, no UDF, one row at a time (no shuffle).
* ``fill_from_right`` — the ordered "take the neighbour's value when empty,
  then clear the neighbour if it now repeats" cascade, for data that was
  already cut to the header width.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Validator = Callable[[Column], Column]

# Values of the status column written by ``realign``.
CLEAN, REPAIRED, UNREPAIRED = 0, 1, -1
STATUS_COLUMN = "_realign_status"


def _accepts(validator: Validator | None, value: Column) -> Column:
    """NULL-tolerant validator: an empty cell is always acceptable."""
    if validator is None:
        return F.lit(True)
    return value.isNull() | F.coalesce(validator(value), F.lit(False))


def realign(df: DataFrame, columns: Sequence[str], overflow: Sequence[str] = (),
            validators: Mapping[str, Validator] | None = None,
            status_column: str = STATUS_COLUMN) -> DataFrame:
    """Move the cells of right-shifted rows back under their headers.

    ``columns`` are the named columns in file order; ``overflow`` the extra
    cells past them (``_c<N>``). A row is *shifted* when its first overflow
    cell is filled, or (its last cell was empty, or the data was cut to the
    header width) when right of an empty cell stands a value that its own
    column rejects and the column to its left accepts. A gap is an empty cell
    among ``columns`` whose removal yields values that every validator
    accepts (validators map a column name to a ``Column -> boolean`` test;
    absent ones accept all). The cells from the gap on are replaced by their
    right neighbours.

    Output: ``df`` without the overflow columns, with the repaired
    ``columns`` and ``status_column`` = 0 (clean), 1 (repaired) or
    -1 (shifted but not repairable: two extra cells, no acceptable gap, or
    several whose removal gives different rows). Rows with -1 keep their
    cells unchanged; route them to quarantine.
    """
    validators = validators or {}
    cols = list(columns)
    n = len(cols)
    cells = [F.col(c) for c in cols]
    cells.append(F.col(overflow[0]) if overflow else F.lit(None).cast("string"))
    two_gaps = F.lit(False)
    for c in overflow[1:]:
        two_gaps = two_gaps | F.col(c).isNotNull()

    shifted = cells[n].isNotNull() | two_gaps
    empty_before = cells[0].isNull()
    for i in range(1, n):
        own, left = validators.get(cols[i]), validators.get(cols[i - 1])
        if own is not None and left is not None:
            shifted = shifted | (empty_before & cells[i].isNotNull()
                                 & ~_accepts(own, cells[i]) & _accepts(left, cells[i]))
        empty_before = empty_before | cells[i].isNull()

    # A gap lies at or before the first column that rejects its own cell, and
    # behind the last one that rejects its right neighbour's. Each bound is
    # named once in a lambda: pushed filters inline these expressions.
    accepts = [validators.get(c) for c in cols]
    last_ok = F.coalesce(*[F.when(~_accepts(accepts[i], cells[i]), F.lit(i)) for i in range(n)],
                         F.lit(n))
    first_ok = F.coalesce(*[F.when(~_accepts(accepts[i], cells[i + 1]), F.lit(i + 1))
                            for i in reversed(range(n))], F.lit(0))
    empty = F.array(*[F.when(cells[j].isNull(), F.lit(j)) for j in range(n)])
    filled = F.array(*[F.when(cells[j].isNotNull(), F.lit(j)) for j in range(n)])
    gaps_col, gap_col = "__gaps", "__gap"
    gaps = F.when(shifted, F.filter(empty, lambda j: (j >= first_ok) & (j <= last_ok)))
    # Two gaps give the same row only if nothing but empty cells lies between.
    first, last = F.array_min(gaps_col), F.array_max(gaps_col)
    between = F.filter(filled, lambda i: (i > first) & (i < last))
    repairable = ~two_gaps & (F.size(gaps_col) > 0) & (F.size(between) == 0)
    status = (F.when(F.col(gaps_col).isNull(), F.lit(CLEAN))
              .when(repairable, F.lit(REPAIRED))
              .otherwise(F.lit(UNREPAIRED)))
    fixed = {}
    for i, c in enumerate(cols):
        moved = (F.col(status_column) == F.lit(REPAIRED)) & (F.col(gap_col) <= F.lit(i))
        fixed[c] = F.when(moved, cells[i + 1]).otherwise(cells[i])
    return (df
            .withColumn(gaps_col, gaps)
            .withColumns({status_column: status, gap_col: first})
            .withColumns(fixed)
            .drop(gaps_col, gap_col, *overflow))


def fill_from_right(df: DataFrame, chain: Sequence[str]) -> DataFrame:
    """Ordered pairwise cascade along ``chain`` (left to right).

    For each neighbour pair (a, b) in turn: ``a := coalesce(a, b)``, then
    ``b := NULL if b = a``. Each step sees the result of the previous one,
    so a value can travel one column left per pair.
    """
    out = df
    for left, right in zip(chain, chain[1:]):
        out = out.withColumn(left, F.coalesce(F.col(left), F.col(right)))
        out = out.withColumn(right, F.nullif(F.col(right), F.col(left)))
    return out
