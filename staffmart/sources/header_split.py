"""Reader for pipe files whose separator is sometimes doubled.

Each line is read whole, doubled separators are squashed, the line is split
and cells are taken by position with ``get`` (NULL past the end, where a
plain index would throw under ANSI). Header lines are mapped by name; in the
rows they are recognised by their text.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staffmart.sources.delimited import WIDE_LINE, wide_line
from staffmart.sources.headers import BOM, LINE, HeaderError, as_list, files_by_header, first_line, input_files


def _squashed(line: Column, sep: str) -> Column:
    doubled = re.escape(sep * 2)
    return F.regexp_replace(F.regexp_replace(line, "^" + BOM, ""), doubled, sep)


def squashed_header(names: Sequence[str], sep: str) -> Column:
    """Whether the line is the header of ``names``, some separators doubled."""
    return _squashed(F.col(LINE), sep) == F.lit(sep.join(names))


def split_lines(text: DataFrame, sep: str, names: Sequence[str],
                wide_lines: bool = False) -> DataFrame:
    """Whole lines (column ``value``, as ``spark.read.text`` or
    ``spark.readStream.text`` give them) to named cells: BOM stripped,
    doubled separators squashed, header and blank lines dropped.
    ``wide_lines`` adds the whole line of rows with more cells than names."""
    lines = text.select(_squashed(F.col(LINE), sep).alias("line"))
    header_text = sep.join(names)
    cells = F.split(F.col("line"), re.escape(sep))
    wide = [wide_line(F.col("line"), sep, len(names)).alias(WIDE_LINE)] if wide_lines else []
    return (lines
            .filter((F.col("line") != header_text) & (F.trim(F.col("line")) != ""))
            .select([F.get(cells, i).alias(n) for i, n in enumerate(names)] + wide))


def read_header_split(spark: SparkSession, path: str | Sequence[str], sep: str = "|",
                      names: Sequence[str] | None = None, wide_lines: bool = False,
                      header_in_each_file: bool = True) -> DataFrame:
    """Read pipe files into string columns ``names`` (omitted: those of the first header).

    A file whose header orders the names differently is mapped by name. A
    first line that is no header raises ``HeaderError``, unless
    ``header_in_each_file`` is off and it holds none of the names: such files
    are parts of a larger one, with cells in the order of ``names``. One job
    finds the first lines of all files.
    ``wide_lines`` as in ``split_lines``.
    """
    def cells(line: str) -> list[str]:
        return line.removeprefix(BOM).rstrip("\r").replace(sep * 2, sep).split(sep)

    if names is None:
        names = cells(first_line(spark, path) or "")
    paths = as_list(path)
    ordered = files_by_header(spark, path, names, squashed_header(names, sep), cells, header_in_each_file)
    for header, files in ordered.items():
        if sorted(header) != sorted(names):
            raise HeaderError(f"{files[0]}: first line {list(header)}, expected {list(names)}")
    columns = [*names, WIDE_LINE] if wide_lines else list(names)

    def read(files: list[str], order: Sequence[str]) -> DataFrame:
        return split_lines(spark.read.text(files), sep, order, wide_lines).select(*columns)

    if not ordered:
        return read(paths, names)
    moved = {f for files in ordered.values() for f in files}
    rest = [f for f in input_files(spark, paths) if f not in moved]
    parts = [read(rest, names)] if rest else []
    return reduce(DataFrame.unionByName, parts + [read(files, order) for order, files in ordered.items()])
