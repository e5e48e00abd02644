"""Delimited text readers (any one-character separator).

Raw files are read with an all-string schema so that nothing is inferred:
inference costs a second pass over the data and makes column types depend on
the file. Types are applied later by ``operators.shape.to_typed`` with
``try_cast`` so that one bad cell never stops a job.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staffmart.sources.headers import (
    LINE,
    HeaderError,
    as_list,
    column_names,
    files_by_header,
    first_line,
    header_cells,
    input_files,
    named_cells,
)

# The whole line of a row that has more cells than its reader has columns.
WIDE_LINE = "_wide_line"
_MALFORMED = "_malformed_line"


def string_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def overflow_names(start: int, count: int) -> list[str]:
    """Spark's positional names for cells past the named columns."""
    return [f"_c{i}" for i in range(start, start + count)]


def keep_malformed(reader, names: Sequence[str]):
    """Give a CSV reader (batch or stream) the schema ``names`` plus the raw line
    of rows with another number of cells. The line is lost when the parser
    prunes columns, so it must not."""
    return (reader.option("columnNameOfCorruptRecord", _MALFORMED).option("columnPruning", False)
            .schema(string_schema([*names, _MALFORMED])))


def _wide_pattern(sep: str, width: int) -> str:
    """A pattern of lines with a filled cell past the first ``width``.

    A cell that begins with a quote ends at the first separator with an even
    number of quotes before it in the cell (or with the line), any other at the
    next separator. A backslash takes the next character's meaning, but for a
    separator's. Every repetition is possessive: nothing is tried twice and no
    cell, however long, is a recursion.
    """
    at = re.escape(sep)
    inside = f"[^{at}]" if len(sep) == 1 else rf"(?:(?!{at})[\s\S])"
    bare = rf'[^"\\{at}]' if len(sep) == 1 else rf'(?:(?!{at})[^"\\])'
    escaped = rf"\\{inside}?+"
    quoted = rf'(?:"(?:[^"\\]++|{escaped})*+(?:"(?:{bare}++|{escaped})*+|\z))++'
    return rf"\A(?:(?>{quoted}|{inside}*+){at}){{{width}}}+(?:{at})*+[\s\S]"


def wide_line(line: Column, sep: str, width: int) -> Column:
    """``line`` if a cell past the first ``width`` is filled, else NULL.

    Lines with as many separators as ``width`` are matched by one pattern
    (``_wide_pattern``), so separators inside quoted cells don't count. One pass
    over the first ``width`` cells, however long; what is behind them is read up
    to its first character that is no separator.
    """
    seps = F.char_length(line) - F.char_length(F.replace(line, F.lit(sep), F.lit("")))
    return F.when((seps >= width * len(sep)) & line.rlike(_wide_pattern(sep, width)), line)


def with_wide_line(df: DataFrame, sep: str) -> DataFrame:
    """Replace the line of ``keep_malformed`` by ``WIDE_LINE``: the whole line of
    a row whose last cells were cut, else NULL."""
    width = len(df.columns) - 1
    # names a cell too: Spark refuses a scan that asks for nothing but the malformed line
    cell = F.col(f"`{df.columns[0]}`")
    line = F.when(cell.isNull() | (F.char_length(cell) >= 0), F.col(_MALFORMED))
    return df.withColumn(WIDE_LINE, wide_line(line, sep, width)).drop(_MALFORMED)


def _header_text(line: Column, sep: str) -> Column:
    """A header line without the separators behind its last name."""
    return F.rtrim(F.rtrim(line, F.lit("\r")), F.lit(sep))


def is_header(names: Sequence[str], sep: str) -> Column:
    """Whether the line is the header of ``names``, but for empty cells behind them."""
    return _header_text(F.col(LINE), sep) == F.lit(sep.join(names).rstrip(sep))


def data_lines(lines: DataFrame, sep: str, header: Sequence[str]) -> DataFrame:
    """Without blank lines and header lines."""
    return lines.filter((F.trim(LINE) != "") & ~is_header(header, sep))


def parse_lines(lines: DataFrame, sep: str, names: Sequence[str], wide_lines: bool = False) -> DataFrame:
    """Whole lines to string cells, as ``read_delimited`` reads them; other columns stay.

    For rows whose lines are looked at before they are cut (streams, broken lines).
    """
    ddl = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    rest = [c for c in lines.columns if c != LINE]
    cells = lines.select("*", F.from_csv(F.col(LINE), ddl, {"sep": sep, "mode": "PERMISSIVE"}).alias("_cells"))
    wide = [wide_line(F.col(LINE), sep, len(names)).alias(WIDE_LINE)] if wide_lines else []
    return cells.select("_cells.*", *wide, *rest)


def read_delimited(spark: SparkSession, path: str | Sequence[str], sep: str = ";",
                   columns: Sequence[str] | None = None, overflow: int = 0,
                   header: bool = True, encoding: str = "UTF-8",
                   wide_lines: bool = False) -> DataFrame:
    """Read delimited files into string columns.

    ``columns`` given: an explicit schema, plus ``overflow`` trailing columns
    named ``_cN`` that catch the extra cells of rows that slipped right. Every
    file's header must name just these columns in this order, but for empty
    cells behind them; another header raises ``HeaderError``.
    ``columns`` omitted: names come from the header line (empty names become
    ``_cN``, repeated names get their position appended). Files that order the
    same names differently are mapped by name; other names raise ``HeaderError``.
    No inference pass: one job finds the first lines of all files to plan.

    ``wide_lines`` adds ``WIDE_LINE``, the raw line of rows with more cells
    than there are columns; without it these cells are cut off.
    Blank lines are skipped; leading and trailing spaces inside cells are kept.
    """
    def reader() -> DataFrameReader:
        return (spark.read
                .option("sep", sep)
                .option("header", header)
                .option("encoding", encoding)
                .option("mode", "PERMISSIVE")
                .option("ignoreLeadingWhiteSpace", False)
                .option("ignoreTrailingWhiteSpace", False)
                .option("inferSchema", False))

    def read(files: list[str], names: Sequence[str]) -> DataFrame:
        if wide_lines:
            return with_wide_line(keep_malformed(reader(), names).csv(files), sep)
        return reader().schema(string_schema(names)).csv(files)

    paths = as_list(path)
    if not header:
        if columns is None:
            raise ValueError("files without a header need column names")
        return read(paths, [*columns, *overflow_names(len(columns), overflow)])
    if columns is None:
        line = first_line(spark, path)
        if line is None:
            raise HeaderError(f"no header line in {', '.join(paths)}")
        cells = header_cells(line, sep)
    else:
        cells = list(columns)
    expected = column_names(cells)
    named = len(named_cells(cells))
    odd: dict[tuple[str, ...], list[str]] = {}
    for other, files in _odd_headers(spark, path, cells, sep).items():
        order = column_names(named_cells(other))
        if columns is not None or set(order) != set(expected[:named]):
            raise HeaderError(f"{files[0]}: header {list(other)}, expected {cells}")
        # cells behind the last name are those of the first header, so none is cut unseen
        odd[order + expected[named:]] = files
    names = [*expected, *overflow_names(len(expected), overflow)]
    if not odd:
        return read(paths, names)
    moved = {f for files in odd.values() for f in files}
    rest = [f for f in input_files(spark, paths) if f not in moved]
    parts = [read(rest, names)] if rest else []
    parts += [read(files, order) for order, files in odd.items()]
    return reduce(DataFrame.unionByName, parts)


def _odd_headers(spark: SparkSession, path: str | Sequence[str], cells: Sequence[str],
                 sep: str) -> dict[tuple[str, ...], list[str]]:
    """Headers that order ``cells`` differently, with their files; quoted ones are the same by their cells."""
    others = files_by_header(spark, path, cells, is_header(cells, sep), lambda line: header_cells(line, sep))
    return {other: files for other, files in others.items() if named_cells(other) != named_cells(cells)}


def require_header(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], sep: str) -> None:
    """Raise ``HeaderError`` unless every file's header names just these columns in this order."""
    for other, files in _odd_headers(spark, path, columns, sep).items():
        raise HeaderError(f"{files[0]}: header {list(other)}, expected {list(columns)}")


def is_wide() -> Column:
    return F.col(WIDE_LINE).isNotNull()
