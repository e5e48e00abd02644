"""Header lines of raw files, checked for all files in one job.

The first line of every file is found by one aggregate over the lines that lie
in a file's first block: per file the smallest row number of all lines, of
those that are the expected header and of those that name the same columns in
another order. Rows are numbered in the order of the scan, and a first block is
read by one task, so the smallest number is the first line. Only files whose
first line is not the expected header reach the driver.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BOM = "\ufeff"
LINE, FILE, BLOCK = "value", "_file", "_block"
_UNNAMED = re.compile(r"_c\d+")


class HeaderError(ValueError):
    """A raw file's header does not name the columns that its reader expects."""


def as_list(path: str | Sequence[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def _file(uri: str) -> str:
    """One spelling of a file's URI: Spark lists local files with one slash or three, and escapes some letters."""
    return re.sub("^file:/+", "file:///", unquote(uri))


def input_files(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """The files of a path, by name; the text source has a fixed schema, so this lists them and reads none."""
    return sorted(_file(f) for f in spark.read.text(as_list(path)).inputFiles())


def with_origin(text: DataFrame) -> DataFrame:
    """Whole lines (of a text source, batch or stream) with their file and its block's start."""
    return text.select(F.ltrim(F.col(LINE), F.lit(BOM)).alias(LINE), F.col("_metadata.file_path").alias(FILE),
                       F.col("_metadata.file_block_start").alias(BLOCK))


def header_cells(line: str, sep: str) -> list[str]:
    """The cells of a header line, quotes taken off."""
    return next(csv.reader([line.strip("\r\n")], delimiter=sep, quotechar='"', escapechar="\\"), [])


def named_cells(cells: Sequence[str]) -> list[str]:
    """Without the cells behind the last name; writers may spell an empty name by its position."""
    out = list(cells)
    while out and (not out[-1] or _UNNAMED.fullmatch(out[-1])):
        out.pop()
    return out


def column_names(cells: Sequence[str]) -> tuple[str, ...]:
    """Unique names: an empty cell is called by its position, a repeated one gets it appended."""
    lower = [c.lower() for c in cells]
    return tuple(f"_c{i}" if not c else f"{c}{i}" if lower.count(c.lower()) > 1 else c
                 for i, c in enumerate(cells))


@dataclass
class Headers:
    """What one look at all files found."""

    headers: int = 0  # files that begin with the expected header or a reordered one
    foreign: list[str] = field(default_factory=list)  # the first file that begins with another line
    reordered: dict[str, str] = field(default_factory=dict)  # file -> its header line


def check_headers(lines: DataFrame, names: Sequence[str], same: Column,
                  header_in_each_file: bool = True) -> Headers:
    """Look at the first line of every file of ``with_origin`` lines.

    ``same`` tells the expected header line. Another line that holds all
    ``names`` is a reordered header, any other foreign, unless
    ``header_in_each_file`` is off and it holds none of the names.
    """
    held = [F.contains(F.col(LINE), F.lit(n)) for n in names if n]
    every, some = reduce(lambda a, b: a & b, held), reduce(lambda a, b: a | b, held)
    row = F.monotonically_increasing_id()
    first = lines.filter((F.col(BLOCK) == 0) & (F.trim(LINE) != "")).withColumn("row", row)

    def smallest(which: Column) -> Column:
        return F.min(F.when(which, F.col("row")))

    per_file = first.groupBy(FILE).agg(F.min("row").alias("first"), smallest(same).alias("same"),
                                       smallest(every).alias("every"), smallest(some).alias("some"))
    is_same = F.col("same").eqNullSafe(F.col("first"))
    is_other = F.col("every").eqNullSafe(F.col("first")) & ~is_same
    strange = ~is_same & ~is_other
    if not header_in_each_file:
        strange = strange & F.col("some").eqNullSafe(F.col("first"))
    kind = F.when(is_same, "same").when(is_other, "reordered").when(strange, "foreign").otherwise("part")
    kinds = per_file.select(FILE, kind.alias("kind")).groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"),
        # names of the files that are neither: a list of those that need a read of their own
        F.collect_list(F.when(F.col("kind") == "reordered", F.col(FILE))).alias("files"),
        F.min(F.when(F.col("kind") == "foreign", F.col(FILE))).alias("smallest"))
    out = Headers()
    for r in kinds.collect():
        if r["kind"] in ("same", "reordered"):
            out.headers += r["n"]
        if r["kind"] == "foreign":
            out.foreign.append(_file(r["smallest"]))
        out.reordered |= {f: "" for f in r["files"]}
    if out.reordered and not out.foreign:
        found = (first.filter(every & F.col(FILE).isin(list(out.reordered))).groupBy(FILE)
                 .agg(F.min(F.struct("row", LINE)).alias("at")).select(FILE, F.col(f"at.{LINE}").alias(LINE)))
        out.reordered = {_file(r[FILE]): r[LINE] for r in found.collect()}
    return out


def first_line(spark: SparkSession, path: str | Sequence[str]) -> str | None:
    """The first line of the first file, by name, that has one."""
    for file in input_files(spark, path):
        found = with_origin(spark.read.text(file)).filter(F.trim(LINE) != "").head()
        if found:
            return found[LINE]
    return None


def line_of(spark: SparkSession, file: str) -> str:
    """A file's first line, for a message."""
    return (first_line(spark, file) or "").strip()


def files_by_header(spark: SparkSession, path: str | Sequence[str], names: Sequence[str], same: Column,
                    cells: Callable[[str], Sequence[str]], header_in_each_file: bool = True,
                    ) -> dict[tuple[str, ...], list[str]]:
    """Cells of the header -> files that carry it, for files that don't begin with the expected header.

    Raises ``HeaderError`` for a foreign first line, and when no file begins
    with a header at all. Of a single file only the first line is read.
    """
    files = input_files(spark, path)
    if len(files) == 1:
        alone = F.lit(first_line(spark, files) or "").alias(LINE)
        lines = spark.range(1).select(alone, F.lit(files[0]).alias(FILE), F.lit(0).alias(BLOCK))
    else:
        lines = with_origin(spark.read.text(as_list(path)))
    found = check_headers(lines, names, same, header_in_each_file)
    if found.foreign:
        raise HeaderError(f"{found.foreign[0]}: first line {line_of(spark, found.foreign[0])!r}, "
                          f"expected {list(names)}")
    if not found.headers:
        raise HeaderError(f"no header {list(names)} in {', '.join(as_list(path))}")
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, line in found.reordered.items():
        groups.setdefault(tuple(cells(line)), []).append(file)
    return groups
