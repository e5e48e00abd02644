"""Lines that an export broke in two, put together again.

A head half and the tail half that follows it in its file (blank lines aside)
make one line. Which lines are halves is told by tests on their cells. Only
halves are moved: rows are numbered by the scan, one aggregate per file block
gives each block's place in its file, and a half's line number follows from
both, so that a head at the end of a block meets its tail at the start of the
next one, which another task reads. All other lines go straight through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from staffmart.session import scratch_path
from staffmart.sources.delimited import data_lines, overflow_names, parse_lines, require_header
from staffmart.sources.headers import BLOCK, FILE, LINE, as_list, with_origin

_ROW, _HALF = "_row", "_half"
HEAD, TAIL = "head", "tail"


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def stitched_lines(halves: DataFrame, blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(whole lines made of two halves, halves without a partner).

    ``halves`` has the line, its file, block, row number and kind; ``blocks``
    the first row number and the number of rows of each block of a file.
    """
    before = W.partitionBy(FILE).orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)
    starts = blocks.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first"))
    placed = halves.join(starts.select(FILE, BLOCK, "start"), [FILE, BLOCK]).withColumn(
        "line", F.col("start") + F.col(_ROW)).select(LINE, FILE, BLOCK, "line", _HALF)
    placed = _written(placed, "halves")
    heads = placed.filter(F.col(_HALF) == HEAD).select(
        FILE, "line", F.rtrim(F.col(LINE), F.lit("\r")).alias("head"))
    tails = placed.filter(F.col(_HALF) == TAIL).select(
        FILE, (F.col("line") - 1).alias("line"), F.col(LINE).alias("tail"))
    pairs = _written(heads.join(tails, [FILE, "line"]), "pairs")
    paired = pairs.select(FILE, F.explode(F.array("line", F.col("line") + 1)).alias("line"))
    return (pairs.select(F.concat("head", "tail").alias(LINE)),
            placed.join(paired, [FILE, "line"], "left_anti").select(LINE))


def read_stitched(spark: SparkSession, path: str | Sequence[str], sep: str, columns: Sequence[str],
                  is_head: Column, is_tail: Column, overflow: int = 0) -> DataFrame:
    """``read_delimited`` with a whole row for every broken one, and ``WIDE_LINE``.

    ``is_head`` and ``is_tail`` are tests on the cells. A half whose partner
    does not follow it stays as it is. Two narrow jobs run when this is called.
    """
    require_header(spark, path, columns, sep)
    names = [*columns, *overflow_names(len(columns), overflow)]
    lines = data_lines(with_origin(spark.read.text(as_list(path))), sep, columns).withColumn(
        _ROW, F.monotonically_increasing_id())
    kind = F.when(is_tail, F.lit(TAIL)).when(is_head, F.lit(HEAD))
    cut = parse_lines(lines.withColumn("_line", F.col(LINE)), sep, names, wide_lines=True).withColumn(_HALF, kind)
    halves = cut.filter(F.col(_HALF).isNotNull()).select(F.col("_line").alias(LINE), FILE, BLOCK, _ROW, _HALF)
    blocks = lines.groupBy(FILE, BLOCK).agg(F.min(_ROW).alias("first"), F.count(F.lit(1)).alias("n"))
    whole, alone = stitched_lines(halves, _written(blocks, "blocks"))
    rest = cut.filter(F.col(_HALF).isNull()).drop("_line", FILE, BLOCK, _ROW, _HALF)
    return rest.unionByName(parse_lines(whole.unionByName(alone), sep, names, wide_lines=True))
