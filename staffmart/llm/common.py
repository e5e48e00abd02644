"""Shared helpers of the corpus operators: words, scratch tables, ranks, batches."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from staffmart.session import scratch_path

# Fixed values of the contracts: a word, and the blanks that separate words.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def n_words(text: Column) -> Column:
    """Words of a text as a long; a null text has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_PATTERN)).cast("long")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` under spark.checkpoint.dir and read it back.

    The folder is one that driver and executors share, so a lost executor
    costs a reread, not a recomputation. It goes when the session's JVM ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.deleteOnExit(where)
    out = spark.read.schema(df.schema).parquet(path)
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a ``materialise`` result that nothing reads any more."""
    spark = df.sparkSession
    for file in df.inputFiles():
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file)
        fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.delete(where, False)


# Rows that one window task may have to number; groups above it are cut by hash.
BLOCK_ROWS = 250_000


def numbered(df: DataFrame, group: list[str], band: str, digest: str, out: str,
             rows: int) -> DataFrame:
    """Add ``out``: the 1-based place of each row in its group, by band, then digest.

    A window over a whole group would put a hot group into one task. Instead
    rows are counted per block (group, band, first digits of the hex digest),
    the counts are summed up (one row per block), and windows number the rows
    of each block alone. The length of the prefix follows ``rows``, so that
    blocks stay near ``BLOCK_ROWS`` at any size; the numbering is the same for
    every length. ``group`` and ``band`` must not be null.
    """
    digits = max(0, math.ceil(math.log(max(rows, 1) / BLOCK_ROWS, 16)))
    block, before, base, n = (fresh(df, c) for c in ("block_", "before_", "base_", "n_"))
    cut = df.withColumn(block, F.substring(digest, 1, digits) if digits else F.lit(""))
    counts = cut.groupBy(*group, band, block).agg(F.count(F.lit(1)).alias(n))
    preceding = (W.unboundedPreceding, -1)
    within = W.partitionBy(*group, band).orderBy(block).rowsBetween(*preceding)
    offsets = counts.withColumn(before, F.coalesce(F.sum(n).over(within), F.lit(0)))
    bands = counts.groupBy(*group, band).agg(F.sum(n).alias(n))
    over = W.partitionBy(*group).orderBy(band).rowsBetween(*preceding)
    bands = bands.withColumn(base, F.coalesce(F.sum(n).over(over), F.lit(0))).drop(n)
    offsets = offsets.join(bands, [*group, band]).select(
        *group, band, block, (F.col(base) + F.col(before)).alias(before))
    place = F.row_number().over(W.partitionBy(*group, band, block).orderBy(digest))
    return (cut.withColumn(out, place).join(offsets, [*group, band, block])
            .withColumn(out, (F.col(out) + F.col(before)).cast("long"))
            .select(*df.columns, out))


# Bytes of text that a Python worker handles at once.
SLICE_BYTES = 2_000_000


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with at most ``limit`` bytes of ``column``, one row at least."""
    size, start = 0, 0
    lengths = pc.binary_length(batch.column(column)).to_pylist()
    for i, n in enumerate(lengths):
        if size + (n or 0) > limit and i > start:
            yield batch.slice(start, i - start)
            size, start = 0, i
        size += n or 0
    if start < batch.num_rows:
        yield batch.slice(start)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
