"""Parquet sinks: stamped full-overwrite tables, month-partitioned tables, merges by key.

Every write of one run carries the same ``created_at`` literal (UTC wall
clock, fixed on the driver once), so a table's rows never disagree about when
they were ingested.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staffmart.sources.publish import path_exists, publishing, recover, remove, swap

STAMP_COLUMN = "created_at"
# Partitions moved at a time; a move is a few calls of the file system.
SWAPS_AT_ONCE = 16
# Fixed: the folder name of a partition without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# Bounds the size of any one output file, whatever the skew of a partition.
MAX_RECORDS_PER_FILE = 5_000_000


def run_timestamp() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def stamp(df: DataFrame, run_ts: str | None = None, column: str = STAMP_COLUMN) -> DataFrame:
    ts = run_ts or run_timestamp()
    return df.withColumn(column, F.lit(ts).cast("timestamp_ntz"))


def write_table(df: DataFrame, path: str, run_ts: str | None = None,
                mode: str = "overwrite", stamped: bool = True) -> T.StructType:
    """Unpartitioned Parquet table, replaced as a whole.

    Returns the schema as a reader sees it (every column nullable), so the
    table can be read back without inferring it again.
    """
    out = stamp(df, run_ts) if stamped else df
    out.write.mode(mode).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(path)
    return as_read_back(out.schema)


def as_read_back(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def month_columns(date_col: str) -> tuple[str, str]:
    return f"year_{date_col}", f"month_{date_col}"


def with_month_columns(df: DataFrame, date_col: str) -> DataFrame:
    year_col, month_col = month_columns(date_col)
    return df.withColumns({year_col: F.year(date_col), month_col: F.month(date_col)})


def write_by_month(df: DataFrame, date_col: str, path: str, run_ts: str | None = None,
                   mode: str = "overwrite", sort_by: list[str] | None = None) -> None:
    """Table partitioned by ``year_<date_col>`` / ``month_<date_col>``.

    A ``rebalance`` on the partition columns groups each month's rows into few
    files while letting adaptive execution split a month that holds a large
    share of the data across several tasks, so a hot month does not become one
    straggler. NULL dates land in Hive's default partition.
    """
    year_col, month_col = month_columns(date_col)
    out = stamp(with_month_columns(df, date_col), run_ts).hint("rebalance", year_col, month_col)
    if sort_by:
        # led by the partition columns, as the writer wants them; it would sort anew otherwise
        out = out.sortWithinPartitions(year_col, month_col, *sort_by)
    (out.write.mode(mode)
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(year_col, month_col)
        .parquet(path))


def merge_partitions(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str],
                     partition_by: Sequence[str], remove_keys: bool = False) -> int:
    """Upsert ``new`` into a partitioned table and rewrite only the partitions concerned.

    Old rows whose ``keys`` occur in ``new`` give way, in whichever partition
    they lie; with ``remove_keys`` they go and nothing takes their place. ``new``
    must hold a key once. Concerned are the partitions of the new rows and of
    the old rows that give way; the driver gets their values, one row per
    partition. Merged partitions are written aside and swapped in one by one,
    all others keep their files. Returns the number of partitions rewritten.
    """
    recover(spark, path)
    columns = list(partition_by)
    if not path_exists(spark, path):
        if remove_keys:
            return 0
        with publishing(spark) as stage:
            write_partitioned(new, columns, stage(path))
        return -1
    old = spark.read.parquet(path)
    own = new.select(*keys).distinct()
    touched = old.join(own, list(keys), "left_semi").select(*columns)
    if not remove_keys:
        touched = touched.unionByName(new.select(*[F.col(c).cast(old.schema[c].dataType) for c in columns]))
    parts = touched.distinct().collect()
    if not parts:
        return 0
    merged = old.filter(_among(old, columns, [tuple(r) for r in parts])).join(own, list(keys), "left_anti")
    if not remove_keys:
        merged = merged.unionByName(new, allowMissingColumns=True)
    replace_partitions(spark, path, merged, columns, [tuple(r) for r in parts])
    return len(parts)


def _among(df: DataFrame, columns: Sequence[str], values: Sequence[tuple]) -> Column:
    """Whether a row lies in one of the partitions; literals, so that others are not read."""
    same = [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(columns, vs, strict=True)])
            for vs in values]
    return reduce(lambda a, b: a | b, same, F.lit(False))


def replace_partitions(spark: SparkSession, path: str, rows: DataFrame, columns: Sequence[str],
                       values: Sequence[tuple]) -> None:
    """``rows`` take the place of the partitions of these ``values``; those without a row go.

    ``rows`` may be read from the table itself: they are written aside first.
    All other partitions keep their files.
    """
    with publishing(spark) as stage:
        aside = stage(os.path.join(path, "merge"))  # a hidden folder inside the table
        write_partitioned(rows, columns, aside)

        def replace(vs: tuple) -> None:
            folder = os.path.join(*[f"{c}={NO_VALUE if v is None else v}" for c, v in zip(columns, vs, strict=True)])
            if path_exists(spark, os.path.join(aside, folder)):
                swap(spark, os.path.join(aside, folder), os.path.join(path, folder))
            else:
                remove(spark, os.path.join(path, folder))

        with ThreadPoolExecutor(SWAPS_AT_ONCE) as pool:
            list(pool.map(replace, values))
        remove(spark, aside)


def write_partitioned(df: DataFrame, columns: Sequence[str], path: str) -> None:
    """Few files per partition; adaptive execution splits a large one."""
    (df.hint("rebalance", *columns).write.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
     .partitionBy(*columns).parquet(path))


def merge_by_month(df: DataFrame, date_col: str, path: str, keys: Sequence[str],
                   run_ts: str | None = None) -> int:
    """``write_by_month`` of a drop into a kept table: only the months that it concerns change."""
    dated = stamp(with_month_columns(df, date_col), run_ts)
    return merge_partitions(df.sparkSession, path, dated, keys, month_columns(date_col))


def read_table(spark: SparkSession, path: str, drop_stamp: bool = False,
               schema: T.StructType | None = None) -> DataFrame:
    """Read a table; ``schema`` (from ``write_table``) skips inference."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    return df.drop(STAMP_COLUMN) if drop_stamp else df
