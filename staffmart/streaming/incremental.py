"""Incremental ingestion of raw drops with Structured Streaming.

The batch jobs replace a silver table from all raw files on every run. When
raw files arrive over time, the same operators run per micro-batch instead:
a text stream (whole lines, no inference) feeds ``foreachBatch``, which checks
the headers of the new files, cuts their lines into cells, shapes, gates and
writes them. Each micro-batch writes
its own ``stream_id`` / ``batch_id`` partitions with dynamic partition
overwrite, so a batch that is replayed after a failure replaces its own output
instead of duplicating it; the checkpoint records which files were consumed.
A new checkpoint is a new stream, whose batch ids start again at 0; the stream
id, which the checkpoint holds, keeps it from replacing earlier batches.

``trigger="available_now"`` processes everything present and stops (the
scheduled-run replacement); ``trigger="<n> seconds"`` keeps polling.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from staffmart.operators import quality, repair
from staffmart.operators import shape as shape_ops
from staffmart.plans import entities as E
from staffmart.plans.jobs import (
    quarantine_customers,
    realign_customers,
    shape_positions,
    split_customers,
)
from staffmart.sources.delimited import (
    WIDE_LINE,
    data_lines,
    is_header,
    is_wide,
    overflow_names,
    parse_lines,
)
from staffmart.sources.header_split import split_lines, squashed_header
from staffmart.sources.headers import LINE, HeaderError, check_headers, with_origin
from staffmart.sources.sinks import stamp, with_month_columns

STREAM_COLUMN, BATCH_COLUMN = "stream_id", "batch_id"


def _lines_stream(spark: SparkSession, src_dir: str, max_files: int | None) -> DataFrame:
    """Whole lines with the file that they come from; a batch checks its headers before it cuts them."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_origin(reader.text(src_dir))


def _require_headers(batch: DataFrame, names: Sequence[str], same: Column) -> None:
    """Stop the stream at a batch with a file whose first line is not the expected header.

    The batch is not committed, so it runs again once the file is mended.
    """
    found = check_headers(batch, names, same)
    odd = [*found.foreign, *found.reordered]
    if odd:
        raise HeaderError(f"{odd[0]}: its first line is not the header {list(names)}")


def _cells(batch: DataFrame, sep: str, columns: Sequence[str], overflow: int) -> DataFrame:
    _require_headers(batch, columns, is_header(columns, sep))
    names = [*columns, *overflow_names(len(columns), overflow)]
    return parse_lines(data_lines(batch, sep, columns).select(LINE), sep, names, wide_lines=True)


def _append_batch(df: DataFrame, path: str, batch_id: int, partition_cols: list[str]) -> None:
    stream_id = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not stream_id:
        raise RuntimeError("not called from a streaming query")
    (df.withColumns({STREAM_COLUMN: F.lit(stream_id), BATCH_COLUMN: F.lit(batch_id)})
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(STREAM_COLUMN, BATCH_COLUMN, *partition_cols).parquet(path))


def postal_batch(out: str, quarantine: str):
    def run(batch: DataFrame, batch_id: int) -> None:
        _require_headers(batch, E.POSTAL_COLUMNS, squashed_header(E.POSTAL_COLUMNS, E.POSTAL_SEP))
        rows = stamp(shape_ops.rename(split_lines(batch, E.POSTAL_SEP, E.POSTAL_COLUMNS,
                                                  wide_lines=True), E.POSTAL_RENAME))
        _append_batch(rows.filter(~is_wide()).drop(WIDE_LINE), out, batch_id, [])
        _append_batch(rows.filter(is_wide()), quarantine, batch_id, [])
    return run


def customers_batch(out: str, quarantine: str):
    def run(batch: DataFrame, batch_id: int) -> None:
        # Two sinks read the batch: cache it once after the realignment.
        fixed = realign_customers(_cells(
            batch, E.CUSTOMERS_SEP, E.CUSTOMERS_COLUMNS, E.CUSTOMERS_OVERFLOW)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            typed, rejected = split_customers(fixed)
            passing, all_rejected, _ = quarantine_customers(typed, rejected)
            _append_batch(stamp(all_rejected), quarantine, batch_id, [])
            dated = with_month_columns(stamp(passing), "contract_start_date")
            _append_batch(dated, out, batch_id,
                          ["year_contract_start_date", "month_contract_start_date"])
        finally:
            fixed.unpersist()
    return run


def positions_batch(out: str, quarantine: str):
    def run(batch: DataFrame, batch_id: int) -> None:
        shaped = shape_positions(_cells(
            batch, E.POSITIONS_SEP, E.POSITIONS_COLUMNS, 1)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            ok = (F.col(repair.STATUS_COLUMN) != F.lit(repair.UNREPAIRED)) & ~is_wide()
            silver = (shape_ops.rename(shaped.filter(ok), E.POSITIONS_RENAME)
                      .drop(repair.STATUS_COLUMN, WIDE_LINE))
            _append_batch(stamp(silver), out, batch_id, [])
            _append_batch(stamp(shaped.filter(~ok).withColumn(
                quality.FAILED_COLUMN, F.when(is_wide(), F.lit("too many cells"))
                .otherwise(F.lit("unrepairable shift")))), quarantine, batch_id, [])
        finally:
            shaped.unpersist()
    return run


ENTITIES = {"customers": customers_batch, "positions": positions_batch, "postal": postal_batch}


def ingest(spark: SparkSession, entity: str, src_dir: str, out: str, quarantine: str,
           checkpoint: str, trigger: str = "available_now",
           max_files_per_trigger: int | None = None) -> StreamingQuery:
    make_batch = ENTITIES[entity]
    stream = _lines_stream(spark, src_dir, max_files_per_trigger)
    writer = (stream.writeStream.foreachBatch(make_batch(out, quarantine))
              .option("checkpointLocation", checkpoint))
    if trigger == "available_now":
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()
