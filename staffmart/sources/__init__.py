from staffmart.sources.delimited import (
    WIDE_LINE,
    is_wide,
    overflow_names,
    read_delimited,
    string_schema,
)
from staffmart.sources.header_split import read_header_split
from staffmart.sources.headers import HeaderError
from staffmart.sources.publish import path_exists, publishing
from staffmart.sources.sinks import (
    merge_by_month,
    merge_partitions,
    read_table,
    run_timestamp,
    stamp,
    with_month_columns,
    write_by_month,
    write_table,
)
from staffmart.sources.stitch import read_stitched

__all__ = [
    "HeaderError", "WIDE_LINE", "is_wide",
    "overflow_names", "read_delimited", "string_schema", "read_header_split",
    "read_stitched", "merge_by_month", "merge_partitions", "path_exists", "publishing",
    "read_table", "run_timestamp", "stamp", "with_month_columns",
    "write_by_month", "write_table",
]
