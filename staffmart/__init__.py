"""staffmart — a Spark-native medallion pipeline for HR, postal and customer data.

Raw delimited files are read with explicit string schemas, repaired and typed
with built-in column expressions, gated by quality rules counted in the write,
pseudonymised with keyed hashes and written as Parquet ("silver"). Five
analytics marts ("gold") are built from three silver tables.

Layout:
    sources/    readers (delimited, header-split text, parquet) and sinks
    functions/  Column -> Column helpers (dates, bands, text, casting, tokens)
    operators/  DataFrame -> DataFrame operators (shape, filters, repair,
                quality, privacy, marts)
    plans/      entity definitions, end-to-end jobs, driver-table queries
    streaming/  incremental (Structured Streaming) ingestion of raw drops
"""

__all__ = ["session"]
