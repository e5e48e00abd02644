"""One query per operator over the driver's tables, and SQL where it can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from staffmart.llm import (
    block_names,
    fill_middle,
    fingerprints,
    licenses,
    line_dedup,
    mix,
    near_dups,
    packing,
    pii,
    prefix_trie,
    quality,
    repeats,
    url_lists,
)
from staffmart.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def _documents(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: f(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_mix_sources": _documents(mix.op1_mix_sources),
    "op2_licence_scan": _documents(licenses.op2_licence_scan),
    "op3_quality_rules": lambda spark, sf_dir: quality.op3_quality_rules(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op4_personal_data": _documents(pii.op4_personal_data),
    "op5_line_dedup": _documents(line_dedup.op5_line_dedup),
    "op6_repeated_strings": _documents(repeats.op6_repeated_strings),
    "op7_pack_buckets": _documents(packing.op7_pack_buckets),
    "op8_near_duplicates": _documents(near_dups.op8_near_duplicates),
    "op9_fingerprints": _documents(fingerprints.op9_fingerprints),
    "op10_url_lists": lambda spark, sf_dir: url_lists.op10_url_lists(table(spark, sf_dir, "pages")),
    "op11_prefix_trie": lambda spark, sf_dir: prefix_trie.op11_prefix_trie(
        table(spark, sf_dir, "conversations")),
    "op12_exact_dedup": _documents(block_names.op12_exact_dedup),
    "op13_fill_middle": _documents(fill_middle.op13_fill_middle),
}

ORACLE_SQL: dict[str, str] = {
    "op1_mix_sources": mix.OP1_SQL,
    "op5_line_dedup": line_dedup.OP5_SQL,
    "op6_repeated_strings": repeats.OP6_SQL,
    "op8_near_duplicates": near_dups.OP8_SQL,
    "op10_url_lists": url_lists.OP10_SQL,
    "op11_prefix_trie": prefix_trie.OP11_SQL,
    "op12_exact_dedup": block_names.OP12_SQL,
    "op13_fill_middle": fill_middle.OP13_SQL,
}
