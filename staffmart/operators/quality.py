"""Declarative data-quality rules.

A report alone (``quality_report``) takes one pass for all row rules and one
for all uniqueness rules. A gate (``label_rows``, ``split_observed``) takes no
pass for the report: it is counted while both halves are written.

Row rules (not null, between, matches, in set) are all counted by a single
``agg`` over the table; the uniqueness rules together add one scan, grouped by
(rule, key) (partial aggregation before the shuffle, so a hot key costs one row
per map task). The report has one row per rule:
``rule, column_name, evaluated, unexpected, success``. Only that report (a
handful of rows) ever reaches the driver.

Semantics follow the usual expectation conventions: every rule except
``not_null`` ignores NULL cells; ``unique`` counts every row whose value occurs
more than once.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staffmart.session import scratch_path

REPORT_COLUMNS = ["rule", "column_name", "evaluated", "unexpected", "success"]
FAILED_COLUMN = "_failed_rules"
# Per row: column name -> raw text of the filled cells that their type could not hold.
UNCAST_COLUMN = "_uncast"


@dataclass(frozen=True)
class Rule:
    rule: str
    column: str
    args: tuple[Any, ...] = field(default=())

    @property
    def label(self) -> str:
        return f"{self.rule}({self.column})"

    @property
    def is_row_rule(self) -> bool:
        return self.rule != "unique"

    def evaluated(self) -> Column:
        c = F.col(self.column)
        return F.lit(True) if self.rule in ("not_null", "is_null", "castable") else c.isNotNull()

    def fails(self) -> Column:
        """True when a row breaks the rule (never NULL)."""
        c = F.col(self.column)
        if self.rule == "not_null":
            return c.isNull()
        if self.rule == "is_null":
            return c.isNotNull()
        if self.rule == "castable":
            return F.map_contains_key(UNCAST_COLUMN, self.column)
        if self.rule == "between":
            low, high = self.args
            ok = F.lit(True)
            if low is not None:
                ok = ok & (c >= F.lit(low))
            if high is not None:
                ok = ok & (c <= F.lit(high))
            return c.isNotNull() & ~ok
        if self.rule == "matches":
            return c.isNotNull() & ~c.cast("string").rlike(self.args[0])
        if self.rule == "in_set":
            return c.isNotNull() & ~c.isin(list(self.args[0]))
        raise ValueError(f"{self.rule} is not a row rule")


def not_null(column: str) -> Rule:
    return Rule("not_null", column)


def is_null(column: str) -> Rule:
    """The cell is empty, as that of a column that notes a defect should be."""
    return Rule("is_null", column)


def castable(column: str) -> Rule:
    """Every filled cell has a value of its type; see ``cast_noting_losses``."""
    return Rule("castable", column)


def cast_noting_losses(df: DataFrame, casts: Mapping[str, Column],
                       later: Sequence[str] = ()) -> DataFrame:
    """Replace each column by its cast, and keep the raw cells that it lost.
    Columns named ``later`` are noted but stay raw, for rules on their text.

    A cast that fails gives NULL, which every rule but ``not_null`` skips.
    ``UNCAST_COLUMN`` therefore maps, per row, the columns whose raw cell was
    filled and whose cast is NULL to that cell (blanks only count as empty).
    """
    # Casts are columns before they are looked at, so that each is worked out once.
    held = {c: f"__cast_{c}" for c in casts}
    raw = {c: F.col(c).cast("string") for c in casts}
    is_lost = {c: (F.trim(raw[c]) != "") & F.col(held[c]).isNull() for c in casts}
    lost = [F.when(is_lost[c], F.struct(F.lit(c), raw[c])) for c in casts]
    uncast = F.map_from_entries(F.array_compact(F.array(*lost)))
    nothing = F.create_map().cast("map<string,string>")
    any_lost = reduce(lambda a, b: a | b, is_lost.values(), F.lit(False))
    return (df.withColumns({held[c]: cast for c, cast in casts.items()})
            .withColumn(UNCAST_COLUMN, F.when(any_lost, uncast).otherwise(nothing))
            .withColumns({c: F.col(held[c]) for c in casts if c not in later})
            .drop(*held.values()))


def unique(column: str) -> Rule:
    return Rule("unique", column)


def between(column: str, low=None, high=None) -> Rule:
    return Rule("between", column, (low, high))


def matches(column: str, pattern: str) -> Rule:
    return Rule("matches", column, (pattern,))


def in_set(column: str, values: Iterable[Any]) -> Rule:
    return Rule("in_set", column, (tuple(values),))


def _report_row(rule: Rule, evaluated: Column, unexpected: Column) -> Column:
    return F.struct(F.lit(rule.rule).alias("rule"), F.lit(rule.column).alias("column_name"),
                    evaluated.cast("bigint").alias("evaluated"),
                    unexpected.cast("bigint").alias("unexpected"))


def _per_key(df: DataFrame, unique_rules: Sequence[Rule]) -> DataFrame:
    """(i, k0, k1, ..., n): how often each key of each uniqueness rule i occurs.

    One scan for all rules: a row per rule and cell, each rule's keys in a
    column of their own, so that they keep their type.
    """
    names = [f"k{i}" for i in range(len(unique_rules))]
    cells = [F.struct(F.lit(i).alias("i"), *[
        (F.col(r.column) if j == i else F.lit(None).cast(df.schema[r.column].dataType)).alias(names[j])
        for j, r in enumerate(unique_rules)]) for i in range(len(unique_rules))]
    return (df.select(F.inline(F.array(*cells)))
            .where(F.greatest(F.lit(False), *[F.col(k).isNotNull() for k in names]))
            .groupBy("i", *names).agg(F.count(F.lit(1)).alias("n")))


def quality_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    parts: list[DataFrame] = []
    row_rules = [r for r in rules if r.is_row_rule]
    if row_rules:
        aggs = []
        for i, r in enumerate(row_rules):
            aggs.append(F.count_if(r.evaluated()).alias(f"e{i}"))
            aggs.append(F.count_if(r.fails()).alias(f"u{i}"))
        counts = df.agg(*aggs)
        rows = F.array(*[_report_row(r, F.col(f"e{i}"), F.col(f"u{i}"))
                         for i, r in enumerate(row_rules)])
        parts.append(counts.select(F.inline(rows)))
    unique_rules = [r for r in rules if not r.is_row_rule]
    if unique_rules:
        per_key = _per_key(df, unique_rules)
        aggs = []
        for i in range(len(unique_rules)):
            own = F.col("i") == F.lit(i)
            aggs.append(F.coalesce(F.sum(F.when(own, F.col("n"))), F.lit(0)).alias(f"e{i}"))
            aggs.append(F.coalesce(F.sum(F.when(own & (F.col("n") > 1), F.col("n"))), F.lit(0))
                        .alias(f"u{i}"))
        rows = F.array(*[_report_row(r, F.col(f"e{i}"), F.col(f"u{i}"))
                         for i, r in enumerate(unique_rules)])
        parts.append(per_key.agg(*aggs).select(F.inline(rows)))
    report = parts[0]
    for p in parts[1:]:
        report = report.unionByName(p)
    return report.withColumn("success", F.col("unexpected") == F.lit(0))


class QualityError(Exception):
    pass


def collect_report(report: DataFrame) -> list[dict]:
    """The report is one row per rule, so collecting it is bounded."""
    return [r.asDict() for r in report.collect()]


def assert_quality(rows: list[dict]) -> list[dict]:
    """Raise listing every failed rule of a collected report."""
    failed = [r for r in rows if not r["success"]]
    if failed:
        raise QualityError("data validation failed for: " + "; ".join(
            f"{r['rule']}({r['column_name']}): {r['unexpected']} of {r['evaluated']}" for r in failed))
    return rows


def _flag(i: int) -> str:
    return f"__fail{i}"


# A bitmap has 16 bits per duplicate key, in pieces of 4 KB that aggregates fill;
# 32 MB at most go to every task. Where it is full, more rows take the join.
PIECE_BITS, MOST_BITS, BITS_PER_KEY = 1 << 15, 1 << 28, 16


def _bit_of(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def _bit_is_set(piece: Column, bit: Column) -> Column:
    at = bit % PIECE_BITS
    byte = F.conv(F.hex(F.substring(piece, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))


def _mark_duplicates(df: DataFrame, unique_rules: Sequence[Rule], flags: Sequence[str]) -> DataFrame:
    """Add a flag per uniqueness rule: the row's key occurs more than once.

    One narrow pass writes the duplicate keys of all rules. Bitmaps of their
    hashes, of bounded size, are sent to all tasks: a row whose bits are unset
    has no duplicate and is not moved. Only the other rows, the duplicates and
    a few more, are joined to the keys; adaptive execution splits a hot one.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "duplicate-keys")
    _per_key(df, unique_rules).where("n > 1").drop("n").write.parquet(path)
    keys = spark.read.parquet(path)
    found = {r["i"]: r["n"] for r in keys.groupBy("i").agg(F.count(F.lit(1)).alias("n")).collect()}
    none = F.lit(False)
    out, suspects = df, none
    for i, r in enumerate(unique_rules):
        if i not in found:
            continue
        bits = min(MOST_BITS, max(PIECE_BITS, 1 << (BITS_PER_KEY * found[i] - 1).bit_length()))
        bit = _bit_of(F.col(f"k{i}"), bits)
        pieces = (keys.where(F.col("i") == i).select(bit.alias("bit"))
                  .groupBy(F.floor(F.col("bit") / PIECE_BITS).alias(f"__at{i}"))
                  .agg(F.bitmap_construct_agg(F.col("bit") % PIECE_BITS).alias(f"__piece{i}")))
        own = _bit_of(F.col(r.column), bits)
        out = out.join(F.broadcast(pieces), F.floor(own / PIECE_BITS) == F.col(f"__at{i}"), "left")
        suspect = F.col(r.column).isNotNull() & _bit_is_set(F.col(f"__piece{i}"), own)
        out = out.withColumn(f"__suspect{i}", suspect).drop(f"__at{i}", f"__piece{i}")
        suspects = suspects | F.col(f"__suspect{i}")
    helpers = [f"__suspect{i}" for i in found]
    if not found:
        return out.withColumns({f: none for f in flags})
    alone = out.where(~suspects).drop(*helpers).withColumns({f: none for f in flags})
    met = out.where(suspects)
    for i, (r, flag) in enumerate(zip(unique_rules, flags, strict=True)):
        if i not in found:
            met = met.withColumn(flag, none)
            continue
        twice = keys.where(F.col("i") == i).select(F.col(f"k{i}").alias(r.column), F.lit(True).alias(flag))
        met = met.join(twice, r.column, "left").withColumn(flag, F.coalesce(F.col(flag), none))
    return alone.unionByName(met.drop(*helpers))


def label_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``df`` plus one failure flag per rule and ``_failed_rules``.

    Row rules are plain projections. Uniqueness rules run one narrow job (see
    ``_mark_duplicates``) when this is called, so ``df`` should be cached if it
    is dear. Labels list row rules first, then uniqueness rules.
    """
    out = df.withColumns({_flag(i): r.fails() for i, r in enumerate(rules) if r.is_row_rule})
    unique_at = [i for i, r in enumerate(rules) if not r.is_row_rule]
    if unique_at:
        out = _mark_duplicates(out, [rules[i] for i in unique_at], [_flag(i) for i in unique_at])
    order = [i for i, r in enumerate(rules) if r.is_row_rule] + unique_at
    return out.withColumn(FAILED_COLUMN, F.concat_ws(
        ",", *[F.when(F.col(_flag(i)), F.lit(rules[i].label)) for i in order]))


def report_from_labels(labelled: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The quality report from ``label_rows`` output, in one aggregate."""
    aggs = []
    for i, r in enumerate(rules):
        aggs.append(F.count_if(r.evaluated()).alias(f"e{i}"))
        aggs.append(F.count_if(F.col(_flag(i))).alias(f"u{i}"))
    rows = F.array(*[_report_row(r, F.col(f"e{i}"), F.col(f"u{i}")) for i, r in enumerate(rules)])
    return (labelled.agg(*aggs).select(F.inline(rows))
            .withColumn("success", F.col("unexpected") == F.lit(0)))


def split_labelled(labelled: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(passing rows, failing rows + ``_failed_rules``) from ``label_rows``."""
    flags = [_flag(i) for i in range(len(rules))]
    bad = F.col(FAILED_COLUMN) != F.lit("")
    return (labelled.filter(~bad).drop(FAILED_COLUMN, *flags),
            labelled.filter(bad).drop(*flags))


@dataclass(frozen=True)
class Seen:
    """What both halves of a gate counted while they were written."""

    rules: Sequence[Rule]
    passing: Observation
    failing: Observation

    def report(self) -> list[dict]:
        """The rows of ``quality_report``; waits until both halves are written."""
        halves = [self.passing.get, self.failing.get]
        rows = []
        for i, r in enumerate(self.rules):
            evaluated, unexpected = (sum(h[f"{k}{i}"] or 0 for h in halves) for k in "eu")
            rows.append({"rule": r.rule, "column_name": r.column, "evaluated": evaluated,
                         "unexpected": unexpected, "success": unexpected == 0})
        return rows

    def quarantined(self) -> int:
        return self.failing.get["rows"]


def split_observed(labelled: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame, Seen]:
    """``split_labelled`` whose halves count the report's figures as they are written.

    No pass of its own and no read-back: the report is there once an action
    has run over each half.
    """
    flags = [_flag(i) for i in range(len(rules))]
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, r in enumerate(rules):
        aggs += [F.count_if(r.evaluated()).alias(f"e{i}"), F.count_if(F.col(flags[i])).alias(f"u{i}")]
    seen = Seen(rules, Observation(), Observation())
    bad = F.col(FAILED_COLUMN) != F.lit("")
    return (labelled.filter(~bad).observe(seen.passing, *aggs).drop(FAILED_COLUMN, *flags),
            labelled.filter(bad).observe(seen.failing, *aggs).drop(*flags), seen)


def split_quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(passing rows, failing rows + ``_failed_rules``)."""
    return split_labelled(label_rows(df, rules), rules)


def assert_column_types(df: DataFrame, expected: dict[str, T.DataType]) -> None:
    """Schema assertion on the driver (no job): each column has its type."""
    for name, dtype in expected.items():
        actual = df.schema[name].dataType
        if actual != dtype:
            raise ValueError(f"{name} is {actual.simpleString()}, expected {dtype.simpleString()}")
