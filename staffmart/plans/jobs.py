"""End-to-end jobs: six raw -> silver jobs and the silver -> gold job.

Each job is a plain function (also runnable with ``spark-submit``, see
``staffmart.plans.cli``) taking paths, the reference date ``as_of`` and, for
personal data, the token key. Silver jobs are independent of each other;
the gold job needs postal, employees and positions.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staffmart.functions.bands import generation
from staffmart.functions.casting import exact_decimal, is_digits, try_int
from staffmart.functions.temporal import (
    age_in_full_years,
    excel_serial_to_date,
    parse_day_first,
    tenure_days,
)
from staffmart.functions.text import correct, is_code, strip_leading, title_case
from staffmart.functions.tokens import TokenKey
from staffmart.operators import filters, marts, partials, privacy, quality, repair, shape
from staffmart.plans import entities as E
from staffmart.session import scratch_path
from staffmart.sources import (
    WIDE_LINE,
    is_wide,
    merge_partitions,
    path_exists,
    publishing,
    read_delimited,
    read_header_split,
    read_stitched,
    read_table,
    run_timestamp,
    write_by_month,
    write_table,
)
from staffmart.sources.publish import Stage
from staffmart.sources.sinks import month_columns, replace_partitions, write_partitioned


@dataclass
class JobResult:
    silver: DataFrame
    report: list[dict] | None = None
    quarantined: int = 0


def _write_quarantine(df: DataFrame, path: str | None, out: str, run_ts: str, stage: Stage) -> Observation:
    """Write rejected rows, beside the silver table unless told where; counts them on the way.

    Rejected rows are never thrown away: without a path they go to
    ``<out>_quarantine``. They appear even if the job's gate stops it.
    """
    seen = Observation()
    path = path or f"{out.rstrip('/')}_quarantine"
    write_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), stage(path, always=True), run_ts)
    return seen


def _together(*writes: Callable[[], object]) -> list:
    """Run independent writes of one cached frame side by side; raises the first error once all have ended."""
    with ThreadPoolExecutor(len(writes)) as pool:
        return [f.result() for f in [pool.submit(w) for w in writes]]


# ----------------------------------------------------------------- positions

POSITION_VALIDATORS = {
    "Cargo": lambda c: is_code(F.trim(c)),
    "Nível": lambda c: c.isin(E.LEVELS),
    "Área": lambda c: ~c.isin(E.LEVELS) & ~is_code(F.trim(c)),
    "COD Área": lambda c: F.trim(c).rlike(r"^[A-Z]{2,4}$"),
    "COD Nível": lambda c: F.trim(c).rlike(r"^[A-Z]{2,4}$"),
    "Quadro": lambda c: ~is_code(F.trim(c)) & ~c.isin("S", "N"),
    "Bonus": lambda c: c.isin("S", "N"),
    "Contratacao": lambda c: ~c.isin("S", "N"),
}


def shape_positions(raw: DataFrame) -> DataFrame:
    """Realign shifted rows, then clean the area: leading '@'s, known typos."""
    fixed = repair.realign(raw, E.POSITIONS_COLUMNS, ["_c8"], POSITION_VALIDATORS)
    return fixed.withColumn("Área", correct(strip_leading("Área"), E.AREA_CORRECTIONS))


def silver_positions(spark: SparkSession, src: str, out: str, run_ts: str | None = None,
                     quarantine: str | None = None) -> JobResult:
    run_ts = run_ts or run_timestamp()
    raw = read_delimited(spark, src, E.POSITIONS_SEP, E.POSITIONS_COLUMNS, overflow=1,
                         wide_lines=True)
    # Silver and quarantine both read the realigned rows: parse the file once.
    shaped = shape_positions(raw).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        ok = (F.col(repair.STATUS_COLUMN) != F.lit(repair.UNREPAIRED)) & ~is_wide()
        silver = shape.rename(shaped.filter(ok), E.POSITIONS_RENAME).drop(repair.STATUS_COLUMN,
                                                                          WIDE_LINE)
        with publishing(spark) as stage:
            bad, _ = _together(
                lambda: _write_quarantine(shaped.filter(~ok), quarantine, out, run_ts, stage),
                lambda: write_table(silver, stage(out), run_ts))
    finally:
        shaped.unpersist()
    return JobResult(read_table(spark, out), quarantined=bad.get["rows"])


# -------------------------------------------------------------------- postal

def silver_postal(spark: SparkSession, src: str, out: str, run_ts: str | None = None,
                  quarantine: str | None = None, header_in_each_file: bool = True) -> JobResult:
    run_ts = run_ts or run_timestamp()
    raw = read_header_split(spark, src, E.POSTAL_SEP, E.POSTAL_COLUMNS, wide_lines=True,
                            header_in_each_file=header_in_each_file)
    rows = shape.rename(raw, E.POSTAL_RENAME).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with publishing(spark) as stage:
            bad = _write_quarantine(rows.filter(is_wide()), quarantine, out, run_ts, stage)
            write_table(rows.filter(~is_wide()).drop(WIDE_LINE), stage(out), run_ts)
    finally:
        rows.unpersist()
    return JobResult(read_table(spark, out), quarantined=bad.get["rows"])


# ----------------------------------------------------------------- customers

CUSTOMER_VALIDATORS = {
    "Cliente": lambda c: ~is_code(c),
    "Valor Contrato Anual": lambda c: c.rlike(r"^\d+([.,]\d+)?$"),
    "Quantidade de Serviços": lambda c: c.rlike(r"^\d+$"),
    "Cargo Responsável": lambda c: is_code(c),
    "CEP": lambda c: is_digits(c, 5),
    "Data Início Contrato": lambda c: c.rlike(r"^\d{2}/\d{2}/\d{4}$"),
    "Nivel de Importancia": lambda c: c.rlike(r"^\d+$"),
}

# The checks of the gate (the castable ones are ours).
CUSTOMER_RULES = [
    *[quality.castable(c) for c in ("annual_contract_value", "number_of_services", "cep",
                                    "contract_start_date", "importance_level")],
    quality.not_null("customer"),
    quality.not_null("annual_contract_value"),
    quality.not_null("number_of_services"),
    quality.not_null("responsible_position"),
    quality.not_null("contract_start_date"),
    quality.not_null("importance_level"),
    quality.in_set("importance_level", E.IMPORTANCE_LEVELS),
]
RAW_COLUMN = "_raw"


def type_customers(df: DataFrame) -> DataFrame:
    """Silver columns, the raw cells, and what a cast lost of them."""
    raw = df.select(F.struct(*E.CUSTOMERS_COLUMNS).alias(RAW_COLUMN), *[
        F.col(src).alias(dst) for src, dst in E.CUSTOMERS_RENAME.items()])
    value = F.replace(F.col("annual_contract_value"), F.lit(","), F.lit("."))
    typed = quality.cast_noting_losses(raw, {
        "annual_contract_value": exact_decimal(value),
        "number_of_services": try_int("number_of_services"),
        "cep": F.when(is_digits("cep", 5), F.col("cep")),
        "contract_start_date": parse_day_first("contract_start_date"),
        "importance_level": try_int("importance_level"),
    })
    return typed.withColumn("customer", title_case("customer"))


def realign_customers(raw: DataFrame) -> DataFrame:
    return repair.realign(raw, E.CUSTOMERS_COLUMNS,
                          [f"_c{i}" for i in range(7, 7 + E.CUSTOMERS_OVERFLOW)],
                          CUSTOMER_VALIDATORS)


def is_customer_tail() -> Column:
    """The second half of a broken line: it begins with the position's code."""
    return F.col("Cliente").isNotNull() & filters.is_fragment("Cliente")


def is_customer_head() -> Column:
    """The first half: a customer whose cells end before the position."""
    rest = E.CUSTOMERS_COLUMNS[E.CUSTOMERS_COLUMNS.index("Cargo Responsável"):]
    return ~filters.is_fragment("Cliente") & F.coalesce(*rest).isNull()


def split_customers(fixed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(typed customer rows, rejected raw rows as JSON with a reason).

    Drops what is not a customer row: the tail half of a broken line (first
    cell empty or a position code), its head half (no responsible position),
    rows that could not be realigned, and rows with cells past the last column
    (their JSON also holds the whole line).
    """
    usable = (~filters.is_fragment("Cliente") & F.col("Cargo Responsável").isNotNull()
              & (F.col(repair.STATUS_COLUMN) != F.lit(repair.UNREPAIRED)) & ~is_wide())
    reason = F.when(is_wide(), F.lit("too many cells")).otherwise(F.lit("not a customer row"))
    rejected = (fixed.filter(~usable)
                .select(F.to_json(F.struct(*E.CUSTOMERS_COLUMNS, WIDE_LINE)).alias("row"),
                        reason.alias(quality.FAILED_COLUMN)))
    return type_customers(fixed.filter(usable)), rejected


def quarantine_customers(typed: DataFrame, rejected: DataFrame) -> tuple[DataFrame, DataFrame, quality.Seen]:
    """(rows passing every customer rule, all rejected raw rows as JSON + reason, their counts)."""
    labelled = quality.label_rows(typed, CUSTOMER_RULES)
    passing, failing, seen = quality.split_observed(labelled, CUSTOMER_RULES)
    failing = failing.select(F.to_json(RAW_COLUMN).alias("row"), quality.FAILED_COLUMN)
    return passing.drop(RAW_COLUMN, quality.UNCAST_COLUMN), rejected.unionByName(failing), seen


def silver_customers(spark: SparkSession, src: str, out: str, run_ts: str | None = None,
                     quarantine: str | None = None, strict: bool = True, stitch: bool = False) -> JobResult:
    """Realign, drop the halves of broken lines, type, gate, write by month.

    Rows that are not customers and rows failing a row rule go to
    ``quarantine``, with their raw cells. With ``strict`` the job raises when
    any rule failed, like a stop-the-line gate: the quarantine appears and the
    old silver table stays; otherwise the passing rows are published.
    ``stitch`` puts lines that were broken in two together again.
    """
    run_ts = run_ts or run_timestamp()
    if stitch:
        raw = read_stitched(spark, src, E.CUSTOMERS_SEP, E.CUSTOMERS_COLUMNS, is_customer_head(),
                            is_customer_tail(), E.CUSTOMERS_OVERFLOW)
    else:
        raw = read_delimited(spark, src, E.CUSTOMERS_SEP, E.CUSTOMERS_COLUMNS,
                             overflow=E.CUSTOMERS_OVERFLOW, wide_lines=True)
    # One cache after the realignment feeds the quarantine and the write: the
    # raw file is parsed and realigned once.
    fixed = realign_customers(raw).persist(StorageLevel.MEMORY_AND_DISK)
    passing, rejected, seen = quarantine_customers(*split_customers(fixed))
    try:
        with publishing(spark) as stage:
            bad, _ = _together(
                lambda: _write_quarantine(rejected, quarantine, out, run_ts, stage),
                lambda: write_by_month(passing, "contract_start_date", stage(out), run_ts))
            rows = seen.report()
            if strict:
                quality.assert_quality(rows)
    finally:
        fixed.unpersist()
    return JobResult(read_table(spark, out), rows, bad.get["rows"])


# ---------------------------------------------------------- employees and PQ

DATE_TYPES = {c: T.DateType() for c in ("birth_date", "hire_date", "termination_date")}


def employee_rules(as_of: date | str) -> list[quality.Rule]:
    # fixed values: the checks of the gate (is_null and castable are ours)
    return [
        quality.is_null(WIDE_LINE),
        *[quality.castable(c) for c in (*DATE_TYPES, *E.EMPLOYEE_DECIMALS)],
        quality.not_null("id_card_number_rg"),
        quality.not_null("cpf"),
        quality.unique("cpf"),
        quality.unique("hr_id"),
        quality.between("birth_date", date.fromisoformat(E.EARLIEST_BIRTH),
                        date.fromisoformat(str(as_of))),
        quality.between("base_salary", 0, None),
        quality.matches("taxes", E.TAXES_PATTERN),
    ]


def shape_employees(raw: DataFrame, as_of: date | str) -> DataFrame:
    """Drop filler columns, convert serial dates, add tenure and age, rename.

    ``taxes`` stays text here so that its format rule sees the raw value.
    Filled cells of other unnamed columns count as cells past the header's.
    """
    df = raw.drop(*E.EMPLOYEES_FILLERS)
    unnamed = [c for c in df.columns if c not in shape.drop_filler_columns(df).columns]
    if unnamed:
        filled = F.coalesce(*unnamed).isNotNull()
        df = df.withColumn(WIDE_LINE, F.coalesce(
            WIDE_LINE, F.when(filled, F.to_json(F.struct(*unnamed))))).drop(*unnamed)
    df = shape.rename(df, E.EMPLOYEES_RENAME)
    casts = {c: excel_serial_to_date(c) for c in DATE_TYPES}
    casts |= {c: exact_decimal(c) for c in E.EMPLOYEE_DECIMALS}
    df = quality.cast_noting_losses(df, casts, later=["taxes"])
    df = df.withColumns({
        "time_on_job": tenure_days("hire_date", "termination_date", as_of),
        "person_age": age_in_full_years("birth_date", as_of),
    })
    quality.assert_column_types(df, DATE_TYPES)
    return df


def _write_people(passing: DataFrame, failing: DataFrame, key: TokenKey | str, path: str | None, out: str,
                  vault_out: str, run_ts: str, stage: Stage, silver: str, vault_path: str) -> Observation:
    """The four outputs of a gate on people, side by side.

    Public rows with tokens by hire month, and their clear values in the
    vault; rejected people without clear identifiers in the quarantine, and
    their clear values, with whole lines that had too many cells, in
    ``<vault>_rejected``.
    """
    good = privacy.pseudonymize(passing, E.TOKENS, key)
    vault, public = privacy.split_vault(good, E.VAULT_COLUMNS, E.CLEAR_COLUMNS)
    bad = privacy.pseudonymize(failing, E.TOKENS, key)
    rejected_vault = stage(f"{vault_out.rstrip('/')}_rejected", always=True)
    seen, *_ = _together(
        lambda: _write_quarantine(bad.drop(*E.CLEAR_COLUMNS, WIDE_LINE), path, out, run_ts, stage),
        lambda: write_table(bad.select(*E.VAULT_COLUMNS, WIDE_LINE), rejected_vault, run_ts),
        lambda: write_table(vault, vault_path, run_ts),
        lambda: write_by_month(public, "hire_date", silver, run_ts))
    return seen


def silver_employees(spark: SparkSession, src: str, out: str, vault_out: str,
                     as_of: date | str, key: TokenKey | str, run_ts: str | None = None,
                     quarantine: str | None = None, strict: bool = True, merge: bool = False) -> JobResult:
    """Shape, gate, replace identifiers by tokens, write by hire month.

    With ``strict`` a failed rule stops the job: the quarantine and the
    rejected people's vault appear, the old silver table and vault stay.
    ``merge`` takes the file for a drop: people of the silver table and of the
    vault that it doesn't name stay, and only the months that it concerns are
    written anew. ``time_on_job`` and ``person_age`` then are as of each
    person's last drop.
    """
    run_ts = run_ts or run_timestamp()
    raw = read_delimited(spark, src, E.EMPLOYEES_SEP, wide_lines=True)
    # The one cache: labels are added to it without moving rows, and all writes read it.
    staged = shape_employees(raw, as_of).persist(StorageLevel.MEMORY_AND_DISK)
    rules = employee_rules(as_of)
    try:
        passing, failing, seen = quality.split_observed(quality.label_rows(staged, rules), rules)
        with publishing(spark) as stage:
            # the gate let no text pass that the type can't hold
            typed = passing.drop(quality.UNCAST_COLUMN, WIDE_LINE).withColumn("taxes", exact_decimal("taxes"))
            # a drop is written aside as well, for its gate and its merge to read
            to, vault_to = ((scratch_path(spark, n) for n in ("drop", "drop-vault")) if merge else (out, vault_out))
            bad = _write_people(typed, failing, key, quarantine, out, vault_out, run_ts, stage,
                                stage(to), stage(vault_to))
            rows = seen.report()
            if strict:
                quality.assert_quality(rows)
        if merge:
            # the gate found every hr_id and cpf once
            merge_partitions(spark, out, spark.read.parquet(to), ["hr_id"], month_columns("hire_date"))
            privacy.merge_vault(read_table(spark, vault_to, drop_stamp=True), vault_out, E.TOKENS["cpf"], run_ts)
    finally:
        staged.unpersist()
    return JobResult(read_table(spark, out), rows, bad.get["rows"])


def silver_pq(spark: SparkSession, src: str, out: str, vault_out: str, key: TokenKey | str,
              run_ts: str | None = None, quarantine: str | None = None) -> JobResult:
    """Select, rename, convert the dates, split the vault, write by month.

    Rows with a filled cell that is no date, or with too many cells, go to
    the quarantine, without clear identifiers.
    """
    run_ts = run_ts or run_timestamp()
    raw = read_delimited(spark, src, E.PQ_SEP, wide_lines=True)
    df = shape.rename(shape.select_renamed(raw, [*E.PQ_COLUMNS, WIDE_LINE]), E.PQ_RENAME)
    df = quality.cast_noting_losses(df, {c: excel_serial_to_date(c) for c in DATE_TYPES})
    quality.assert_column_types(df, DATE_TYPES)
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rules = [quality.is_null(WIDE_LINE), *[quality.castable(c) for c in DATE_TYPES]]
        passing, failing = quality.split_quarantine(df, rules)
        with publishing(spark) as stage:
            bad = _write_people(passing.drop(quality.UNCAST_COLUMN, WIDE_LINE), failing, key, quarantine, out,
                                vault_out, run_ts, stage, stage(out), stage(vault_out))
    finally:
        df.unpersist()
    return JobResult(read_table(spark, out), quarantined=bad.get["rows"])


# -------------------------------------------------------------------- levels

def silver_levels(spark: SparkSession, src: str, out: str, run_ts: str | None = None,
                  quarantine: str | None = None) -> JobResult:
    run_ts = run_ts or run_timestamp()
    raw = read_delimited(spark, src, E.LEVELS_SEP, wide_lines=True)
    rows = shape.select_renamed(raw, [*E.LEVELS_RENAME, WIDE_LINE], E.LEVELS_RENAME)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        valid = filters.keep_in_set(rows.filter(~is_wide()), "level_description", E.LEVELS)
        listed = F.coalesce(F.col("level_description").isin(E.LEVELS), F.lit(False))
        rejected = rows.filter(is_wide() | ~listed).withColumn(
            quality.FAILED_COLUMN, F.when(is_wide(), F.lit("too many cells")).otherwise(
                F.lit("in_set(level_description)")))
        with publishing(spark) as stage:
            bad = _write_quarantine(rejected, quarantine, out, run_ts, stage)
            write_table(valid.drop(WIDE_LINE), stage(out), run_ts)
    finally:
        rows.unpersist()
    return JobResult(read_table(spark, out), quarantined=bad.get["rows"])


# ---------------------------------------------------------------------- gold

# mart name -> (measure, group columns); "headcount" counts distinct ids,
# "mean_years" averages the day count in years.
MART_SPECS = {
    "region": ("headcount", ["region"]),
    "average_time_on_job": ("mean_years", ["level_description"]),
    "generation_average_time_on_job": ("mean_years", ["generation", "level_description"]),
    "area_generation_average_time_on_job": ("mean_years", ["generation", "area"]),
    "generation_region": ("headcount", ["region", "generation"]),
}


DAYS, SPELLS = "days", "spells"


def build_mart(people: DataFrame, spells: DataFrame, name: str,
               id_column: str = "cpf_encrypted", approx_rsd: float | None = None) -> DataFrame:
    """One mart, from people (ids) or from sums of days over spells;
    ``approx_rsd`` switches headcounts to mergeable sketches."""
    measure, by = MART_SPECS[name]
    if measure == "headcount":
        return marts.ranked(marts.headcount(people, by, id_column, approx_rsd=approx_rsd),
                            marts.HEADCOUNT)
    return marts.ranked(marts.mean_years_from_sums(spells, by, DAYS, SPELLS), marts.MEAN_YEARS)


def people_with_region(people: DataFrame, postal: DataFrame) -> DataFrame:
    """Region by cep. Raises when a cep has different rows: they would multiply people."""
    cep = marts.narrow_dimension(postal, ["cep", "state", "region"])
    marts.assert_unique_key(cep, "cep")
    return marts.lookup(people, cep, "cep")


def spells_with_position(spells: DataFrame, positions: DataFrame) -> DataFrame:
    """Level and area by position code. Raises when a code has different rows."""
    pos = marts.narrow_dimension(positions, ["level", "level_description", "area", "cod_area",
                                             "cod_level", "quadro", "bonus"])
    marts.assert_unique_key(pos, "level")
    return marts.lookup(spells, pos, "position", "level")


def _write_marts(spark: SparkSession, out_root: str, mart: Callable[[str], DataFrame],
                 run_ts: str) -> dict[str, DataFrame]:
    """Write the marts, small results all of them, side by side; they appear together."""
    paths = {name: os.path.join(out_root, name) for name in MART_SPECS}
    with publishing(spark) as stage:
        staged = {name: stage(path) for name, path in paths.items()}
        schemas = _together(*[lambda n=name: write_table(mart(n), staged[n], run_ts) for name in MART_SPECS])
    return {name: read_table(spark, paths[name], schema=schema)
            for name, schema in zip(MART_SPECS, schemas, strict=True)}


def gold(spark: SparkSession, postal_path: str, employees_path: str, positions_path: str,
         out_root: str, run_ts: str | None = None,
         approx_rsd: float | None = None) -> dict[str, DataFrame]:
    """Silver -> the five marts. Headcounts are exact unless ``approx_rsd``
    is given (HyperLogLog++ with that relative error).

    Employees are reduced before any join: to distinct (token, cep,
    generation) for the headcounts and to integer sums of days per (position,
    generation) for the means. Only these two are cached and joined to the
    dimensions, each to the one that its marts need.
    """
    run_ts = run_ts or run_timestamp()
    employees = read_table(spark, employees_path).withColumn("generation", generation("person_age"))
    people = employees.select("cpf_encrypted", "cep", "generation").distinct()
    spells = employees.groupBy("position", "generation").agg(
        F.sum("time_on_job").alias(DAYS), F.count("time_on_job").alias(SPELLS))
    people = people_with_region(people, read_table(spark, postal_path)).select(
        "cpf_encrypted", "region", "generation").persist(StorageLevel.MEMORY_AND_DISK)
    spells = spells_with_position(spells, read_table(spark, positions_path)).select(
        "level_description", "area", "generation", DAYS, SPELLS).persist(
            StorageLevel.MEMORY_AND_DISK)
    try:
        return _write_marts(spark, out_root,
                            lambda name: build_mart(people, spells, name, approx_rsd=approx_rsd), run_ts)
    finally:
        people.unpersist()
        spells.unpersist()


STATES = {"spells": ["position", "generation"], "people": ["cep", "generation"]}


def update_states(spark: SparkSession, employees_path: str, states_root: str,
                  months: Sequence[tuple[int, int]] | None = None) -> None:
    """Partial states of the marts per hire month, kept under ``states_root``.

    ``months`` (year, month): only these are read and made again, as after a
    drop; without it all are. A month that the silver table lost goes.
    """
    month = list(month_columns("hire_date"))
    employees = read_table(spark, employees_path)
    if months is not None:
        employees = employees.filter(reduce(
            lambda a, b: a | b, [(F.col(month[0]) == y) & (F.col(month[1]) == m) for y, m in months], F.lit(False)))
    employees = employees.withColumn("generation", generation("person_age"))
    states = {"spells": partials.spell_states(employees, month, STATES["spells"], "time_on_job"),
              "people": partials.people_states(employees, month, STATES["people"], "cpf_encrypted")}

    def keep(name: str) -> None:
        path = os.path.join(states_root, name)
        if months is None:
            with publishing(spark) as stage:
                write_partitioned(states[name], month, stage(path))
        else:
            replace_partitions(spark, path, states[name], month, months)

    _together(*[lambda n=name: keep(n) for name in states])


def gold_from_states(spark: SparkSession, postal_path: str, positions_path: str, states_root: str,
                     out_root: str, run_ts: str | None = None) -> dict[str, DataFrame]:
    """The five marts from kept states alone: means exact, headcounts within the sketches' error.

    As in ``gold``, the states of all months are merged, once for all marts,
    before they are joined to the dimensions.
    """
    run_ts = run_ts or run_timestamp()
    people = partials.merged_people(read_table(spark, os.path.join(states_root, "people")), STATES["people"])
    people = people_with_region(people, read_table(spark, postal_path)).select(
        "region", "generation", partials.PEOPLE).persist(StorageLevel.MEMORY_AND_DISK)
    spells = partials.merged_spells(read_table(spark, os.path.join(states_root, "spells")), STATES["spells"])
    spells = spells_with_position(spells, read_table(spark, positions_path)).select(
        "level_description", "area", "generation", partials.DAYS, partials.SPELLS).persist(
            StorageLevel.MEMORY_AND_DISK)

    def mart(name: str) -> DataFrame:
        measure, by = MART_SPECS[name]
        if measure == "headcount":
            return marts.ranked(partials.headcounts_of(people, by), marts.HEADCOUNT)
        return marts.ranked(partials.means_of(spells, by), marts.MEAN_YEARS)

    try:
        return _write_marts(spark, out_root, mart, run_ts)
    finally:
        people.unpersist()
        spells.unpersist()


# ------------------------------------------------------------------ full run

# Raw file name per entity inside the input folder, and the output layout.
INPUT_FILES = {"positions": "positions.csv", "postal": "postal.csv",
               "customers": "customers.csv", "employees": "employees.csv",
               "levels": "levels.csv", "partner_staff": "partner_staff.csv"}


def run_all(spark: SparkSession, input_dir: str, output_dir: str, as_of: date | str,
            key: TokenKey | str, strict: bool = True, run_ts: str | None = None,
            entities: Sequence[str] = tuple(INPUT_FILES), with_gold: bool = True) -> dict[str, object]:
    """The silver job of each named entity, then the gold job.

    All inputs are looked up first, with the file system that their path
    names; a missing one stops the run before anything is written.

    Layout under ``output_dir``: ``silver/<entity>``, ``quarantine/<entity>``,
    ``vault/<entity>`` (clear identifiers, restricted) and ``gold/<mart>``.
    The silver jobs are independent and run side by side; gold needs postal,
    employees and positions. One ``created_at`` stamp for the whole run.
    """
    run_ts = run_ts or run_timestamp()

    paths = {e: os.path.join(input_dir, INPUT_FILES[e]) for e in entities}
    missing = [p for p in paths.values() if not path_exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"no input at {', '.join(missing)}")
    lacking = {"postal", "employees", "positions"} - set(entities)
    if with_gold and lacking:
        raise ValueError(f"the gold job also needs {', '.join(sorted(lacking))}")

    def out(kind: str, entity: str) -> str:
        return os.path.join(output_dir, kind, entity)

    def silver(entity: str) -> JobResult:
        src, to, bad = paths[entity], out("silver", entity), out("quarantine", entity)
        vault = out("vault", entity)
        if entity == "positions":
            return silver_positions(spark, src, to, run_ts, bad)
        if entity == "postal":
            return silver_postal(spark, src, to, run_ts, bad)
        if entity == "customers":
            return silver_customers(spark, src, to, run_ts, bad, strict)
        if entity == "employees":
            return silver_employees(spark, src, to, vault, as_of, key, run_ts, bad, strict)
        if entity == "levels":
            return silver_levels(spark, src, to, run_ts, bad)
        return silver_pq(spark, src, to, vault, key, run_ts, bad)

    with ThreadPoolExecutor(len(INPUT_FILES)) as pool:
        done: dict[str, object] = dict(zip(paths, pool.map(silver, paths), strict=True))
    if with_gold:
        done["gold"] = gold(spark, out("silver", "postal"), out("silver", "employees"),
                            out("silver", "positions"), os.path.join(output_dir, "gold"), run_ts)
    return done
