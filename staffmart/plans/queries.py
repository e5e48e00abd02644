"""The pipeline's operators run over the driver's TPC-H-style tables.

The HR inputs of the pipeline are not available at scale, so each query maps
an operator onto tables that are: ``lineitem`` rows play employment spells
(start = order date, end = ship date, open while the line status is 'O'),
``customer`` plays the person, ``nation``/``region`` the postal dimension,
``part`` the position dimension. Defects (shifted cells, typos, fragments,
bad values) are planted by deterministic rules on the keys and repaired by
the same operators the silver jobs use; every query reads whole tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE_SQL[name]`` (DuckDB,
same tables as views) must agree on rows, column names and values.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staffmart.functions.bands import GENERATION_BANDS, UNKNOWN, generation
from staffmart.functions.temporal import (
    EXCEL_EPOCH,
    age_in_full_years,
    excel_serial_to_date,
    parse_day_first,
    tenure_days,
)
from staffmart.functions.text import correct, strip_leading, title_case
from staffmart.functions.tokens import TokenKey
from staffmart.operators import filters, marts, privacy, quality, repair, shape
from staffmart.plans import entities as E
from staffmart.plans import jobs
from staffmart.plans.jobs import DAYS, MART_SPECS, SPELLS, build_mart, gold
from staffmart.session import scratch_path
from staffmart.sources import (
    WIDE_LINE,
    read_delimited,
    read_header_split,
    read_table,
    write_by_month,
    write_table,
)

AS_OF = "2024-01-01"
# Demo token keys for the driver-table queries (a deployment reads its own
# from ``spark.staffmart.pseudonym.secret``).
KEY, NEXT_KEY = TokenKey("k:"), TokenKey("k2:", "2")

Query = Callable[[SparkSession, str], DataFrame]


# Schemas of the (read-only) driver tables, inferred once per path and then
# given to the reader, as a catalog would: re-inferring means listing the
# files and reading a footer every time a query is planned.
_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = os.path.join(sf_dir, f"{name}.parquet")
    schema = _SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


def key_mod(column: str, m: int) -> Column:
    return F.col(column) % F.lit(m)


# ------------------------------------------------------------- shared pieces

def region_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(n_nationkey, state, region)."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    joined = marts.lookup(nation, region, "n_regionkey", "r_regionkey")
    return marts.narrow_dimension(
        joined.select("n_nationkey", F.col("n_name").alias("state"),
                      F.col("r_name").alias("region")),
        ["n_nationkey", "state", "region"])


def spell_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item: its person, level, part and days.

    lineitem ⟕ orders is a fact-to-fact join (sort-merge on the order key
    once orders outgrows the broadcast threshold; adaptive skew handling
    splits a hot key).
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linestatus",
                                                  "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                                   "o_orderpriority")
    end = F.when(F.col("l_linestatus") == F.lit("O"), F.lit(None)).otherwise(F.col("l_shipdate"))
    return marts.lookup(li, orders, "l_orderkey", "o_orderkey").select(
        "o_custkey", "l_partkey", F.col("o_orderpriority").alias("level_description"),
        tenure_days(F.col("o_orderdate").cast("date"), end.cast("date"), AS_OF)
        .alias("time_on_job"))


def with_part(df: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area and generation by part, joined to rows that are already reduced."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("area"),
                                               F.col("p_size").alias("person_age"))
    return (marts.lookup(df, part, "l_partkey", "p_partkey")
            .withColumn("generation", generation("person_age")))


def _tenure_by_generation(name: str) -> Query:
    """Line items are reduced to integer sums per (part, level) before part is joined."""
    own = [c for c in MART_SPECS[name][1] if c == "level_description"]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sums = spell_days(spark, sf_dir).groupBy("l_partkey", *own).agg(
            F.sum("time_on_job").alias(DAYS), F.count("time_on_job").alias(SPELLS))
        sums = with_part(sums, spark, sf_dir)
        return build_mart(None, sums, name)
    return run


def tenure_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean tenure by level, with the line items pre-aggregated per order.

    The level is an order attribute, so each order's spells are reduced to
    (count, sum of end days) before the fact-to-fact join: the join then
    moves one row per order instead of one per line item, and the shuffle by
    order key is shared by the aggregation and the join. Integer sums keep
    the result exact: sum(end - start) = sum(end) - count * start.
    """
    end = F.when(F.col("l_linestatus") == F.lit("O"), F.lit(None)).otherwise(F.col("l_shipdate"))
    end_day = F.unix_date(F.coalesce(end.cast("date"), F.lit(AS_OF).cast("date")))
    per_order = (table(spark, sf_dir, "lineitem")
                 .groupBy("l_orderkey")
                 .agg(F.count(F.lit(1)).alias("spells"), F.sum(end_day).alias("end_days")))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("level_description"),
        F.unix_date(F.col("o_orderdate").cast("date")).alias("start_day"))
    joined = marts.lookup(per_order, orders, "l_orderkey", "o_orderkey")
    started = F.col("start_day").isNotNull()
    sums = joined.select(
        "level_description",
        F.when(started, F.col("end_days") - F.col("spells") * F.col("start_day")).alias("days"),
        F.when(started, F.col("spells")).alias("n"))
    return marts.ranked(marts.mean_years_from_sums(sums, ["level_description"], "days", "n"),
                        marts.MEAN_YEARS)


def region_headcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    people = privacy.pseudonymize(people, {"c_custkey": "cpf_encrypted"}, KEY)
    fact = marts.lookup(people, region_dimension(spark, sf_dir), "c_nationkey", "n_nationkey")
    return marts.ranked(marts.headcount(fact, ["region"], "cpf_encrypted"), marts.HEADCOUNT)


def generation_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct people per region and generation.

    Each person's generations are reduced to a set first (at most one entry
    per band, built with partial aggregation, so a person with a third of all
    rows still costs one small set per map task). The person lookup joins one row per person on the
    partitioning that the aggregation produced. A person is then in a group
    once, so that a plain count is exact.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    spells = marts.lookup(li, orders, "l_orderkey", "o_orderkey")
    per_person = (with_part(spells, spark, sf_dir).groupBy("o_custkey")
                  .agg(F.collect_set("generation").alias("generations")))
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    fact = marts.lookup(per_person, people, "o_custkey", "c_custkey")
    fact = marts.lookup(fact, region_dimension(spark, sf_dir), "c_nationkey", "n_nationkey")
    fact = fact.select("o_custkey", "region", F.explode("generations").alias("generation"))
    return marts.ranked(fact.groupBy("region", "generation").agg(
        F.count("o_custkey").alias(marts.HEADCOUNT)), marts.HEADCOUNT)


GOLD_LONG = ["mart", "region", "level_description", "generation", "area",
             marts.HEADCOUNT, marts.MEAN_YEARS]


def derived_silver(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Paths of written silver tables, derived from the driver tables.

    Silver employees: one row per line item (token of the ordering customer,
    the customer's nation as postal code, the part as position, part size as
    age, spell from order date to ship date), written month-partitioned by
    hire date. Silver postal: nation ⟕ region. Silver positions: part.
    """
    # People are tokenised on their own table (one hash per person, not per
    # spell) and meet the orders, of which there are fewer than spells; the
    # tokens, which make rows wide, join the spells last.
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    people = privacy.pseudonymize(people, {"c_custkey": "cpf_encrypted"}, KEY)
    orders = marts.lookup(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"),
        people, "o_custkey", "c_custkey").drop("o_custkey", "c_custkey")
    spells = marts.lookup(
        table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linestatus",
                                                "l_shipdate"),
        table(spark, sf_dir, "part").select("p_partkey", "p_size"), "l_partkey", "p_partkey")
    spells = marts.lookup(spells, orders, "l_orderkey", "o_orderkey")
    end = F.when(F.col("l_linestatus") == F.lit("O"), F.lit(None)).otherwise(F.col("l_shipdate"))
    hire = F.col("o_orderdate").cast("date")
    employees = spells.select(
        "cpf_encrypted", F.col("c_nationkey").cast("string").alias("cep"),
        F.col("l_partkey").cast("string").alias("position"), hire.alias("hire_date"),
        tenure_days(hire, end.cast("date"), AS_OF).alias("time_on_job"),
        F.col("p_size").alias("person_age"))
    postal = region_dimension(spark, sf_dir).select(
        F.col("n_nationkey").cast("string").alias("cep"), "state", "region")
    none = F.lit(None).cast("string")
    positions = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("level"),
        F.col("p_brand").alias("level_description"), F.col("p_type").alias("area"),
        none.alias("cod_area"), none.alias("cod_level"), none.alias("quadro"),
        none.alias("bonus"))
    paths = {n: scratch_path(spark, f"silver_{n}") for n in ("employees", "postal", "positions")}
    write_by_month(employees, "hire_date", paths["employees"])
    write_table(postal, paths["postal"])
    write_table(positions, paths["positions"])
    return paths


def gold_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold job itself (``jobs.gold``) on silver tables derived from the
    driver tables; its five written marts as one long table."""
    paths = derived_silver(spark, sf_dir)
    return long_marts(gold(spark, paths["postal"], paths["employees"], paths["positions"],
                           scratch_path(spark, "marts")))


def long_marts(out: dict[str, DataFrame]) -> DataFrame:
    """The marts as one table; columns that a mart lacks are NULL."""
    long = None
    for name, mart in out.items():
        cols = [F.lit(name).alias("mart")]
        for c in GOLD_LONG[1:]:
            dtype = "bigint" if c == marts.HEADCOUNT else "double" if c == marts.MEAN_YEARS \
                else "string"
            cols.append((F.col(c) if c in mart.columns else F.lit(None)).cast(dtype).alias(c))
        piece = mart.select(*cols)
        long = piece if long is None else long.unionByName(piece)
    return long


# ------------------------------------------------------------ date functions

def generation_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    age = F.when(key_mod("p_partkey", 13) == 0, F.lit(None)).otherwise(k % 105 - 2)
    return (table(spark, sf_dir, "part")
            .select("p_partkey", age.alias("person_age"))
            .withColumn("generation", generation("person_age")))


def age_full_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    birth = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", birth.alias("birth_date"),
        age_in_full_years(birth, AS_OF).alias("person_age"))


def excel_serial_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    serial = F.datediff(F.col("o_orderdate").cast("date"),
                        F.lit(EXCEL_EPOCH).cast("date")).cast("string")
    text = (F.when(key_mod("o_orderkey", 13) == 0, F.lit("n/a"))
            .when(key_mod("o_orderkey", 11) == 0, F.concat(serial, F.lit(".75")))
            .otherwise(serial))
    out = (table(spark, sf_dir, "orders")
           .select("o_orderkey", text.alias("serial_text"))
           .withColumn("hire_date", excel_serial_to_date("serial_text")))
    quality.assert_column_types(out, {"hire_date": T.DateType()})
    return out


def parse_br_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = (F.when(key_mod("o_orderkey", 7) == 0,
                   (F.col("o_orderkey") * 7919 + 10_000_000).cast("string"))
            .otherwise(F.date_format(F.col("o_orderdate"), "dd/MM/yyyy")))
    return (table(spark, sf_dir, "orders")
            .select("o_orderkey", text.alias("date_text"))
            .withColumn("contract_start_date", parse_day_first("date_text")))


# ------------------------------------------------------------------- repairs

CUSTOMER_TEXT = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
CUSTOMER_TEXT_VALIDATORS = {
    "c_custkey": lambda c: c.rlike(r"^\d+$"),
    "c_name": lambda c: ~c.rlike(r"^-?[0-9.]+$"),
    "c_nationkey": lambda c: c.rlike(r"^\d+$"),
    "c_acctbal": lambda c: c.try_cast("double").isNotNull(),
    "c_mktsegment": lambda c: c.rlike(r"^[A-Z]+$"),
}


def shifted_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer rows as text; every third row gets an empty cell inserted at
    position ``key % 4 + 1`` and its last cell pushed into ``_c5``."""
    k = F.col("c_custkey")
    shifted = key_mod("c_custkey", 3) == 0
    gap = k % 4 + 1
    text = [F.col(c).cast("string") for c in CUSTOMER_TEXT]
    cells = []
    for i, name in enumerate(CUSTOMER_TEXT):
        if i == 0:
            cells.append(text[0].alias(name))
            continue
        cell = (F.when(~shifted | (gap > i), text[i])
                .when(gap == i, F.lit(None).cast("string"))
                .otherwise(text[i - 1]))
        cells.append(cell.alias(name))
    cells.append(F.when(shifted, text[-1]).alias("_c5"))
    return table(spark, sf_dir, "customer").select(*cells)


def realign_shifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = repair.realign(shifted_customers(spark, sf_dir), CUSTOMER_TEXT, ["_c5"],
                           CUSTOMER_TEXT_VALIDATORS)
    typed = shape.to_typed(fixed, {"c_custkey": "bigint", "c_nationkey": "int",
                                   "c_acctbal": "double"})
    return typed.withColumnRenamed(repair.STATUS_COLUMN, "realign_status")


def silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer silver path end to end on the whole customer table.

    Shifted rows are written as ';' text with a real extra empty cell, read
    back with an explicit string schema plus one overflow column, realigned,
    typed, gated (rows failing a rule would be split off), written as a
    stamped table and read back.
    """
    raw_path = scratch_path(spark, "customer_csv")
    (shifted_customers(spark, sf_dir).write.mode("overwrite")
     .option("sep", ";").option("header", True).csv(raw_path))
    raw = read_delimited(spark, raw_path, ";", CUSTOMER_TEXT, overflow=1)
    fixed = repair.realign(raw, CUSTOMER_TEXT, ["_c5"], CUSTOMER_TEXT_VALIDATORS)
    typed = shape.to_typed(fixed, {"c_custkey": "bigint", "c_nationkey": "int",
                                   "c_acctbal": "double"})
    rules = [quality.not_null(c) for c in CUSTOMER_TEXT] + [quality.in_set(
        repair.STATUS_COLUMN, [repair.CLEAN, repair.REPAIRED])]
    passing, _ = quality.split_quarantine(typed, rules)
    silver_path = scratch_path(spark, "customer_silver")
    written = write_table(passing.drop(repair.STATUS_COLUMN), silver_path)
    return read_table(spark, silver_path, True, written).select(*CUSTOMER_TEXT)


# Fixed values for the planted misspellings of ``clean_labels``.
SEGMENT_CORRECTIONS = {"FURNTIURE": "FURNITURE", "MACHNIERY": "MACHINERY"}


def clean_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    seg = F.col("c_mktsegment")
    typo = seg
    for right_word, wrong_word in ((v, k) for k, v in SEGMENT_CORRECTIONS.items()):
        typo = F.replace(typo, F.lit(right_word), F.lit(wrong_word))
    dirty = F.when(key_mod("c_custkey", 7) == 0, typo).otherwise(seg)
    dirty = F.when(key_mod("c_custkey", 5) == 0, F.concat(F.lit("@@@"), dirty)).otherwise(dirty)
    planted = table(spark, sf_dir, "customer").select("c_custkey", dirty.alias("c_mktsegment"))
    return planted.withColumn("c_mktsegment",
                              correct(strip_leading("c_mktsegment"), SEGMENT_CORRECTIONS))


def fill_if_null_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(key_mod("p_partkey", 3) == 0, F.lit(None)).otherwise(F.col("p_brand"))
        .alias("brand"),
        F.when(key_mod("p_partkey", 5) == 0, F.lit(None)).otherwise(F.col("p_type"))
        .alias("part_type"),
        F.when(key_mod("p_partkey", 7) == 0, F.lit(None))
        .when(key_mod("p_partkey", 11) == 0, F.lit("n/a"))
        .otherwise(F.col("p_size").cast("string")).alias("size_text"),
        F.col("p_partkey").cast("string").alias("key_text"),
    )
    filled = repair.fill_from_right(planted, ["brand", "part_type", "size_text", "key_text"])
    return filled.withColumn("size_value", F.col("size_text").try_cast("int"))


def drop_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = (F.when(key_mod("c_custkey", 11) == 0, F.col("c_mktsegment"))
            .when(key_mod("c_custkey", 13) == 0, F.lit(None))
            .otherwise(F.col("c_name")))
    position = F.when(key_mod("c_custkey", 17) == 0, F.lit(None)).otherwise(F.col("c_mktsegment"))
    planted = table(spark, sf_dir, "customer").select(
        "c_custkey", name.alias("customer"), position.alias("responsible_position"))
    return filters.keep_not_null(filters.drop_fragments(planted, "customer"),
                                 "responsible_position")


def title_case_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(key_mod("p_partkey", 3) == 0, F.upper("p_name")).otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", title_case(name).alias("title"))


# --------------------------------------------------------------- projections

VALID_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM"]
LEVEL_RENAME = {"o_orderkey": "level", "o_orderpriority": "level_description",
                "o_orderstatus": "time_on_level"}


def valid_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = filters.keep_in_set(table(spark, sf_dir, "orders"), "o_orderpriority",
                               VALID_PRIORITIES)
    return shape.select_renamed(kept, list(LEVEL_RENAME), LEVEL_RENAME)


ORDER_RENAME = {"o_orderkey": "hr_id", "o_custkey": "cpf", "o_orderstatus": "marital_status",
                "o_totalprice": "base_salary", "o_orderdate": "hire_date",
                "o_orderpriority": "position", "ID de Pessoal": "personnel_id"}


def drop_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Filler cells under empty header names arrive as _c<N>; a scratch column
    # is added and dropped; the map has an entry that matches nothing.
    orders = table(spark, sf_dir, "orders")
    raw = orders.select(
        "o_orderkey", F.lit(None).cast("string").alias("_c1"), "o_custkey",
        F.lit(None).cast("string").alias("_c3"), "o_orderstatus", "o_totalprice",
        "o_orderdate", "o_orderpriority")
    raw = raw.withColumn("temp_end", F.coalesce(F.col("o_orderdate"), F.lit(None)))
    renamed = shape.rename(shape.drop_filler_columns(raw).drop("temp_end"), ORDER_RENAME)
    return renamed.withColumn("hire_date", F.col("hire_date").cast("date"))


# ------------------------------------------------------------------- quality

def staged_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders dressed as employee rows, with planted rule failures."""
    k = "o_orderkey"
    rg = F.when(key_mod(k, 101) == 0, F.lit(None)).otherwise(F.col(k).cast("string"))
    birth = (F.when(key_mod(k, 97) == 0, F.lit("1899-06-01").cast("date"))
             .otherwise(F.col("o_orderdate").cast("date")))
    salary = F.when(key_mod(k, 89) == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    taxes = (F.when(key_mod(k, 83) == 0, F.lit("-1"))
             .when(key_mod(k, 79) == 0, F.lit("12."))
             .when(key_mod(k, 73) == 0, F.lit("1.2E8"))
             .otherwise(F.concat((F.col(k) % 1000).cast("string"), F.lit("."),
                                 (F.col(k) % 100).cast("string"))))
    return table(spark, sf_dir, "orders").select(
        F.col(k).alias("hr_id"), rg.alias("id_card_number_rg"), F.col("o_custkey").alias("cpf"),
        birth.alias("birth_date"), salary.alias("base_salary"), taxes.alias("taxes"),
        (F.col(k) % 5).cast("int").alias("importance_level"))


def people_rules() -> list[quality.Rule]:
    return [
        quality.not_null("id_card_number_rg"),
        quality.not_null("cpf"),
        quality.unique("cpf"),
        quality.unique("hr_id"),
        quality.between("birth_date", date(1900, 1, 1), date.fromisoformat(AS_OF)),
        quality.between("base_salary", 0, None),
        quality.matches("taxes", r"^\d+\.?\d*$"),
        quality.in_set("importance_level", [1, 2, 3, 4]),
    ]


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(staged_people(spark, sf_dir), people_rules())


def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [r for r in people_rules() if r.column != "cpf" or r.rule != "unique"]
    _, bad = quality.split_quarantine(staged_people(spark, sf_dir), rules)
    return bad.select("hr_id", F.col(quality.FAILED_COLUMN).alias("failed_rules"))


# ------------------------------------------------------------------- privacy

PEOPLE_TOKENS = {"c_custkey": "cpf_encrypted", "c_name": "rg_encrypted"}


def pseudonymize_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = privacy.pseudonymize(table(spark, sf_dir, "customer"), PEOPLE_TOKENS, KEY)
    _, public = privacy.split_vault(people, ["c_custkey", "c_name", "cpf_encrypted"],
                                    ["c_custkey", "c_name"])
    return public


def vault_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = privacy.pseudonymize(table(spark, sf_dir, "customer"), PEOPLE_TOKENS, KEY)
    vault, public = privacy.split_vault(people, ["c_custkey", "c_name", "cpf_encrypted"],
                                        ["c_custkey", "c_name"])
    vault_path, public_path = scratch_path(spark, "vault"), scratch_path(spark, "public")
    vault_schema = write_table(vault, vault_path)
    public_schema = write_table(public, public_path)
    back = privacy.reidentify(read_table(spark, public_path, True, public_schema),
                              read_table(spark, vault_path, True, vault_schema),
                              "cpf_encrypted", ["c_custkey", "c_name"])
    return back.select(*CUSTOMER_TEXT)


# --------------------------------------------------------------------- sinks

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                 "o_orderpriority"]


def _orders_dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("o_orderdate",
                                                     F.col("o_orderdate").cast("date"))


def month_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders_by_month")
    write_by_month(_orders_dated(spark, sf_dir).withColumnRenamed("o_orderdate", "hire_date"),
                   "hire_date", path)
    back = read_table(spark, path)
    return back.groupBy("year_hire_date", "month_hire_date").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.bool_and(F.col("created_at").isNotNull()).alias("stamped"))


def sorted_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month-partitioned write sorted by price; ``in_order`` compares every row
    with the one before it in its file (files are bounded by the sink)."""
    path = scratch_path(spark, "orders_sorted")
    write_by_month(_orders_dated(spark, sf_dir), "o_orderdate", path, sort_by=["o_totalprice"])
    back = read_table(spark, path).select(
        *ORDER_COLUMNS, F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("at"))
    before = F.lag("o_totalprice").over(Window.partitionBy("file").orderBy("at"))
    ordered = F.coalesce(before <= F.col("o_totalprice"), F.lit(True))
    return back.withColumn("in_order", ordered).select(*ORDER_COLUMNS, "in_order")


def stamped_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "mart_region")
    back = read_table(spark, path, schema=write_table(region_headcount(spark, sf_dir), path))
    return back.filter(F.col("created_at").isNotNull()).drop("created_at")


# ------------------------------------------------------------------- sources

SUPPLIER_COLUMNS = ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]


def header_split_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as pipe text in part files whose headers order the columns in three ways."""
    names = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    customer = table(spark, sf_dir, "customer")
    paths = []
    for i in range(3):
        order = [*names[i:], *names[:i]]
        doubled = F.when(key_mod("c_custkey", 2) == 0, F.lit("||")).otherwise(F.lit("|"))
        line = F.concat(F.col(order[0]).cast("string"), doubled,
                        F.concat_ws("|", *[F.col(c).cast("string") for c in order[1:]]))
        paths.append(write_raw_lines(line, "|".join(order), customer.filter(key_mod("c_custkey", 3) == i),
                                     scratch_path(spark, f"customer_text_{i}")))
    back = read_header_split(spark, paths, "|", names)
    return shape.to_typed(back, {"c_custkey": "bigint", "c_nationkey": "int"})


def delimited_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    parts = []
    for sep in ("%", ";"):
        path = scratch_path(spark, "supplier_csv")
        supplier.write.mode("overwrite").option("sep", sep).option("header", True).csv(path)
        back = read_delimited(spark, path, sep, SUPPLIER_COLUMNS)
        typed = shape.to_typed(back, {"s_suppkey": "bigint", "s_nationkey": "int",
                                      "s_acctbal": "double"})
        parts.append(typed.select(F.lit(sep).alias("sep"), *SUPPLIER_COLUMNS))
    return parts[0].unionByName(parts[1])


# ------------------------------------------------------- the silver jobs

# Raw files written from the driver tables, read by the jobs themselves.


def shifted(cells: list[Column], gap: Column) -> list[Column]:
    """One more cell than given: an empty one at ``gap`` (NULL: behind the last)."""
    none = F.lit(None).cast("string")
    own = F.coalesce(gap, F.lit(len(cells)))
    return [F.when(own > i, cells[i] if i < len(cells) else none)
            .when(own == i, none)
            .otherwise(cells[i - 1] if i else none) for i in range(len(cells) + 1)]


def _write_raw(rows: DataFrame, sep: str, path: str) -> str:
    rows.write.mode("overwrite").option("sep", sep).option("header", True).csv(path)
    return path


def write_raw_lines(lines: Column, header: str, rows: DataFrame, path: str) -> str:
    """Whole lines, under ``header`` in every part file, with no quoting of their cells."""
    rows.select(lines.alias(header)).write.option("sep", "\t").option("quote", "\u0001").option(
        "header", True).csv(path)
    return path


def positions_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 on every part: a gap at each position, empty last cells, a row with
    two possible gaps (kind 8) and one with a cell too many (kind 9)."""
    k, none = F.col("p_partkey"), F.lit(None).cast("string")
    kind = k % 10
    levels = F.array(*[F.lit(v) for v in E.LEVELS])
    hiring = F.when((k % 6 == 0) & (kind != 9), none).otherwise(F.lit("Diretoria"))
    clean = [F.translate(F.concat(F.lit("P"), k.cast("string")), "0123456789", "ABCDEFGHIJ"),
             levels[(k % 5).cast("int")], F.concat(F.lit("@"), F.col("p_brand")),
             F.when(k % 2 == 0, F.lit("JAJ")).otherwise(F.lit("EDE")), F.lit("ID"),
             F.lit("Efetivo"), F.when(k % 3 == 0, F.lit("S")).otherwise(F.lit("N")), hiring]
    cells = shifted(clean, F.when(kind.between(1, 7), kind))
    double = [*clean[:3], none, clean[3], none, *clean[5:]]
    cells = [F.when(kind == 8, double[i]).when((kind == 9) & F.lit(i == 8), F.lit("extra"))
             .otherwise(c) for i, c in enumerate(cells)]
    raw = table(spark, sf_dir, "part").select(
        *[c.alias(n) for c, n in zip(cells, [*E.POSITIONS_COLUMNS, "_c8"], strict=True)])
    src = _write_raw(raw, E.POSITIONS_SEP, scratch_path(spark, "raw_positions"))
    bad = scratch_path(spark, "quarantine_positions")
    silver = jobs.silver_positions(spark, src, scratch_path(spark, "job_positions"),
                                   quarantine=bad).silver
    columns = list(E.POSITIONS_RENAME.values())
    rejected = shape.rename(read_table(spark, bad), E.POSITIONS_RENAME)
    return (silver.select(*columns, F.lit(True).alias("kept"))
            .unionByName(rejected.select(*columns, F.lit(False).alias("kept"))))


def postal_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2 on every customer: pipe lines, some separators doubled."""
    sep = F.when(key_mod("c_custkey", 3) == 0, F.lit("||")).otherwise(F.lit("|"))
    lines = table(spark, sf_dir, "customer").select(F.concat(
        F.lpad(F.col("c_custkey").cast("string"), 8, "0"), sep, F.col("c_mktsegment"),
        F.lit("|"), F.col("c_nationkey").cast("string")).alias("value"))
    header = spark.range(1).select(F.lit(E.POSTAL_SEP.join(E.POSTAL_COLUMNS)).alias("value"))
    src = scratch_path(spark, "raw_postal")
    header.unionByName(lines).write.mode("overwrite").text(src)
    return jobs.silver_postal(spark, src, scratch_path(spark, "job_postal"),
                              header_in_each_file=False).silver.select(
        *E.POSTAL_RENAME.values())


def levels_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E4 on every order; every seventh has a level that is not allowed."""
    k = F.col("o_orderkey")
    levels = F.array(*[F.lit(v) for v in E.LEVELS])
    cells = [k.cast("string"), F.when(k % 7 == 0, F.lit("Presidente")).otherwise(
        levels[(k % 5).cast("int")]), (k % 9).cast("string")]
    raw = table(spark, sf_dir, "orders").select(
        *[c.alias(n) for c, n in zip(cells, E.LEVELS_RENAME, strict=True)], F.lit("x").alias("Outro"))
    src = _write_raw(raw, E.LEVELS_SEP, scratch_path(spark, "raw_levels"))
    return jobs.silver_levels(spark, src, scratch_path(spark, "job_levels")).silver.select(
        *E.LEVELS_RENAME.values())


def customers_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5 on every customer: gaps at six positions, lines broken in two, and
    importance levels outside the set; rejected rows come with kept = false."""
    k = F.col("c_custkey")
    none = F.lit(None).cast("string")
    cells = [F.col("c_name"), (k * 10).cast("string"), (k % 90 + 1).cast("string"), F.lit("OPV"),
             F.lpad(k.cast("string"), 8, "0"), F.lit("15/03/2019"),
             F.when(k % 17 == 0, F.lit("7")).otherwise((k % 4 + 1).cast("string"))]
    whole = shifted(cells, F.when((k % 9).between(1, 6), k % 9))
    head, tail = [*cells[:3], *[none] * 5], [*cells[3:], *[none] * 4]
    lines = F.when(k % 13 == 0, F.array(F.array(*head), F.array(*tail))).otherwise(
        F.array(F.array(*whole)))
    names = [*E.CUSTOMERS_COLUMNS, *[f"_c{i}" for i in range(7, 7 + E.CUSTOMERS_OVERFLOW)]]
    raw = table(spark, sf_dir, "customer").select(F.explode(lines).alias("cells")).select(
        *[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names)])
    src = _write_raw(raw, E.CUSTOMERS_SEP, scratch_path(spark, "raw_customers"))
    bad = scratch_path(spark, "quarantine_customers")
    silver = jobs.silver_customers(spark, src, scratch_path(spark, "job_customers"),
                                   quarantine=bad, strict=False).silver
    columns = list(E.CUSTOMERS_RENAME.values())
    kept = silver.select(*columns, F.lit(True).alias("kept")).withColumn(
        "annual_contract_value", F.col("annual_contract_value").cast("double"))
    name = F.coalesce(F.get_json_object("row", "$.Cliente"), F.get_json_object("row", "$.customer"))
    rejected = read_table(spark, bad).select(name.alias("customer"), F.lit(False).alias("kept"))
    return kept.unionByName(rejected, allowMissingColumns=True)


def employees_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3 on every order, with cells that break each rule; kept rows come with
    the clear number that the vault gives back, rejected ones with their labels."""
    k = F.col("o_orderkey")
    hire = F.datediff(F.col("o_orderdate").cast("date"), F.lit(EXCEL_EPOCH).cast("date"))
    text = hire.cast("string")
    values = {c: F.lit("x") for c in E.EMPLOYEES_RENAME}
    values |= {
        "ID RH": k.cast("string"), "CEP": F.lit("20125535"), "Cargo": F.col("o_orderpriority"),
        "RG": F.when(k % 101 != 0, k.cast("string")),
        "CPF": F.when(k % 73 == 0, F.lit("repeated")).otherwise(F.concat(F.lit("c"), k.cast("string"))),
        "Data de Nascimento": F.when(k % 97 == 0, F.lit("-200")).otherwise(F.lit("30000")),
        "Data de Contratacao": text,
        "Data de Demissao": F.when(k % 79 == 0, F.lit("12d")).when(k % 2 == 0, (hire + 100).cast("string")),
        "Salario Base": F.when(k % 89 == 0, F.lit("abc")).when(k % 71 == 0, F.lit("-1"))
        .otherwise(F.lit("5000.50")),
        "Impostos": F.when(k % 83 == 0, F.lit("-1")).otherwise(F.lit("12.")),
    }
    cells = []
    for i, (c, value) in enumerate(values.items()):
        cells += [value.alias(c), F.lit(None).cast("string").alias(f"_c{2 * i + 1}")]
    src = _write_raw(table(spark, sf_dir, "orders").select(*cells), E.EMPLOYEES_SEP,
                     scratch_path(spark, "raw_employees"))
    bad, vault = scratch_path(spark, "quarantine_employees"), scratch_path(spark, "vault_employees")
    silver = jobs.silver_employees(spark, src, scratch_path(spark, "job_employees"), vault, AS_OF,
                                   KEY, quarantine=bad, strict=False).silver
    kept = privacy.reidentify(silver, read_table(spark, vault), "cpf_encrypted", ["cpf"])
    columns = ["hr_id", "position", "hire_date", "time_on_job"]
    return (kept.select(*columns, "cpf", F.lit("").alias("failed_rules"))
            .unionByName(read_table(spark, bad).select(
                *columns, F.lit(None).cast("string").alias("cpf"),
                F.col(quality.FAILED_COLUMN).alias("failed_rules"))))


def partner_staff_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6 on every order, with repeated header names, dates that are none and
    rows with cells past the header's."""
    k = F.col("o_orderkey")
    hire = F.datediff(F.col("o_orderdate").cast("date"), F.lit(EXCEL_EPOCH).cast("date"))
    repeated = {17: "Cargo", 43: "Nível", 44: "Cargo", 51: "Nível"}
    single = iter([c for c in E.PQ_COLUMNS if c not in ("Cargo17", "Nível43", "Nível51")])
    header = [repeated.get(i) or next(single, f"Outro {i}") for i in range(52)]
    values = {
        "ID RH": k.cast("string"), "CPF": F.concat(F.lit("c"), k.cast("string")),
        "Data de Nascimento": F.lit("30000"), "Data de Contratacao": hire.cast("string"),
        "Data de Demissao": F.when(k % 19 == 0, F.lit("n/a")).otherwise(F.lit("")),
    }
    cells = [F.col("o_orderpriority") if i == 51 else values.get(c, F.lit(f"x{i}"))
             for i, c in enumerate(header)]
    extra = F.when(k % 23 == 0, F.lit("lost"))
    src = write_raw_lines(F.concat_ws(E.PQ_SEP, *cells, extra), E.PQ_SEP.join(header),
                           table(spark, sf_dir, "orders"), scratch_path(spark, "raw_partner_staff"))
    bad, vault = scratch_path(spark, "quarantine_partner_staff"), scratch_path(spark, "vault_partner_staff")
    silver = jobs.silver_pq(spark, src, scratch_path(spark, "job_partner_staff"), vault, KEY,
                            quarantine=bad).silver
    columns = ["hr_id", "responsible_position", "level", "hire_date"]
    kept = privacy.reidentify(silver, read_table(spark, vault), "cpf_encrypted", ["cpf"])
    rejected = privacy.reidentify(read_table(spark, bad), read_table(spark, f"{vault}_rejected"),
                                  "cpf_encrypted", ["cpf"])
    return (kept.select(*columns, "cpf", F.lit("").alias("failed_rules"))
            .unionByName(rejected.select(*columns, "cpf",
                                         F.col(quality.FAILED_COLUMN).alias("failed_rules"))))


def wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as ';' text, some with cells past the last column: whole
    rows come back by cell, cut ones with their whole line."""
    k = F.col("c_custkey")
    extra = F.when(k % 5 == 0, F.lit("more;cells")).when(k % 7 == 0, F.lit(";;"))
    name = F.when(k % 3 == 0, F.concat(F.lit('"'), "c_name", F.lit(';q"'))).otherwise(F.col("c_name"))
    names = ["c_custkey", "c_name", "c_mktsegment"]
    src = write_raw_lines(F.concat_ws(";", k.cast("string"), name, "c_mktsegment", extra),
                           ";".join(names), table(spark, sf_dir, "customer"),
                           scratch_path(spark, "raw_wide"))
    rows = read_delimited(spark, src, ";", names, wide_lines=True)
    return rows.select(F.col("c_custkey").cast("bigint"), "c_name", "c_mktsegment",
                       F.col(WIDE_LINE).alias("wide_line"))


def dimension_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 with repeated rows and keys that have different rows: line items per
    customer segment count over unique keys, conflicting keys are reported."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    repeats = customer.filter(key_mod("c_custkey", 3) == 0)
    other = customer.filter(key_mod("c_custkey", 11) == 0).withColumn("c_mktsegment", F.lit("OTHER"))
    dim = marts.narrow_dimension(customer.unionByName(repeats).unionByName(other),
                                 ["c_custkey", "c_mktsegment"])
    one, _ = marts.split_by_key(dim, "c_custkey")
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    by_segment = marts.lookup(orders, one, "o_custkey", "c_custkey").groupBy(
        F.col("c_mktsegment").alias("segment")).agg(F.sum("n").alias("orders"))
    report = marts.key_conflicts(dim, "c_custkey")
    return by_segment.select(F.lit(None).cast("bigint").alias("conflicting_key"), "segment",
                             "orders", F.lit(None).cast("bigint").alias("rows")).unionByName(
        report.select(F.col("c_custkey").alias("conflicting_key"), F.lit(None).cast("string")
                      .alias("segment"), F.lit(None).cast("bigint").alias("orders"), "rows"))


QUERIES: dict[str, Query] = {
    "region_headcount": region_headcount,
    "tenure_by_level": tenure_by_level,
    "tenure_by_generation_level": _tenure_by_generation("generation_average_time_on_job"),
    "tenure_by_generation_area": _tenure_by_generation("area_generation_average_time_on_job"),
    "generation_region": generation_region,
    "gold_job": gold_job,
    "generation_bands": generation_bands,
    "age_full_years": age_full_years,
    "excel_serial_dates": excel_serial_dates,
    "parse_br_dates": parse_br_dates,
    "realign_shifted": realign_shifted,
    "silver_roundtrip": silver_roundtrip,
    "clean_labels": clean_labels,
    "fill_if_null_chain": fill_if_null_chain,
    "header_split_source": header_split_source,
    "delimited_source": delimited_source,
    "valid_levels": valid_levels,
    "drop_fragments": drop_fragments,
    "title_case": title_case_names,
    "drop_rename": drop_rename,
    "quality_report": quality_report,
    "quarantine_rows": quarantine_rows,
    "pseudonymize": pseudonymize_people,
    "vault_join": vault_join,
    "month_partitioned": month_partitioned,
    "sorted_write": sorted_write,
    "stamped_mart": stamped_mart,
    "positions_job": positions_job,
    "postal_job": postal_job,
    "levels_job": levels_job,
    "customers_job": customers_job,
    "employees_job": employees_job,
    "partner_staff_job": partner_staff_job,
    "wide_rows": wide_rows,
    "dimension_gate": dimension_gate,
}


# ------------------------------------------------------------- DuckDB oracle

def token_sql(value: str, field: str, key: TokenKey = KEY) -> str:
    """HMAC-SHA256 of ``field:value``, behind the key's version."""
    inner, outer = (f"unhex('{pad.hex()}')" for pad in key.pads())
    message = f"encode('{field}:' || CAST({value} AS VARCHAR))"
    return f"('{key.key_id}.' || sha256({outer} || unhex(sha256({inner} || {message}))))"


def generation_sql(age: str) -> str:
    arms = " ".join(f"WHEN {age} BETWEEN {lo} AND {hi} THEN '{name}'"
                    for name, lo, hi in GENERATION_BANDS)
    return f"CASE {arms} ELSE '{UNKNOWN}' END"


_REGION_DIM = """(SELECT DISTINCT n.n_nationkey, n.n_name AS state, r.r_name AS region
   FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""

_FACT = f"""fact AS (
  SELECT o.o_custkey, o.o_orderpriority AS level_description, p.p_type AS area,
         date_diff('day', CAST(o.o_orderdate AS DATE),
                   COALESCE(CAST(CASE WHEN l.l_linestatus = 'O' THEN NULL ELSE l.l_shipdate END
                                 AS DATE), DATE '{AS_OF}')) AS time_on_job,
         p.p_size AS person_age,
         {generation_sql('p.p_size')} AS generation
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey)"""

_MEAN = ("CASE WHEN count(time_on_job) > 0 THEN CAST(sum(time_on_job) AS DOUBLE) / "
         "(count(time_on_job) * CAST(365.25 AS DOUBLE)) END AS average_time_on_job_in_years")

_STAGED = f"""staged AS (
  SELECT o_orderkey AS hr_id,
         CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END
           AS id_card_number_rg,
         o_custkey AS cpf,
         CASE WHEN o_orderkey % 97 = 0 THEN DATE '1899-06-01' ELSE CAST(o_orderdate AS DATE) END
           AS birth_date,
         CASE WHEN o_orderkey % 89 = 0 THEN -o_totalprice ELSE o_totalprice END AS base_salary,
         CASE WHEN o_orderkey % 83 = 0 THEN '-1' WHEN o_orderkey % 79 = 0 THEN '12.'
              WHEN o_orderkey % 73 = 0 THEN '1.2E8'
              ELSE CAST(o_orderkey % 1000 AS VARCHAR) || '.' || CAST(o_orderkey % 100 AS VARCHAR)
         END AS taxes,
         CAST(o_orderkey % 5 AS INTEGER) AS importance_level
  FROM orders)"""

_ROW_RULES_SQL = [
    ("not_null", "id_card_number_rg", "count(*)", "id_card_number_rg IS NULL"),
    ("not_null", "cpf", "count(*)", "cpf IS NULL"),
    ("between", "birth_date", "count(birth_date)",
     f"birth_date IS NOT NULL AND NOT (birth_date >= DATE '1900-01-01' "
     f"AND birth_date <= DATE '{AS_OF}')"),
    ("between", "base_salary", "count(base_salary)",
     "base_salary IS NOT NULL AND NOT (base_salary >= 0)"),
    ("matches", "taxes", "count(taxes)",
     "taxes IS NOT NULL AND NOT regexp_matches(taxes, '^\\d+\\.?\\d*$')"),
    ("in_set", "importance_level", "count(importance_level)",
     "importance_level IS NOT NULL AND importance_level NOT IN (1, 2, 3, 4)"),
]


def _quality_sql() -> str:
    parts = [f"""SELECT '{rule}' AS rule, '{col}' AS column_name,
       CAST({evaluated} AS BIGINT) AS evaluated,
       CAST(count(*) FILTER (WHERE {fails}) AS BIGINT) AS unexpected FROM staged"""
             for rule, col, evaluated, fails in _ROW_RULES_SQL]
    for col in ("cpf", "hr_id"):
        parts.append(f"""SELECT 'unique' AS rule, '{col}' AS column_name,
       CAST(COALESCE(sum(n), 0) AS BIGINT) AS evaluated,
       CAST(COALESCE(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS unexpected
  FROM (SELECT {col}, count(*) AS n FROM staged WHERE {col} IS NOT NULL GROUP BY {col})""")
    body = "\nUNION ALL\n".join(parts)
    return (f"WITH {_STAGED}, report AS ({body})\n"
            "SELECT rule, column_name, evaluated, unexpected, unexpected = 0 AS success FROM report")


def _quarantine_sql() -> str:
    labels = ", ".join(f"CASE WHEN {fails} THEN '{rule}({col})' END"
                       for rule, col, _, fails in _ROW_RULES_SQL)
    any_fail = " OR ".join(f"({fails})" for _, _, _, fails in _ROW_RULES_SQL)
    return (f"WITH {_STAGED}\nSELECT hr_id, concat_ws(',', {labels}) AS failed_rules "
            f"FROM staged WHERE {any_fail}")


def _chain_sql() -> str:
    return """WITH s0 AS (
  SELECT p_partkey,
         CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_brand END AS brand,
         CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_type END AS part_type,
         CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 11 = 0 THEN 'n/a'
              ELSE CAST(p_size AS VARCHAR) END AS size_text,
         CAST(p_partkey AS VARCHAR) AS key_text
  FROM part),
s1 AS (SELECT p_partkey, COALESCE(brand, part_type) AS brand, part_type, size_text, key_text FROM s0),
s2 AS (SELECT p_partkey, brand, NULLIF(part_type, brand) AS part_type, size_text, key_text FROM s1),
s3 AS (SELECT p_partkey, brand, COALESCE(part_type, size_text) AS part_type, size_text, key_text FROM s2),
s4 AS (SELECT p_partkey, brand, part_type, NULLIF(size_text, part_type) AS size_text, key_text FROM s3),
s5 AS (SELECT p_partkey, brand, part_type, COALESCE(size_text, key_text) AS size_text, key_text FROM s4),
s6 AS (SELECT p_partkey, brand, part_type, size_text, NULLIF(key_text, size_text) AS key_text FROM s5)
SELECT p_partkey, brand, part_type, size_text, key_text,
       TRY_CAST(size_text AS INTEGER) AS size_value FROM s6"""


ORACLE_SQL: dict[str, str] = {
    "region_headcount": f"""
SELECT d.region AS region,
       count(DISTINCT {token_sql('c.c_custkey', 'c_custkey')}) AS total_employees
FROM customer c LEFT JOIN {_REGION_DIM} d ON c.c_nationkey = d.n_nationkey
GROUP BY d.region""",
    "tenure_by_level": f"""WITH {_FACT}
SELECT level_description, {_MEAN} FROM fact GROUP BY level_description""",
    "tenure_by_generation_level": f"""WITH {_FACT}
SELECT generation, level_description, {_MEAN} FROM fact GROUP BY generation, level_description""",
    "tenure_by_generation_area": f"""WITH {_FACT}
SELECT generation, area, {_MEAN} FROM fact GROUP BY generation, area""",
    "generation_region": f"""WITH {_FACT}
SELECT d.region AS region, f.generation AS generation,
       count(DISTINCT {token_sql('f.o_custkey', 'o_custkey')}) AS total_employees
FROM fact f
LEFT JOIN customer c ON f.o_custkey = c.c_custkey
LEFT JOIN {_REGION_DIM} d ON c.c_nationkey = d.n_nationkey
GROUP BY d.region, f.generation""",
    "generation_bands": f"""WITH a AS (
  SELECT p_partkey, CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_partkey % 105 - 2 END AS person_age
  FROM part)
SELECT p_partkey, person_age, {generation_sql('person_age')} AS generation FROM a""",
    "age_full_years": f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS birth_date,
       date_sub('year', CAST(o_orderdate AS DATE), DATE '{AS_OF}') AS person_age
FROM orders""",
    "excel_serial_dates": f"""WITH s AS (
  SELECT o_orderkey,
         CAST(date_diff('day', DATE '{EXCEL_EPOCH}', CAST(o_orderdate AS DATE)) AS VARCHAR) AS serial
  FROM orders),
t AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 13 = 0 THEN 'n/a' WHEN o_orderkey % 11 = 0 THEN serial || '.75'
              ELSE serial END AS serial_text
  FROM s)
SELECT o_orderkey, serial_text,
       CAST(DATE '{EXCEL_EPOCH}' + CAST(floor(TRY_CAST(serial_text AS DOUBLE)) AS INTEGER) AS DATE)
         AS hire_date
FROM t""",
    "parse_br_dates": """WITH t AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 7 = 0 THEN CAST(o_orderkey * 7919 + 10000000 AS VARCHAR)
              ELSE strftime(o_orderdate, '%d/%m/%Y') END AS date_text
  FROM orders)
SELECT o_orderkey, date_text, CAST(try_strptime(date_text, '%d/%m/%Y') AS DATE) AS contract_start_date
FROM t""",
    "realign_shifted": """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
       CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS realign_status
FROM customer""",
    "silver_roundtrip": """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""",
    "clean_labels": "SELECT c_custkey, c_mktsegment FROM customer",
    "fill_if_null_chain": _chain_sql(),
    "header_split_source": "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer",
    "delimited_source": """
SELECT '%' AS sep, s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
UNION ALL
SELECT ';' AS sep, s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""",
    "valid_levels": """
SELECT o_orderkey AS level, o_orderpriority AS level_description, o_orderstatus AS time_on_level
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""",
    "drop_fragments": """WITH t AS (
  SELECT c_custkey,
         CASE WHEN c_custkey % 11 = 0 THEN c_mktsegment WHEN c_custkey % 13 = 0 THEN NULL
              ELSE c_name END AS customer,
         CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_mktsegment END AS responsible_position
  FROM customer)
SELECT c_custkey, customer, responsible_position FROM t
WHERE customer IS NOT NULL AND NOT regexp_matches(customer, '^[A-Z]{2,}$')
  AND responsible_position IS NOT NULL""",
    "title_case": """
SELECT p_partkey,
       array_to_string(list_transform(string_split(p_name, ' '),
                                      lambda w: upper(w[1]) || lower(w[2:])), ' ') AS title
FROM part""",
    "drop_rename": """
SELECT o_orderkey AS hr_id, o_custkey AS cpf, o_orderstatus AS marital_status,
       o_totalprice AS base_salary, CAST(o_orderdate AS DATE) AS hire_date,
       o_orderpriority AS position
FROM orders""",
    "quality_report": _quality_sql(),
    "quarantine_rows": _quarantine_sql(),
    "pseudonymize": f"""
SELECT {token_sql('c_custkey', 'c_custkey')} AS cpf_encrypted,
       {token_sql('c_name', 'c_name')} AS rg_encrypted,
       c_nationkey, c_acctbal, c_mktsegment
FROM customer""",
    "vault_join": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "month_partitioned": """
SELECT CAST(year(CAST(o_orderdate AS DATE)) AS INTEGER) AS year_hire_date,
       CAST(month(CAST(o_orderdate AS DATE)) AS INTEGER) AS month_hire_date,
       count(*) AS n_rows, true AS stamped
FROM orders GROUP BY 1, 2""",
    "sorted_write": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       o_orderpriority, true AS in_order
FROM orders""",
}
ORACLE_SQL["stamped_mart"] = ORACLE_SQL["region_headcount"]


def _gold_job_sql() -> str:
    def mart(name, keys, measure):
        cols = []
        for c in ("region", "level_description", "generation", "area"):
            cols.append(c if c in keys else f"CAST(NULL AS VARCHAR) AS {c}")
        if measure == "headcount":
            m = ("count(DISTINCT cpf_encrypted) AS total_employees, "
                 "CAST(NULL AS DOUBLE) AS average_time_on_job_in_years")
        else:
            m = f"CAST(NULL AS BIGINT) AS total_employees, {_MEAN}"
        return (f"SELECT '{name}' AS mart, {', '.join(cols)}, {m} FROM fact "
                f"GROUP BY {', '.join(keys)}")
    parts = [mart(n, by, measure) for n, (measure, by) in MART_SPECS.items()]
    return f"""WITH emp AS (
  SELECT {token_sql('c.c_custkey', 'c_custkey')} AS cpf_encrypted,
         CAST(c.c_nationkey AS VARCHAR) AS cep, CAST(l.l_partkey AS VARCHAR) AS position,
         date_diff('day', CAST(o.o_orderdate AS DATE),
                   COALESCE(CAST(CASE WHEN l.l_linestatus = 'O' THEN NULL ELSE l.l_shipdate END
                                 AS DATE), DATE '{AS_OF}')) AS time_on_job,
         p.p_size AS person_age
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
postal AS (SELECT DISTINCT CAST(n_nationkey AS VARCHAR) AS cep, state, region FROM {_REGION_DIM}),
pos AS (SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS level, p_brand AS level_description,
               p_type AS area FROM part),
fact AS (
  SELECT e.cpf_encrypted, e.time_on_job, postal.region, pos.level_description, pos.area,
         {generation_sql('e.person_age')} AS generation
  FROM emp e LEFT JOIN postal ON e.cep = postal.cep LEFT JOIN pos ON e.position = pos.level)
""" + "\nUNION ALL\n".join(parts)


ORACLE_SQL["gold_job"] = _gold_job_sql()


# Fixed: the levels as a DuckDB list (1-based).
_LEVEL_SQL = "[" + ", ".join(f"'{v}'" for v in E.LEVELS) + "]"

ORACLE_SQL["positions_job"] = f"""WITH t AS (
  SELECT p_partkey AS k, p_partkey % 10 AS kind,
         translate('P' || CAST(p_partkey AS VARCHAR), '0123456789', 'ABCDEFGHIJ') AS level,
         {_LEVEL_SQL}[p_partkey % 5 + 1] AS level_description, p_brand AS brand,
         CASE WHEN p_partkey % 2 = 0 THEN 'JAJ' ELSE 'EDE' END AS code,
         CASE WHEN p_partkey % 3 = 0 THEN 'S' ELSE 'N' END AS bonus,
         CASE WHEN p_partkey % 6 = 0 AND p_partkey % 10 <> 9 THEN NULL ELSE 'Diretoria' END AS hiring
  FROM part)
SELECT level, level_description, brand AS area,
       CASE WHEN kind = 8 THEN NULL ELSE code END AS cod_area,
       CASE WHEN kind = 8 THEN code ELSE 'ID' END AS cod_level,
       CASE WHEN kind = 8 THEN NULL ELSE 'Efetivo' END AS quadro,
       CASE WHEN kind = 8 THEN 'Efetivo' ELSE bonus END AS bonus,
       CASE WHEN kind = 8 THEN bonus ELSE hiring END AS hiring,
       kind < 8 AS kept
FROM t"""
ORACLE_SQL["postal_job"] = """
SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS cep, c_mktsegment AS state,
       CAST(c_nationkey AS VARCHAR) AS region FROM customer"""
ORACLE_SQL["levels_job"] = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS level, {_LEVEL_SQL}[o_orderkey % 5 + 1] AS level_description,
       CAST(o_orderkey % 9 AS VARCHAR) AS time_on_level
FROM orders WHERE o_orderkey % 7 <> 0"""
ORACLE_SQL["customers_job"] = """WITH t AS (SELECT *, c_custkey AS k FROM customer)
SELECT c_name AS customer, CAST(k * 10 AS DOUBLE) AS annual_contract_value,
       CAST(k % 90 + 1 AS INTEGER) AS number_of_services, 'OPV' AS responsible_position,
       lpad(CAST(k AS VARCHAR), 8, '0') AS cep, DATE '2019-03-15' AS contract_start_date,
       CAST(k % 4 + 1 AS INTEGER) AS importance_level, true AS kept
FROM t WHERE k % 13 <> 0 AND k % 17 <> 0
UNION ALL
SELECT c_name, NULL, NULL, NULL, NULL, NULL, NULL, false FROM t WHERE k % 13 = 0 OR k % 17 = 0
UNION ALL
SELECT 'OPV', NULL, NULL, NULL, NULL, NULL, NULL, false FROM t WHERE k % 13 = 0"""
ORACLE_SQL["employees_job"] = f"""WITH t AS (
  SELECT o_orderkey AS k, o_orderpriority AS position, CAST(o_orderdate AS DATE) AS hire_date,
         CASE WHEN o_orderkey % 79 = 0 THEN NULL WHEN o_orderkey % 2 = 0
              THEN CAST(o_orderdate AS DATE) + 100 END AS left_on,
         count(*) FILTER (WHERE o_orderkey % 73 = 0) OVER () AS repeated
  FROM orders),
f AS (
  SELECT *, concat_ws(',',
    CASE WHEN k % 79 = 0 THEN 'castable(termination_date)' END,
    CASE WHEN k % 89 = 0 THEN 'castable(base_salary)' END,
    CASE WHEN k % 101 = 0 THEN 'not_null(id_card_number_rg)' END,
    CASE WHEN k % 97 = 0 THEN 'between(birth_date)' END,
    CASE WHEN k % 71 = 0 AND k % 89 <> 0 THEN 'between(base_salary)' END,
    CASE WHEN k % 83 = 0 THEN 'matches(taxes)' END,
    CASE WHEN k % 73 = 0 AND repeated > 1 THEN 'unique(cpf)' END) AS failed_rules
  FROM t)
SELECT CAST(k AS VARCHAR) AS hr_id, position, hire_date,
       CAST(date_diff('day', hire_date, COALESCE(left_on, DATE '{AS_OF}')) AS INTEGER) AS time_on_job,
       CASE WHEN failed_rules <> '' THEN NULL
            WHEN k % 73 = 0 THEN 'repeated' ELSE 'c' || CAST(k AS VARCHAR) END AS cpf,
       failed_rules
FROM f"""
ORACLE_SQL["partner_staff_job"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS hr_id, 'x17' AS responsible_position, o_orderpriority AS level,
       CAST(o_orderdate AS DATE) AS hire_date, 'c' || CAST(o_orderkey AS VARCHAR) AS cpf,
       concat_ws(',', CASE WHEN o_orderkey % 23 = 0 THEN 'is_null(_wide_line)' END,
                 CASE WHEN o_orderkey % 19 = 0 THEN 'castable(termination_date)' END) AS failed_rules
FROM orders"""
ORACLE_SQL["wide_rows"] = """WITH t AS (
  SELECT *, CASE WHEN c_custkey % 3 = 0 THEN c_name || ';q' ELSE c_name END AS cell,
         CASE WHEN c_custkey % 3 = 0 THEN '"' ELSE '' END AS q
  FROM customer)
SELECT c_custkey, cell AS c_name, c_mktsegment,
       CASE WHEN c_custkey % 5 = 0 THEN CAST(c_custkey AS VARCHAR) || ';' || q || cell || q || ';'
            || c_mktsegment || ';more;cells' END AS wide_line
FROM t"""
ORACLE_SQL["dimension_gate"] = """WITH by_segment AS (
  SELECT CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END AS segment, count(*) AS orders
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1)
SELECT CAST(NULL AS BIGINT) AS conflicting_key, segment, orders, CAST(NULL AS BIGINT) AS rows
FROM by_segment
UNION ALL
SELECT c_custkey, NULL, NULL, 2 FROM customer WHERE c_custkey % 11 = 0"""
