"""Queries over tables that are kept: merges, publishing, vaults, partial states; and rows that must balance.

Like ``plans.queries`` over the driver's tables, with DuckDB SQL for each.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staffmart.functions.bands import UNKNOWN
from staffmart.functions.temporal import EXCEL_EPOCH
from staffmart.functions.tokens import key_id_of
from staffmart.operators import banding, marts, partials, privacy, quality
from staffmart.plans import entities as E
from staffmart.plans import jobs
from staffmart.plans.queries import ORACLE_SQL as GOLD_SQL
from staffmart.plans.queries import (
    AS_OF,
    KEY,
    NEXT_KEY,
    Query,
    derived_silver,
    long_marts,
    table,
    token_sql,
    write_raw_lines,
)
from staffmart.session import scratch_path
from staffmart.sources import (
    merge_by_month,
    publishing,
    read_table,
    write_table,
)
from staffmart.sources.sinks import month_columns

FIRST_RUN, SECOND_RUN = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


# ---------------------------------------------------------------- row balance

# Fixed: a quoted cell that is long and full of separators, behind the last column.
_LONG_REPEATS = 3000


def _balanced(entity: str, rows: DataFrame, row_id: str, failed: str = "''", raw: str = "NULL") -> DataFrame:
    return rows.selectExpr(f"'{entity}' AS entity", f"CAST({row_id} AS STRING) AS row_id",
                           f"{failed} AS failed_rules", f"CAST({raw} AS STRING) AS raw")


def _employees_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    hire = F.datediff(F.col("o_orderdate").cast("date"), F.lit(EXCEL_EPOCH).cast("date")).cast("string")
    values = {c: F.lit("x") for c in E.EMPLOYEES_RENAME}
    values |= {
        "ID RH": k.cast("string"), "RG": k.cast("string"), "CPF": F.concat(F.lit("c"), k.cast("string")),
        "Data de Nascimento": F.lit("30000"), "Data de Demissao": F.when(k % 97 == 0, F.lit("12d")).otherwise(F.lit("")),
        "Data de Contratacao": hire,
        "Salario Base": F.when(k % 71 == 0, F.lit("7.005")).otherwise(F.lit("5000.50")),
        "Impostos": F.when(k % 83 == 0, F.lit("99999999999999999999")).when(k % 79 == 0, F.lit("1.239"))
        .otherwise(F.lit("12.")),
    }
    cells = [x for v in values.values() for x in (v, F.lit(""))][:-1]
    extra = F.when(k % 101 == 0, F.concat(F.lit('|"'), F.repeat(F.lit("x|"), _LONG_REPEATS), F.lit('"|lost')))
    line = F.concat(F.concat_ws(E.EMPLOYEES_SEP, *cells), F.coalesce(extra, F.lit("")))
    header = E.EMPLOYEES_SEP.join(x for c in values for x in (c, ""))[:-1]
    src = write_raw_lines(line, header, table(spark, sf_dir, "orders"), scratch_path(spark, "raw_balance"))
    bad, vault = scratch_path(spark, "balance_bad"), scratch_path(spark, "balance_vault")
    silver = jobs.silver_employees(spark, src, scratch_path(spark, "balance_silver"), vault, AS_OF, KEY,
                                   quarantine=bad, strict=False).silver
    lines = read_table(spark, f"{vault}_rejected").select("cpf_encrypted", "_wide_line")
    rejected = read_table(spark, bad).join(lines, "cpf_encrypted")
    text = (f"concat_ws('|', array_join(map_values({quality.UNCAST_COLUMN}), '|'), "
            "CAST(length(_wide_line) AS STRING), right(_wide_line, 4))")
    return _balanced("employees", silver, "hr_id").unionByName(
        _balanced("employees", rejected, "hr_id", quality.FAILED_COLUMN, text))


def _customers_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    cells = [F.col("c_name"),
             F.when(k % 7 == 0, F.lit("10.999")).when(k % 11 == 0, F.lit("99999999999999999999"))
             .otherwise((k * 10).cast("string")),
             F.when(k % 13 == 0, F.lit("five")).otherwise((k % 90 + 1).cast("string")), F.lit("OPV"),
             F.when(k % 19 == 0, F.lit("AB-99")).otherwise(F.lpad(k.cast("string"), 8, "0")),
             F.when(k % 17 == 0, F.lit("2019-03-15")).otherwise(F.lit("15/03/2019")), (k % 4 + 1).cast("string")]
    extra = F.when(k % 23 == 0, F.concat(F.lit(';"'), F.repeat(F.lit("x;"), _LONG_REPEATS), F.lit('";lost')))
    line = F.concat(F.concat_ws(E.CUSTOMERS_SEP, *cells), F.lit(";" * E.CUSTOMERS_OVERFLOW),
                    F.coalesce(extra, F.lit("")))
    header = E.CUSTOMERS_SEP.join(E.CUSTOMERS_COLUMNS) + ";" * E.CUSTOMERS_OVERFLOW
    src = write_raw_lines(line, header, table(spark, sf_dir, "customer"), scratch_path(spark, "raw_balance"))
    bad = scratch_path(spark, "balance_bad")
    silver = jobs.silver_customers(spark, src, scratch_path(spark, "balance_silver"), quarantine=bad,
                                   strict=False).silver
    names = [*E.CUSTOMERS_COLUMNS, "_wide_line"]
    cut = F.from_json("row", ", ".join(f"`{c}` string" for c in names)).alias("cell")
    rejected = read_table(spark, bad).select(quality.FAILED_COLUMN, cut)
    shown = ", ".join(f"cell.`{c}`" for c in names[1:3] + names[4:6])
    text = f"concat_ws('|', {shown}, CAST(length(cell._wide_line) AS STRING))"
    return _balanced("customers", silver, "customer").unionByName(
        _balanced("customers", rejected, "cell.Cliente", quality.FAILED_COLUMN, text))


def _levels_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    level = F.when(k % 5 == 0, F.lit("Presidente")).when(k % 7 != 0, F.lit(E.LEVELS[1])).otherwise(F.lit(""))
    extra = F.when(k % 11 == 0, F.lit("%lost")).otherwise(F.lit(""))
    line = F.concat(F.concat_ws(E.LEVELS_SEP, k.cast("string"), level, F.lit("3")), extra)
    src = write_raw_lines(line, E.LEVELS_SEP.join(E.LEVELS_RENAME), table(spark, sf_dir, "part"),
                          scratch_path(spark, "raw_balance"))
    bad = scratch_path(spark, "balance_bad")
    silver = jobs.silver_levels(spark, src, scratch_path(spark, "balance_silver"), quarantine=bad).silver
    text = "concat_ws('|', level_description, _wide_line)"
    return _balanced("levels", silver, "level").unionByName(
        _balanced("levels", read_table(spark, bad), "level", quality.FAILED_COLUMN, text))


def row_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw row comes out once, in silver or in quarantine, there with the text that was wrong:
    numbers too large or with too many decimals, dates and codes that are none, lines with a long
    quoted cell and one more behind the last column, levels that are not allowed."""
    jobs_of = (_employees_balance, _customers_balance, _levels_balance)  # independent: side by side
    with ThreadPoolExecutor(len(jobs_of)) as pool:
        parts = list(pool.map(lambda f: f(spark, sf_dir), jobs_of))
    return reduce(DataFrame.unionByName, parts)


# Lengths: two quotes, a separator before the cell, "|lost" behind it.
_EXTRA_LENGTH = 2 * _LONG_REPEATS + len('|""|lost')
_EMPLOYEE_FIXED = len(E.EMPLOYEES_RENAME) - 8  # cells that hold an x

ROW_BALANCE_SQL = f"""WITH e AS (
  SELECT o_orderkey AS k, date_diff('day', DATE '{EXCEL_EPOCH}', CAST(o_orderdate AS DATE)) AS hire FROM orders),
ef AS (
  SELECT k, concat_ws(',', CASE WHEN k % 101 = 0 THEN 'is_null(_wide_line)' END,
           CASE WHEN k % 97 = 0 THEN 'castable(termination_date)' END,
           CASE WHEN k % 71 = 0 THEN 'castable(base_salary)' END,
           CASE WHEN k % 83 = 0 OR k % 79 = 0 THEN 'castable(taxes)' END) AS failed,
         CASE WHEN k % 97 = 0 THEN '12d' END AS d, CASE WHEN k % 71 = 0 THEN '7.005' END AS s,
         CASE WHEN k % 83 = 0 THEN '99999999999999999999' WHEN k % 79 = 0 THEN '1.239' END AS t,
         {_EMPLOYEE_FIXED} + 2 * (len(CAST(k AS VARCHAR))) + len(CAST(k AS VARCHAR)) + 1
           + 5 + len(CAST(hire AS VARCHAR)) + CASE WHEN k % 97 = 0 THEN 3 ELSE 0 END
           + CASE WHEN k % 71 = 0 THEN 5 ELSE 7 END
           + CASE WHEN k % 83 = 0 THEN 20 WHEN k % 79 = 0 THEN 5 ELSE 3 END
           + {2 * len(E.EMPLOYEES_RENAME) - 2} + {_EXTRA_LENGTH} AS line_length
  FROM e),
c AS (
  SELECT c_custkey AS k, c_name,
         CASE WHEN c_custkey % 7 = 0 THEN '10.999' WHEN c_custkey % 11 = 0 THEN '99999999999999999999'
              ELSE CAST(c_custkey * 10 AS VARCHAR) END AS v,
         CASE WHEN c_custkey % 13 = 0 THEN 'five' ELSE CAST(c_custkey % 90 + 1 AS VARCHAR) END AS n,
         CASE WHEN c_custkey % 19 = 0 THEN 'AB-99' ELSE lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS cep,
         CASE WHEN c_custkey % 17 = 0 THEN '2019-03-15' ELSE '15/03/2019' END AS d
  FROM customer),
cf AS (
  SELECT *, CASE WHEN k % 23 = 0 THEN 'too many cells' ELSE concat_ws(',',
    CASE WHEN k % 7 = 0 OR k % 11 = 0 THEN 'castable(annual_contract_value)' END,
    CASE WHEN k % 13 = 0 THEN 'castable(number_of_services)' END,
    CASE WHEN k % 19 = 0 THEN 'castable(cep)' END,
    CASE WHEN k % 17 = 0 THEN 'castable(contract_start_date)' END,
    CASE WHEN k % 7 = 0 OR k % 11 = 0 THEN 'not_null(annual_contract_value)' END,
    CASE WHEN k % 13 = 0 THEN 'not_null(number_of_services)' END,
    CASE WHEN k % 17 = 0 THEN 'not_null(contract_start_date)' END) END AS failed,
    CASE WHEN k % 23 = 0 THEN CAST(len(c_name) + len(v) + len(n) + 3 + len(cep) + len(d) + 1 + 6
      + {E.CUSTOMERS_OVERFLOW} + {_EXTRA_LENGTH} AS VARCHAR) END AS line_length
  FROM c),
l AS (
  SELECT p_partkey AS k, CASE WHEN p_partkey % 5 = 0 THEN 'Presidente' WHEN p_partkey % 7 <> 0 THEN '{E.LEVELS[1]}'
         END AS level FROM part),
lf AS (
  SELECT *, CASE WHEN k % 11 = 0 THEN 'too many cells' WHEN level IS NULL OR level = 'Presidente'
         THEN 'in_set(level_description)' ELSE '' END AS failed FROM l)
SELECT 'employees' AS entity, CAST(k AS VARCHAR) AS row_id, failed AS failed_rules,
       CASE WHEN failed <> '' THEN concat_ws('|', concat_ws('|', d, s, t),
         CASE WHEN k % 101 = 0 THEN CAST(line_length AS VARCHAR) END, CASE WHEN k % 101 = 0 THEN 'lost' END) END AS raw
FROM ef
UNION ALL
SELECT 'customers', c_name, failed, CASE WHEN failed <> '' THEN concat_ws('|', v, n, cep, d, line_length) END FROM cf
UNION ALL
SELECT 'levels', CAST(k AS VARCHAR), failed, CASE WHEN failed <> '' THEN concat_ws('|', level,
  CASE WHEN k % 11 = 0 THEN CAST(k AS VARCHAR) || '%' || coalesce(level, '') || '%3%lost' END) END FROM lf"""


# ------------------------------------------------------------- broken lines


def stitched_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5 with every fifth line broken in two, in files of several blocks: all customers come back."""
    k = F.col("c_custkey")
    head = F.concat_ws(";", "c_name", (k * 10).cast("string"), (k % 90 + 1).cast("string"), F.lit(""))
    tail = F.concat_ws(";", F.lit("OPV"), F.lpad(k.cast("string"), 8, "0"), F.lit("15/03/2019"),
                       (k % 4 + 1).cast("string"), F.lit(";" * (E.CUSTOMERS_OVERFLOW - 1)))
    lines = F.when(k % 5 == 0, F.array(head, tail)).otherwise(F.array(F.concat(head, tail)))
    rows = table(spark, sf_dir, "customer").select(F.explode(lines).alias("line"))
    header = E.CUSTOMERS_SEP.join(E.CUSTOMERS_COLUMNS) + ";" * E.CUSTOMERS_OVERFLOW
    src = write_raw_lines(F.col("line"), header, rows, scratch_path(spark, "raw_broken"))
    done = jobs.silver_customers(spark, src, scratch_path(spark, "job_stitched"), stitch=True)
    return done.silver.select(
        "customer", F.col("annual_contract_value").cast("double").alias("annual_contract_value"),
        "responsible_position", "cep", "importance_level", F.lit(done.quarantined).cast("bigint").alias("quarantined"))


STITCHED_SQL = """
SELECT c_name AS customer, CAST(c_custkey * 10 AS DOUBLE) AS annual_contract_value, 'OPV' AS responsible_position,
       lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS cep, CAST(c_custkey % 4 + 1 AS INTEGER) AS importance_level,
       CAST(0 AS BIGINT) AS quarantined
FROM customer"""


# ---------------------------------------------------------- publish and merge


def staged_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1, K6: a run that fails after it has written leaves the table as it was; the next one replaces it."""
    path = scratch_path(spark, "published")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")

    def now(step: str) -> DataFrame:
        schema = read_table(spark, path).schema
        found = spark.read.schema(schema).parquet(path).agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("keys")).first()
        return spark.range(1).select(F.lit(step).alias("step"), F.lit(found["n_rows"]).alias("n_rows"),
                                     F.lit(found["keys"]).cast("bigint").alias("keys"))

    with publishing(spark) as stage:
        write_table(orders, stage(path))
    states = [now("first")]
    rules = [quality.between("o_custkey", 0, 0)]
    try:
        with publishing(spark) as stage:
            write_table(orders.limit(0), stage(path))
            quality.assert_quality(quality.collect_report(quality.quality_report(orders, rules)))
    except quality.QualityError:
        states.append(now("stopped"))
    with publishing(spark) as stage:
        write_table(orders.withColumn("o_orderkey", F.col("o_orderkey") + 1), stage(path))
    states.append(now("second"))
    return reduce(DataFrame.unionByName, states)


STAGED_PUBLISH_SQL = """WITH t AS (SELECT count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS s FROM orders)
SELECT 'first' AS step, n AS n_rows, s AS keys FROM t
UNION ALL SELECT 'stopped', n, s FROM t
UNION ALL SELECT 'second', n, s + n FROM t"""

# The second drop holds orders from this day on.
CUT = "2001-01-01"


def merged_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2, K3: a second drop brings new orders, changed ones and some that move to another month;
    only the months concerned are rewritten."""
    path = scratch_path(spark, "merged_months")
    k = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select(
        k, F.col("o_orderdate").cast("date").alias("hire_date"), F.lit(1).alias("version"))
    first = orders.filter(~((k % 3 == 0) & (F.col("hire_date") >= CUT)))
    late = orders.filter((F.col("hire_date") >= CUT) & ((k % 3 == 0) | (k % 7 == 0)))
    moved = F.when(k % 14 == 0, F.date_add("hire_date", -400)).otherwise(F.col("hire_date"))
    second = late.withColumns({"hire_date": moved, "version": F.lit(2)})
    written_at = F.max("_metadata.file_modification_time").alias("at")
    merge_by_month(first, "hire_date", path, ["o_orderkey"], FIRST_RUN)
    before = read_table(spark, path).agg(written_at).first()["at"]
    merge_by_month(second, "hire_date", path, ["o_orderkey"], SECOND_RUN)
    by = month_columns("hire_date")
    return read_table(spark, path).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("keys"),
        F.sum("version").cast("bigint").alias("versions"), written_at).withColumn(
        "rewritten", F.col("at") > F.lit(before)).drop("at")


MERGED_MONTHS_SQL = f"""WITH o AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d FROM orders),
late AS (SELECT k, d, CASE WHEN k % 14 = 0 THEN d - 400 ELSE d END AS new_d FROM o
         WHERE d >= DATE '{CUT}' AND (k % 3 = 0 OR k % 7 = 0)),
m AS (
  SELECT o.k, CASE WHEN late.k IS NULL THEN 1 ELSE 2 END AS version, coalesce(late.new_d, o.d) AS d
  FROM o LEFT JOIN late ON late.k = o.k),
-- months of the new rows, and those that a replaced row leaves
touched AS (SELECT date_trunc('month', new_d) AS t FROM late
            UNION SELECT date_trunc('month', d) FROM late WHERE k % 3 <> 0)
SELECT CAST(year(d) AS INTEGER) AS year_hire_date, CAST(month(d) AS INTEGER) AS month_hire_date,
       count(*) AS n_rows, CAST(sum(k) AS BIGINT) AS keys, CAST(sum(version) AS BIGINT) AS versions,
       date_trunc('month', any_value(d)) IN (SELECT t FROM touched) AS rewritten
FROM m GROUP BY 1, 2"""


# ------------------------------------------------------------------- privacy


def token_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1, K4: equal numbers in different fields have different tokens; a table re-keyed through the vault
    has the tokens that the new key would have given."""
    k = F.col("c_custkey")
    people = table(spark, sf_dir, "customer").select(
        "c_custkey", k.cast("string").alias("cpf"),
        F.when(k % 5 == 0, k.cast("string")).otherwise(F.col("c_name")).alias("id_card_number_rg"))
    vault = privacy.pseudonymize(people, E.TOKENS, KEY)
    public = vault.drop("cpf", "id_card_number_rg")
    fresh, crosswalk = privacy.rotate(vault.drop("c_custkey"), E.TOKENS, NEXT_KEY)
    rotated = privacy.apply_rotation(public, crosswalk, E.TOKENS, NEXT_KEY)
    back = privacy.reidentify(rotated, fresh, "cpf_encrypted", ["cpf", "id_card_number_rg"])
    return back.select(
        "c_custkey", "cpf_encrypted", "rg_encrypted", key_id_of("cpf_encrypted").alias("key_id"),
        (F.col("cpf") == F.col("id_card_number_rg")).alias("same_number"),
        (F.col("cpf_encrypted") == F.col("rg_encrypted")).alias("same_token"))


TOKEN_ROTATION_SQL = f"""WITH p AS (
  SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS cpf,
         CASE WHEN c_custkey % 5 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE c_name END AS rg FROM customer)
SELECT c_custkey, {token_sql('cpf', 'cpf', NEXT_KEY)} AS cpf_encrypted,
       {token_sql('rg', 'id_card_number_rg', NEXT_KEY)} AS rg_encrypted, '{NEXT_KEY.key_id}' AS key_id,
       cpf = rg AS same_number, false AS same_token
FROM p"""


def vault_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4, U3: two drops that share people leave one row each, the newer one; an erased person is gone."""
    k = F.col("c_custkey")
    people = privacy.pseudonymize(table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_name").alias("full_name")), {"c_custkey": "cpf_encrypted"}, KEY)
    path = scratch_path(spark, "kept_vault")
    privacy.merge_vault(people.filter(k % 3 != 0), path, "cpf_encrypted", FIRST_RUN)
    newer = people.filter(k % 2 == 0).withColumn("full_name", F.concat("full_name", F.lit(" new")))
    privacy.merge_vault(newer.unionByName(newer), path, "cpf_encrypted", SECOND_RUN)
    privacy.erase(people.filter(k % 40 == 7).select("cpf_encrypted"), path, "cpf_encrypted")
    return read_table(spark, path).select("c_custkey", "full_name", "cpf_encrypted",
                                          (F.col("created_at") == SECOND_RUN).alias("newer"))


VAULT_MERGE_SQL = f"""
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name || ' new' ELSE c_name END AS full_name,
       {token_sql('c_custkey', 'c_custkey')} AS cpf_encrypted, c_custkey % 2 = 0 AS newer
FROM customer WHERE (c_custkey % 3 <> 0 OR c_custkey % 2 = 0) AND c_custkey % 40 <> 7"""


# ------------------------------------------------------------ partial states


def kept_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1-A5, E7 from states kept per month (``jobs.gold_from_states``), after the last month was made
    again alone: means are exact, headcounts lie within five standard errors of the exact ones."""
    paths = derived_silver(spark, sf_dir)
    states = scratch_path(spark, "states")
    jobs.update_states(spark, paths["employees"], states)
    month = month_columns("hire_date")
    # one number per month: the largest struct would be sought row by row, without generated code
    year, of_year = (F.col(c) for c in month)
    last = read_table(spark, paths["employees"]).agg(F.max(year * 100 + of_year).alias("at")).first()["at"]
    jobs.update_states(spark, paths["employees"], states,
                       months=[(None, None) if last is None else divmod(last, 100)])
    kept = long_marts(jobs.gold_from_states(spark, paths["postal"], paths["positions"], states,
                                            scratch_path(spark, "state_marts")))
    exact = long_marts(jobs.gold(spark, paths["postal"], paths["employees"], paths["positions"],
                                 scratch_path(spark, "marts")))
    by = [c for c in exact.columns if c not in (marts.HEADCOUNT, marts.MEAN_YEARS)]
    same = reduce(lambda a, b: a & b, [kept[c].eqNullSafe(exact[c]) for c in by])
    error = F.abs(kept[marts.HEADCOUNT] - exact[marts.HEADCOUNT])
    close = F.coalesce(error <= 5 * partials.STANDARD_ERROR * exact[marts.HEADCOUNT], F.lit(True))
    return kept.join(exact, same).select(*[kept[c] for c in by], kept[marts.MEAN_YEARS], close.alias("close"))


# Groups and exact means of the gold job's marts.
KEPT_STATES_SQL = f"""
SELECT mart, region, level_description, generation, area, {marts.MEAN_YEARS}, true AS close
FROM ({GOLD_SQL["gold_job"]})"""


# -------------------------------------------------------------- marts, bands


def ranked_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: the order of a mart as its files hold it."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    mart = marts.ranked(marts.headcount(customer, ["c_nationkey", "c_mktsegment"], "c_custkey"), marts.HEADCOUNT)
    path = scratch_path(spark, "ranked_mart")
    write_table(mart, path)
    # files are named in order, rows are numbered inside them; a mart has few rows
    order = Window.orderBy("_metadata.file_name", "_metadata.row_index")
    return spark.read.parquet(path).select(
        "c_nationkey", "c_mktsegment", marts.HEADCOUNT, F.row_number().over(order).cast("bigint").alias("place"))


RANKED_MART_SQL = f"""WITH t AS (
  SELECT c_nationkey, c_mktsegment, count(DISTINCT c_custkey) AS {marts.HEADCOUNT} FROM customer GROUP BY 1, 2)
SELECT *, row_number() OVER (ORDER BY {marts.HEADCOUNT} DESC, c_nationkey, c_mktsegment) AS place FROM t"""


def null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1, J2: a third of the rows has no key; they keep their place without meeting in one task."""
    k = F.col("o_orderkey")
    fact = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(k % 3 != 0, F.col("o_custkey")).alias("c_custkey"))
    dim = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return marts.lookup(fact, dim, "c_custkey").groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("c_custkey").alias("with_key"))


NULL_KEYS_SQL = """WITH f AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS k FROM orders)
SELECT c_mktsegment, count(*) AS n_rows, count(k) AS with_key
FROM f LEFT JOIN customer ON c_custkey = k GROUP BY c_mktsegment"""


def banded_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X13: bands kept as a table (here made of regions), checked, then joined by interval."""
    low = F.col("r_regionkey") * 9
    bands = table(spark, sf_dir, "region").select(
        F.col("r_name").alias(banding.NAME), low.alias(banding.FROM), (low + 8).alias(banding.TO))
    return banding.with_band(table(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_size", bands, "band")


BANDED_PARTS_SQL = f"""
SELECT p_partkey, p_size, coalesce(r_name, '{UNKNOWN}') AS band
FROM part LEFT JOIN region ON p_size BETWEEN r_regionkey * 9 AND r_regionkey * 9 + 8"""


QUERIES: dict[str, Query] = {
    "row_balance": row_balance,
    "stitched_customers": stitched_customers,
    "staged_publish": staged_publish,
    "merged_months": merged_months,
    "token_rotation": token_rotation,
    "vault_merge": vault_merge,
    "kept_states": kept_states,
    "ranked_mart": ranked_mart,
    "null_keys": null_keys,
    "banded_parts": banded_parts,
}

ORACLE_SQL: dict[str, str] = {
    "row_balance": ROW_BALANCE_SQL,
    "stitched_customers": STITCHED_SQL,
    "staged_publish": STAGED_PUBLISH_SQL,
    "merged_months": MERGED_MONTHS_SQL,
    "token_rotation": TOKEN_ROTATION_SQL,
    "vault_merge": VAULT_MERGE_SQL,
    "kept_states": KEPT_STATES_SQL,
    "ranked_mart": RANKED_MART_SQL,
    "null_keys": NULL_KEYS_SQL,
    "banded_parts": BANDED_PARTS_SQL,
}
