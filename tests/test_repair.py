from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from staffmart.operators import repair
from staffmart.plans import entities as E
from staffmart.plans.jobs import CUSTOMER_VALIDATORS, shape_positions

POS_COLS = E.POSITIONS_COLUMNS + ["_c8"]


def positions_frame(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in POS_COLS))


def test_positions_shifted_row_is_realigned(spark):
    df = positions_frame(spark, [
        ("LOIV", None, "Gerente", "Logísitca", "EDE", "ID", "Efetivo", "S", "Diretoria"),
        ("OPI", "Estagiário", "@@@Operações", "JAJ", "JA", "Efetivo", "N", "Gerente", None),
        ("LOIII", "Coordenador", "Logísitca", "   EDE", "DB", "Terceiro", "N", "RH", None),
    ])
    rows = {r["Cargo"]: r.asDict() for r in shape_positions(df).collect()}
    assert rows["LOIV"] == {"Cargo": "LOIV", "Nível": "Gerente", "Área": "Logística",
                            "COD Área": "EDE", "COD Nível": "ID", "Quadro": "Efetivo",
                            "Bonus": "S", "Contratacao": "Diretoria",
                            repair.STATUS_COLUMN: repair.REPAIRED}
    assert rows["OPI"]["Área"] == "Operações" and rows["OPI"][repair.STATUS_COLUMN] == 0
    assert rows["LOIII"]["COD Área"] == "   EDE" and rows["LOIII"]["Área"] == "Logística"


CUST_COLS = E.CUSTOMERS_COLUMNS + [f"_c{i}" for i in range(7, 12)]


def customers_frame(spark, lines):
    rows = []
    for line in lines:
        cells = [c if c != "" else None for c in line.split(";")]
        cells = (cells + [None] * len(CUST_COLS))[:len(CUST_COLS)]
        rows.append(tuple(cells))
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in CUST_COLS))


def test_customer_gaps_at_any_column(spark):
    df = customers_frame(spark, [
        "Santos Costa;252000;;64;FIIV;430169311;10/03/2019;2;;;;",
        "Nunes Cintra;72000;79;;LOII;155016697;09/02/2019;3;;;;",
        "Americo Bomfim;;157500;59;LOIV;494498526;14/03/2019;3;;;;",
        "Teixeira Gonçalves;54000;37;ADIII;743419711;15/03/2019;3;;;;",
        "Maria Dantas;135000;61;;;;;;;;;",
    ])
    out = repair.realign(df, E.CUSTOMERS_COLUMNS, CUST_COLS[7:], CUSTOMER_VALIDATORS)
    got = {r["Cliente"]: tuple(r)[1:] for r in out.collect()}
    assert got["Santos Costa"] == ("252000", "64", "FIIV", "430169311", "10/03/2019", "2", 1)
    assert got["Nunes Cintra"] == ("72000", "79", "LOII", "155016697", "09/02/2019", "3", 1)
    assert got["Americo Bomfim"] == ("157500", "59", "LOIV", "494498526", "14/03/2019", "3", 1)
    assert got["Teixeira Gonçalves"][-1] == repair.CLEAN
    # an unshifted row keeps its legitimately empty cells
    assert got["Maria Dantas"] == ("135000", "61", None, None, None, None, repair.CLEAN)


def test_validators_pick_the_gap_when_a_row_has_two_empty_cells(spark):
    # The real gap is before services; the importance cell is legitimately empty.
    df = customers_frame(spark, ["Do Monteiro;351000;;19;OPV;839424894;31/01/2019;;x"])
    df = df.withColumn("_c7", F.lit("3")).withColumn("_c8", F.lit(None).cast("string"))
    out = repair.realign(df, E.CUSTOMERS_COLUMNS, CUST_COLS[7:], CUSTOMER_VALIDATORS).first()
    assert out["Quantidade de Serviços"] == "19" and out["CEP"] == "839424894"
    assert out["Data Início Contrato"] == "31/01/2019"


def test_two_gaps_or_no_gap_are_left_for_quarantine(spark):
    df = customers_frame(spark, [
        "A;;;10;OPV;839424894;31/01/2019;3;2;;;",     # two gaps: two overflow cells filled
        "B;1;2;OPV;839424894;31/01/2019;3;9;;;;",     # extra cell but no gap
    ])
    out = repair.realign(df, E.CUSTOMERS_COLUMNS, CUST_COLS[7:], CUSTOMER_VALIDATORS)
    got = {r["Cliente"]: r for r in out.collect()}
    assert got["A"][repair.STATUS_COLUMN] == repair.UNREPAIRED
    assert got["B"][repair.STATUS_COLUMN] == repair.UNREPAIRED
    assert got["B"]["Valor Contrato Anual"] == "1"      # cells untouched
    assert "_c7" not in out.columns


def test_shift_with_an_empty_last_cell_and_ambiguous_gaps(spark):
    df = positions_frame(spark, [
        ("LOIV", None, "Gerente", "Logística", "EDE", "ID", "Efetivo", "S", None),
        ("OPV", "Diretor", "Operações", None, "JAJ", None, "Efetivo", "S", "Diretoria"),
        ("XA", "Analista", "Op", "AAA", "BB", None, "S", None, "Gerente"),
        ("XB", "Analista", "Op", "AAA", None, "Efetivo", "S", "RH", None),
    ])
    rows = {r["Cargo"]: tuple(r)[1:] for r in shape_positions(df).collect()}
    assert rows["LOIV"] == ("Gerente", "Logística", "EDE", "ID", "Efetivo", "S", None, repair.REPAIRED)
    # either empty cell may be the extra one: left as it is, for quarantine
    assert rows["OPV"] == ("Diretor", "Operações", None, "JAJ", None, "Efetivo", "S",
                           repair.UNREPAIRED)
    # only the later gap leaves every value where it may stand
    assert rows["XA"] == ("Analista", "Op", "AAA", "BB", None, "S", "Gerente", repair.REPAIRED)
    # an empty cell alone is no shift
    assert rows["XB"] == ("Analista", "Op", "AAA", None, "Efetivo", "S", "RH", repair.CLEAN)


def test_truncated_rows_realign_without_overflow(spark):
    v = {"a": lambda c: c.rlike("^[a-z]+$"), "n": lambda c: c.rlike(r"^\d+$"),
         "d": lambda c: c.rlike(r"^\d\d/\d\d$")}
    df = spark.createDataFrame([("x", None, "12"), ("y", "7", "01/02"), ("z", None, None)],
                               "a string, n string, d string")
    # row x: 'n' empty and '12' is a number sitting under 'd' -> shifted.
    out = {r["a"]: tuple(r) for r in repair.realign(df, ["a", "n", "d"], (), v).collect()}
    assert out["x"] == ("x", "12", None, repair.REPAIRED)
    assert out["y"] == ("y", "7", "01/02", repair.CLEAN)
    assert out["z"] == ("z", None, None, repair.CLEAN)


def test_fill_from_right_cascade(spark):
    df = spark.createDataFrame([(None, "Gerente", "Gerente", "EDE"), ("A", None, "B", None),
                                ("A", "B", "C", "D")], "w string, x string, y string, z string")
    out = [tuple(r) for r in repair.fill_from_right(df, ["w", "x", "y", "z"]).collect()]
    assert out[0] == ("Gerente", "Gerente", "EDE", None)
    assert out[1] == ("A", "B", None, None)
    assert out[2] == ("A", "B", "C", "D")


text = st.text(alphabet="abcXYZ09 ", min_size=1, max_size=6)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(text, text, text, text, st.integers(0, 3)), min_size=1, max_size=12))
def test_realign_undoes_a_single_shift(spark, rows):
    cols = ["a", "b", "c", "d"]
    shifted = []
    for a, b, c, d, gap in rows:
        cells = [a, b, c, d]
        shifted.append(tuple(cells[:gap] + [None] + cells[gap:]))
    df = spark.createDataFrame(shifted, "a string, b string, c string, d string, _c4 string")
    out = repair.realign(df, cols, ["_c4"]).select(*cols)
    assert sorted(tuple(r) for r in out.collect()) == sorted(tuple(r[:4]) for r in rows)


def cascade_model(row):
    """Plain-Python statement of the ordered cascade: for each neighbour pair
    in turn, fill the left cell from the right one, then clear the right cell
    when it repeats the left one."""
    cells = list(row)
    for i in range(len(cells) - 1):
        if cells[i] is None:
            cells[i] = cells[i + 1]
        if cells[i + 1] is not None and cells[i + 1] == cells[i]:
            cells[i + 1] = None
    return tuple(cells)


cell = st.one_of(st.none(), st.sampled_from(["A", "B", "C"]))


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(cell, cell, cell, cell), min_size=1, max_size=15))
def test_fill_from_right_matches_the_cascade_model(spark, rows):
    df = spark.createDataFrame(rows, "w string, x string, y string, z string")
    def key(t):
        return tuple(map(str, t))
    got = sorted((tuple(r) for r in repair.fill_from_right(df, ["w", "x", "y", "z"]).collect()),
                 key=key)
    assert got == sorted((cascade_model(r) for r in rows), key=key)
