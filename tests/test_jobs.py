"""End-to-end runs of the six silver jobs and the gold job on small raw files."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from conftest import write_lines
from pyspark.sql import functions as F

from staffmart.operators import quality
from staffmart.plans import entities as E
from staffmart.plans import jobs
from staffmart.sources import merge_by_month, publishing, read_table, write_by_month

AS_OF = "2024-01-01"
SECRET = "test-secret"
EPOCH = dt.date(1899, 12, 30)


def serial(d: dt.date | None) -> str:
    return "" if d is None else str((d - EPOCH).days)


POSITIONS = [
    "Cargo;Nível;Área;COD Área;COD Nível;Quadro;Bonus;Contratacao",
    "OPV;Diretor;Operações;   JAJ;JE;Efetivo;S;Diretoria",
    "LOI;Estagiário;Logísitca;EDE;JA;Efetivo;N;Gerente",
    "LOIV;;Gerente;Logísitca;EDE;ID;Efetivo;S;Diretoria",
    "OPI;Estagiário;@@@Operações;JAJ;JA;Efetivo;N;Gerente",
    "FIIV;;Gerente;Financeiro;CBB;ID;Efetivo;S;Diretoria",
]

POSTAL = [
    "CEP|Estado|Região",
    "20125535|Mato Grosso|Centro - Oeste",
    "25995770||Rio Grande do Norte|Nordeste",
    "37278465|Sergipe|Nordeste",
]

CUSTOMERS = [
    "Cliente;Valor Contrato Anual;Quantidade de Serviços;Cargo Responsável;CEP;"
    "Data Início Contrato;Nivel de Importancia;;;;;",
    "Teixeira Gonçalves;54000;37;ADIII;743419711;15/03/2019;3;;;;;",
    "Santos Costa;252000;;64;FIIV;430169311;10/03/2019;2;;;;;",
    "Maria Dantas;135000;61;",
    "OPV;615313104;05/04/2019;1;;;;;",
    "",
    "Fernandes ;193500;27;LOIV;281478967;19/03/2019;4;;;;;",
    "Nunes Cintra;72000;79;;LOII;155016697;09/02/2019;3;;;;;",
    "Americo Bomfim;;157500;59;LOIV;494498526;14/03/2019;3;;;;;",
]


def employee_file(tmp_path, people):
    names = list(E.EMPLOYEES_RENAME)
    header = "|".join(x for n in names for x in (n, ""))[:-1]
    lines = [header]
    for p in people:
        values = {
            "ID RH": p["hr"], "RG": p.get("rg", f"RG{p['hr']}"), "CPF": p.get("cpf", ""),
            "Ramal": "100", "Estado Civil": "S", "Nome Completo": f"Pessoa {p['hr']}",
            "Login": f"p{p['hr']}", "Data de Nascimento": serial(p["birth"]), "CEP": p["cep"],
            "Data de Contratacao": serial(p["hire"]), "Data de Demissao": serial(p.get("term")),
            "Dias Uteis Trabalhados Ano Orcamentario": "250",
            "Salario Base": p.get("salary", "5000.00"), "Impostos": p.get("taxes", "500.5"),
            "Beneficios": "10", "VT": "1", "VR": "2", "Cargo": p["pos"], "Bandeira": "A",
            "Codigos": "C", "Quantidade de Acessos": "3", "Ferias Acumuladas": "0",
            "Ferias Remuneradas": "0", "Horas Extras": "0", "Valores Adicionais": "0",
            "ID de Pessoal": "P", "ID da area": "A",
        }
        lines.append("|".join(x for n in names for x in (values[n], ""))[:-1])
    return write_lines(tmp_path, "employees.csv", lines)


CLEAN_PEOPLE = [
    dict(hr="1", cpf="11111111111", birth=dt.date(1990, 5, 10), cep="20125535",
         hire=dt.date(2015, 1, 1), pos="OPV"),
    dict(hr="2", cpf="22222222222", birth=dt.date(2000, 2, 29), cep="25995770",
         hire=dt.date(2020, 1, 1), term=dt.date(2022, 1, 1), pos="LOIV"),
    dict(hr="3", cpf="33333333333", birth=dt.date(1960, 1, 1), cep="99999999",
         hire=dt.date(2010, 6, 15), pos="XXX"),
    dict(hr="4", cpf="44444444444", birth=dt.date(1975, 12, 31), cep="20125535",
         hire=dt.date(2023, 12, 1), pos="LOIV", taxes="12."),
]


def test_positions_job(spark, tmp_path):
    src = write_lines(tmp_path, "positions.csv", POSITIONS)
    res = jobs.silver_positions(spark, src, str(tmp_path / "positions_out"),
                                quarantine=str(tmp_path / "q"))
    rows = {r["level"]: r for r in res.silver.collect()}
    assert len(rows) == 5 and res.quarantined == 0
    assert set(res.silver.columns) == set(E.POSITIONS_RENAME.values()) | {"created_at"}
    assert tuple(rows["LOIV"][c] for c in ["level_description", "area", "cod_area", "cod_level",
                                           "quadro", "bonus", "hiring"]) == \
        ("Gerente", "Logística", "EDE", "ID", "Efetivo", "S", "Diretoria")
    assert rows["FIIV"]["hiring"] == "Diretoria" and rows["OPI"]["area"] == "Operações"
    assert rows["OPV"]["cod_area"] == "   JAJ"


def test_postal_job_drops_header_row(spark, tmp_path):
    src = write_lines(tmp_path, "postal.csv", POSTAL)
    res = jobs.silver_postal(spark, src, str(tmp_path / "postal_out"))
    rows = sorted((r["cep"], r["state"], r["region"]) for r in res.silver.collect())
    assert rows == [("20125535", "Mato Grosso", "Centro - Oeste"),
                    ("25995770", "Rio Grande do Norte", "Nordeste"),
                    ("37278465", "Sergipe", "Nordeste")]


def test_customers_job(spark, tmp_path):
    src = write_lines(tmp_path, "customers.csv", CUSTOMERS)
    res = jobs.silver_customers(spark, src, str(tmp_path / "customers_out"),
                                quarantine=str(tmp_path / "q"))
    rows = {r["customer"]: r for r in res.silver.collect()}
    assert len(rows) == 5 and res.quarantined == 2             # both halves of the broken line
    assert all(r["success"] for r in res.report)
    s = rows["Santos Costa"]
    assert (float(s["annual_contract_value"]), s["number_of_services"], s["responsible_position"],
            s["cep"], s["contract_start_date"], s["importance_level"]) == \
        (252000.0, 64, "FIIV", "430169311", dt.date(2019, 3, 10), 2)
    b = rows["Americo Bomfim"]
    assert (float(b["annual_contract_value"]), b["number_of_services"], b["cep"]) == \
        (157500.0, 59, "494498526")
    assert rows["Nunes Cintra"]["responsible_position"] == "LOII"
    assert "Fernandes " in rows                               # trailing space kept
    assert {"year_contract_start_date", "month_contract_start_date"} <= set(res.silver.columns)


def test_customers_gate_stops_the_line(spark, tmp_path):
    bad = CUSTOMERS + ["Souza Santos;126000;12;FIIV;882467283;08/04/2019;7;;;;;"]
    src = write_lines(tmp_path, "customers.csv", bad)
    with pytest.raises(quality.QualityError, match="in_set"):
        jobs.silver_customers(spark, src, str(tmp_path / "out"), quarantine=str(tmp_path / "q"))
    res = jobs.silver_customers(spark, src, str(tmp_path / "out2"),
                                quarantine=str(tmp_path / "q2"), strict=False)
    assert res.silver.count() == 5 and res.quarantined == 3


def run_employees(spark, tmp_path, people, strict=True):
    src = employee_file(tmp_path, people)
    return jobs.silver_employees(spark, src, str(tmp_path / "employees_out"),
                                 str(tmp_path / "vault"), AS_OF, SECRET,
                                 quarantine=str(tmp_path / "q"), strict=strict)


def test_employees_job(spark, tmp_path):
    res = run_employees(spark, tmp_path, CLEAN_PEOPLE)
    silver = res.silver
    expected = {"hr_id", "extension", "marital_status", "birth_date", "cep", "hire_date",
                "termination_date", "workdays_in_fiscal_year", "base_salary", "taxes", "benefits",
                "transport_voucher", "meal_voucher", "position", "flag", "codes", "access_count",
                "accumulated_vacation", "paid_vacation", "overtime_hours", "additional_amounts",
                "personnel_id", "department_id", "time_on_job", "person_age", "cpf_encrypted",
                "rg_encrypted", "created_at", "year_hire_date", "month_hire_date"}
    assert set(silver.columns) == expected
    rows = {r["hr_id"]: r for r in silver.collect()}
    assert rows["1"]["time_on_job"] == (dt.date(2024, 1, 1) - dt.date(2015, 1, 1)).days
    assert rows["2"]["time_on_job"] == 731 and rows["2"]["person_age"] == 23
    assert rows["4"]["person_age"] == 48 and float(rows["4"]["taxes"]) == 12.0
    assert rows["1"]["birth_date"] == dt.date(1990, 5, 10)
    vault = read_table(spark, str(tmp_path / "vault"))
    assert set(vault.columns) == set(E.VAULT_COLUMNS) | {"created_at"}
    joined = silver.join(vault, "cpf_encrypted")
    assert joined.count() == 4                               # tokens agree across writes


def test_employees_gate(spark, tmp_path):
    dirty = CLEAN_PEOPLE + [
        dict(hr="5", cpf="11111111111", birth=dt.date(1899, 6, 1), cep="1", hire=dt.date(2020, 1, 1),
             pos="OPV", salary="-1", taxes="-1"),
        dict(hr="5", cpf="", birth=dt.date(1980, 1, 1), cep="1", hire=dt.date(2020, 1, 1),
             pos="OPV", taxes="12345678.9"),
    ]
    with pytest.raises(quality.QualityError) as err:
        run_employees(spark, tmp_path / "a", dirty)
    for label in ["not_null(cpf)", "unique(cpf)", "unique(hr_id)", "between(birth_date)",
                  "between(base_salary)", "matches(taxes)"]:
        assert label in str(err.value)
    res = run_employees(spark, tmp_path / "b", dirty, strict=False)
    assert sorted(r["hr_id"] for r in res.silver.collect()) == ["2", "3", "4"]
    q = read_table(spark, str(tmp_path / "b" / "q"))
    assert q.count() == 3 and "cpf" not in q.columns         # no clear identifiers in quarantine


def test_uncastable_cells_go_to_quarantine(spark, tmp_path):
    dirty = CLEAN_PEOPLE + [dict(hr="9", cpf="99999999999", birth=dt.date(1980, 1, 1), cep="1",
                                 hire=dt.date(2020, 1, 1), pos="OPV", salary="1.234,56")]
    with pytest.raises(quality.QualityError, match="castable"):
        run_employees(spark, tmp_path / "a", dirty)
    res = run_employees(spark, tmp_path / "b", dirty, strict=False)
    assert res.silver.count() == 4 and res.quarantined == 1
    (bad,) = read_table(spark, str(tmp_path / "b" / "q")).collect()
    assert bad[quality.UNCAST_COLUMN] == {"base_salary": "1.234,56"}


def test_levels_job(spark, tmp_path):
    src = write_lines(tmp_path, "levels.csv", [
        "Nível%Descrição Nível%Tempo no Nível%Outro",
        "JA%Estagiário%1%x", "DB%Analista%3%x", "ID%Gerente%5%x", "ZZ%Presidente%9%x",
        "JE%Diretor%8%x",
    ])
    res = jobs.silver_levels(spark, src, str(tmp_path / "levels_out"))
    assert set(res.silver.columns) == {"level", "level_description", "time_on_level", "created_at"}
    assert sorted(r["level"] for r in res.silver.collect()) == ["DB", "ID", "JA", "JE"]


def test_pq_job_with_repeated_headers(spark, tmp_path):
    names = E.PQ_COLUMNS[:17] + ["Cargo"] + E.PQ_COLUMNS[20:]
    names += [f"Extra{i}" for i in range(len(names), 43)] + ["Nível"]
    names += [f"Extra{i}" for i in range(44, 51)] + ["Nível"]
    names[30] = "Cargo"
    row = {n: f"v{i}" for i, n in enumerate(names)}
    values = [row[n] for n in names]
    values[names.index("Data de Nascimento")] = serial(dt.date(1985, 7, 1))
    values[names.index("Data de Contratacao")] = serial(dt.date(2021, 3, 15))
    values[names.index("Data de Demissao")] = ""
    values[17], values[43], values[51] = "OPV", "Diretor", "JE"
    src = write_lines(tmp_path, "partner_staff.csv", [";".join(names), ";".join(values)])
    res = jobs.silver_pq(spark, src, str(tmp_path / "partner_out"), str(tmp_path / "vault"), SECRET)
    r = res.silver.first()
    assert (r["responsible_position"], r["level_description"], r["level"]) == ("OPV", "Diretor", "JE")
    assert r["hire_date"] == dt.date(2021, 3, 15) and r["termination_date"] is None
    assert "cpf" not in res.silver.columns and r["cpf_encrypted"] is not None


def test_gold_job(spark, tmp_path):
    pos = jobs.silver_positions(spark, write_lines(tmp_path, "c.csv", POSITIONS),
                                str(tmp_path / "positions_out"))
    cep = jobs.silver_postal(spark, write_lines(tmp_path, "p.csv", POSTAL), str(tmp_path / "postal_out"))
    emp = run_employees(spark, tmp_path, CLEAN_PEOPLE)
    assert pos.silver.count() and cep.silver.count() and emp.silver.count()
    out = jobs.gold(spark, str(tmp_path / "postal_out"), str(tmp_path / "employees_out"),
                    str(tmp_path / "positions_out"), str(tmp_path / "marts"))
    assert sorted(out) == sorted(jobs.MART_SPECS)
    for name in out:
        assert os.path.isdir(tmp_path / "marts" / name)
    region = {r["region"]: r["total_employees"] for r in out["region"].collect()}
    assert region == {"Centro - Oeste": 2, "Nordeste": 1, None: 1}
    days1 = (dt.date(2024, 1, 1) - dt.date(2015, 1, 1)).days
    days3 = (dt.date(2024, 1, 1) - dt.date(2010, 6, 15)).days
    levels = {r["level_description"]: r["average_time_on_job_in_years"]
              for r in out["average_time_on_job"].collect()}
    assert levels == {"Diretor": days1 / 365.25, "Gerente": (731 + 31) / (2 * 365.25),
                      None: days3 / 365.25}
    gen = {(r["generation"], r["area"]): r["average_time_on_job_in_years"]
           for r in out["area_generation_average_time_on_job"].collect()}
    assert gen[("Gen Z", "Logística")] == 731 / 365.25
    assert gen[("Gen X", "Logística")] == 31 / 365.25
    assert gen[("Boomer", None)] == days3 / 365.25
    gr = {(r["region"], r["generation"]): r["total_employees"]
          for r in out["generation_region"].collect()}
    assert gr == {("Centro - Oeste", "Millennial"): 1, ("Centro - Oeste", "Gen X"): 1,
                  ("Nordeste", "Gen Z"): 1, (None, "Boomer"): 1}
    assert "created_at" in out["generation_average_time_on_job"].columns


def test_run_all(spark, tmp_path):
    inp = tmp_path / "raw"
    write_lines(inp, "positions.csv", POSITIONS)
    write_lines(inp, "postal.csv", POSTAL)
    write_lines(inp, "customers.csv", CUSTOMERS)
    employee_file(inp, CLEAN_PEOPLE)                          # writes employees.csv
    write_lines(inp, "levels.csv", ["Nível%Descrição Nível%Tempo no Nível", "JA%Estagiário%1"])
    out = tmp_path / "lake"
    names = ["positions", "postal", "customers", "employees", "levels"]
    with pytest.raises(FileNotFoundError, match="partner_staff.csv"):
        jobs.run_all(spark, str(inp), str(out), AS_OF, SECRET)  # an input is missing
    with pytest.raises(ValueError, match="employees, positions"):
        jobs.run_all(spark, str(inp), str(out), AS_OF, SECRET, entities=["postal"])
    assert not os.path.exists(out)
    # a URI is looked up by the file system that it names
    done = jobs.run_all(spark, f"file://{inp}", str(out), AS_OF, SECRET, entities=names)
    assert set(done) == {"positions", "postal", "customers", "employees", "levels", "gold"}
    for entity in ("positions", "postal", "customers", "employees", "levels"):
        assert os.path.isdir(out / "silver" / entity)
    assert os.path.isdir(out / "vault" / "employees")
    region = {r["region"]: r["total_employees"] for r in done["gold"]["region"].collect()}
    assert region == {"Centro - Oeste": 2, "Nordeste": 1, None: 1}
    stamps = {read_table(spark, str(out / "silver" / e)).select("created_at").first()[0]
              for e in ("positions", "postal", "levels")}
    assert len(stamps) == 1                                   # one stamp for the whole run


def test_rows_with_too_many_cells_are_quarantined(spark, tmp_path):
    """One row more than the file's columns hold, per entity; rows in = silver + quarantine."""
    positions = [*POSITIONS, "OPX;Analista;Operações;JAJ;JE;Efetivo;S;Diretoria;;lost"]
    src = write_lines(tmp_path, "positions.csv", positions)
    q = str(tmp_path / "qp")
    res = jobs.silver_positions(spark, src, str(tmp_path / "p"), quarantine=q)
    assert (res.silver.count(), res.quarantined) == (5, 1)
    assert spark.read.parquet(q).first()["_wide_line"] == positions[-1]
    assert "_wide_line" not in res.silver.columns

    src = write_lines(tmp_path, "postal.csv", [*POSTAL, "1|SP|Sudeste|lost"])
    res = jobs.silver_postal(spark, src, str(tmp_path / "c"))
    assert (res.silver.count(), res.quarantined) == (3, 1)

    src = write_lines(tmp_path, "customers.csv", [
        *CUSTOMERS, "Souza Santos;126000;12;FIIV;882467283;08/04/2019;3;;;;;;lost"])
    q = str(tmp_path / "qc")
    res = jobs.silver_customers(spark, src, str(tmp_path / "cu"), quarantine=q)
    assert (res.silver.count(), res.quarantined) == (5, 3)
    reasons = {r["_failed_rules"]: r["row"] for r in spark.read.parquet(q).collect()}
    assert "lost" in reasons["too many cells"]

    src = write_lines(tmp_path, "levels.csv", [
        "Nível%Descrição Nível%Tempo no Nível", "A%Gerente%3", "B%Gerente%4%lost", "C%Chefe%1"])
    q = str(tmp_path / "ql")
    res = jobs.silver_levels(spark, src, str(tmp_path / "l"), quarantine=q)
    assert (res.silver.count(), res.quarantined) == (1, 2)
    assert {r["level"]: r["_failed_rules"] for r in spark.read.parquet(q).collect()} == {
        "B": "too many cells", "C": "in_set(level_description)"}


def test_wide_and_rejected_people_keep_their_clear_values_in_the_vault(spark, tmp_path):
    src = employee_file(tmp_path, CLEAN_PEOPLE)
    with open(src, "r", encoding="utf-8", newline="") as f:
        lines = f.read().split("\r\n")
    lines[1] += "||lost"
    with open(src, "w", encoding="utf-8", newline="") as f:
        f.write("\r\n".join(lines))
    out, vault, q = (str(tmp_path / n) for n in ("silver", "vault", "q"))
    res = jobs.silver_employees(spark, src, out, vault, AS_OF, SECRET, quarantine=q, strict=False)
    assert (res.silver.count(), res.quarantined) == (3, 1)
    bad = spark.read.parquet(q).first()
    assert bad["_failed_rules"] == "is_null(_wide_line)"
    assert not {"cpf", "full_name", "_wide_line"} & set(spark.read.parquet(q).columns)
    kept = spark.read.parquet(f"{vault}_rejected").first()
    assert (kept["cpf"], kept["cpf_encrypted"]) == ("11111111111", bad["cpf_encrypted"])
    assert kept["_wide_line"].endswith("||lost")
    assert spark.read.parquet(vault).count() == 3
    with pytest.raises(quality.QualityError, match="_wide_line"):
        jobs.silver_employees(spark, src, out, vault, AS_OF, SECRET, quarantine=q)


def test_cells_that_a_type_cannot_hold_are_rejected_with_their_text(spark, tmp_path):
    bad = ["Souza A;10.999;12;FIIV;882467283;08/04/2019;1;;;;;",
           "Souza B;99999999999999999999;12;FIIV;882467283;08/04/2019;1;;;;;",
           "Souza C;1;five;FIIV;882467283;08/04/2019;1;;;;;",
           "Souza D;1;12;FIIV;882467283;2019-03-15;1;;;;;", "Souza E;1;12;FIIV;AB-99;08/04/2019;1;;;;;"]
    src = write_lines(tmp_path, "customers.csv", CUSTOMERS + bad)
    q = str(tmp_path / "q")
    res = jobs.silver_customers(spark, src, str(tmp_path / "out"), quarantine=q, strict=False)
    assert res.silver.count() == 5 and res.quarantined == 2 + len(bad)
    kept = {r["_failed_rules"]: r["row"] for r in spark.read.parquet(q).collect()}
    for label, text in [("castable(number_of_services),not_null(number_of_services)", '"five"'),
                        ("castable(contract_start_date),not_null(contract_start_date)", '"2019-03-15"'),
                        ("castable(cep)", '"AB-99"')]:
        assert text in kept[label]
    assert {"10.999", "99999999999999999999"} <= {t for r in spark.read.parquet(q).collect()
                                                  for t in r["row"].split('"')}

    taxes = ["99999999999999999999", "1.239"]
    people = CLEAN_PEOPLE + [dict(CLEAN_PEOPLE[0], hr=str(20 + i), cpf=str(20 + i), taxes=t)
                             for i, t in enumerate(taxes)] + [
        dict(CLEAN_PEOPLE[0], hr="30", cpf="30", salary="7.005")]
    res = run_employees(spark, tmp_path / "e", people, strict=False)
    assert (res.silver.count(), res.quarantined) == (4, 3)
    lost = [r[quality.UNCAST_COLUMN] for r in read_table(spark, str(tmp_path / "e" / "q")).collect()]
    assert sorted(lost, key=str) == sorted([{"taxes": taxes[0]}, {"taxes": taxes[1]}, {"base_salary": "7.005"}],
                                           key=str)


def test_a_stopped_job_leaves_the_old_table(spark, tmp_path):
    good = write_lines(tmp_path, "good.csv", CUSTOMERS)
    bad = write_lines(tmp_path, "bad.csv", CUSTOMERS + ["Souza Santos;126000;12;FIIV;882467283;08/04/2019;7;;;;;"])
    out, q = str(tmp_path / "out"), str(tmp_path / "q")
    jobs.silver_customers(spark, good, out, quarantine=q, run_ts="2024-01-01 00:00:00")
    with pytest.raises(quality.QualityError):
        jobs.silver_customers(spark, bad, out, quarantine=q, run_ts="2024-02-01 00:00:00")
    silver = read_table(spark, out)
    assert silver.count() == 5 and {str(r[0]) for r in silver.select("created_at").distinct().collect()} == {
        "2024-01-01 00:00:00"}
    assert spark.read.parquet(q).count() == 3                 # the quarantine tells why
    assert not [f for f in os.listdir(tmp_path) if f.startswith(".") and not f.endswith(".crc")]


def test_a_swap_that_died_is_recovered(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    os.rename(path, tmp_path / ".previous_t")                 # between the two renames
    with pytest.raises(RuntimeError, match="stop"):
        with publishing(spark) as stage:
            spark.range(9).write.parquet(stage(path))
            raise RuntimeError("stop")
    assert spark.read.parquet(path).count() == 3
    with publishing(spark) as stage:
        spark.range(9).write.parquet(stage(path))
    assert spark.read.parquet(path).count() == 9 and sorted(os.listdir(tmp_path)) == ["t"]


def test_a_second_drop_changes_only_its_months(spark, tmp_path):
    path = str(tmp_path / "by_month")
    def drop(rows, ts):
        df = spark.createDataFrame(rows, "id int, d string, v int").selectExpr("id", "to_date(d) AS hired", "v")
        return merge_by_month(df, "hired", path, ["id"], ts)
    drop([(1, "2024-01-05", 1), (2, "2024-02-05", 1), (3, "2024-03-05", 1), (4, "2024-04-01", 1), (5, None, 1)],
         "2024-05-01 00:00:00")
    files = {m: os.listdir(f"{path}/year_hired=2024/month_hired={m}") for m in (1, 2, 3, 4)}
    # 2 changes, 3 moves to January and leaves March empty, 5 gets a date, 6 is new
    assert drop([(2, "2024-02-05", 2), (3, "2024-01-09", 2), (5, "2024-02-06", 2), (6, None, 2)],
                "2024-06-01 00:00:00") == 4
    rows = {r["id"]: (str(r["hired"]), r["v"], r["month_hired"]) for r in read_table(spark, path).collect()}
    assert rows == {1: ("2024-01-05", 1, 1), 2: ("2024-02-05", 2, 2), 3: ("2024-01-09", 2, 1),
                    4: ("2024-04-01", 1, 4), 5: ("2024-02-06", 2, 2), 6: ("None", 2, None)}
    assert os.listdir(f"{path}/year_hired=2024/month_hired=4") == files[4]
    assert not os.path.exists(f"{path}/year_hired=2024/month_hired=3")
    assert [f for f in os.listdir(path) if f.startswith(".") and not f.endswith(".crc")] == []


@pytest.mark.parametrize("block", ["128m", "1k"])
def test_broken_lines_are_stitched(spark, tmp_path, block):
    """Halves meet over blank lines and over the borders of a file's blocks; others stay in quarantine."""
    rows, expected = [], set()
    for i in range(400):
        name = f"Nome {chr(97 + i % 26)}{chr(97 + i // 26)}"
        head, tail = f"{name};{1000 + i};{i % 90 + 1};", f"OPV;{10**7 + i};15/03/2019;{i % 4 + 1};;;;;"
        expected.add(name.title())
        if i % 5:
            rows.append(head + tail)
        else:
            rows += [head, *[""] * (i % 3), tail]
    rows += ["Sem Cauda;1;2;", "Outro Nome;5;6;OPV;12345678;15/03/2019;1", "FIIV;148112796;15/01/2019;4;;;;;"]
    src = write_lines(tmp_path, "customers.csv", [CUSTOMERS[0], *rows])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        res = jobs.silver_customers(spark, src, str(tmp_path / "out"), quarantine=str(tmp_path / "q"), stitch=True)
        names = [r["customer"] for r in res.silver.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(names) == 401 and set(names) == expected | {"Outro Nome"}
    assert res.quarantined == 2


def test_a_drop_of_employees_is_merged(spark, tmp_path):
    def drop(people, name, strict=True):
        src = employee_file(tmp_path / name, people)
        return jobs.silver_employees(spark, src, str(tmp_path / "silver"), str(tmp_path / "vault"), AS_OF, SECRET,
                                     quarantine=str(tmp_path / "q"), strict=strict, merge=True)
    drop(CLEAN_PEOPLE, "a")
    files = os.listdir(tmp_path / "silver" / "year_hire_date=2010" / "month_hire_date=6")
    second = [dict(CLEAN_PEOPLE[0], salary="6000.00"), dict(CLEAN_PEOPLE[1], hire=dt.date(2015, 1, 9)),
              dict(CLEAN_PEOPLE[0], hr="9", cpf="99999999999")]
    silver = drop(second, "b").silver
    assert {r["hr_id"]: (str(r["base_salary"]), r["year_hire_date"]) for r in silver.collect()} == {
        "1": ("6000.00", 2015), "2": ("5000.00", 2015), "3": ("5000.00", 2010), "4": ("5000.00", 2023),
        "9": ("5000.00", 2015)}
    assert os.listdir(tmp_path / "silver" / "year_hire_date=2010" / "month_hire_date=6") == files
    assert not os.path.exists(tmp_path / "silver" / "year_hire_date=2020" / "month_hire_date=1")
    vault = read_table(spark, str(tmp_path / "vault"))
    assert vault.count() == 5 and silver.join(vault, "cpf_encrypted").count() == 5
    with pytest.raises(quality.QualityError):
        drop([dict(CLEAN_PEOPLE[0], salary="-1")], "c")
    assert read_table(spark, str(tmp_path / "silver")).filter("base_salary < 0").count() == 0
    # states of the months that the second drop concerned, then gold from all of them
    states, months = str(tmp_path / "states"), [(2015, 1), (2020, 1)]
    jobs.update_states(spark, str(tmp_path / "silver"), states)
    jobs.update_states(spark, str(tmp_path / "silver"), states, months)
    jobs.silver_positions(spark, write_lines(tmp_path, "c.csv", POSITIONS), str(tmp_path / "positions"))
    jobs.silver_postal(spark, write_lines(tmp_path, "p.csv", POSTAL), str(tmp_path / "postal"))
    args = (str(tmp_path / "postal"), str(tmp_path / "positions"))
    kept = jobs.gold_from_states(spark, *args, states, str(tmp_path / "gold"))
    exact = jobs.gold(spark, args[0], str(tmp_path / "silver"), args[1], str(tmp_path / "gold2"))
    for name, mart in exact.items():
        assert sorted(map(str, mart.drop("created_at").collect())) == sorted(
            map(str, kept[name].drop("created_at").collect()))


def test_states_are_merged_before_they_are_joined(spark, tmp_path, monkeypatch):
    silver = spark.createDataFrame([
        ("t1", "1", "P", d, days, 30) for d, days in (("2020-01-05", 100), ("2020-02-05", 300), ("2021-02-05", None))
    ] + [("t2", "2", "Q", "2020-02-01", 50, 60)],
        "cpf_encrypted string, cep string, position string, d string, time_on_job int, person_age int")
    paths = {n: str(tmp_path / n) for n in ("silver", "postal", "positions")}
    write_by_month(silver.withColumn("hire_date", F.col("d").cast("date")).drop("d"), "hire_date", paths["silver"])
    spark.createDataFrame([("1", "SP", "Sul"), ("2", "SP", "Sul")], "cep string, state string, region string"
                          ).write.parquet(paths["postal"])
    rest = {c: F.lit(None).cast("string") for c in ("cod_area", "cod_level", "quadro", "bonus")}
    spark.createDataFrame([("P", "L", "A"), ("Q", "L", "B")], "level string, level_description string, area string"
                          ).withColumns(rest).write.parquet(paths["positions"])
    joined = []
    for name in ("spells_with_position", "people_with_region"):
        f = getattr(jobs, name)
        monkeypatch.setattr(jobs, name, lambda rows, dim, f=f: (joined.append(rows.count()), f(rows, dim))[1])
    jobs.update_states(spark, paths["silver"], str(tmp_path / "states"))
    kept = jobs.gold_from_states(spark, paths["postal"], paths["positions"], str(tmp_path / "states"),
                                 str(tmp_path / "kept"))
    assert joined == [2, 2]                     # one row per group, not one per month and group
    exact = jobs.gold(spark, paths["postal"], paths["silver"], paths["positions"], str(tmp_path / "exact"))
    for name, mart in exact.items():
        assert sorted(map(str, mart.drop("created_at").collect())) == sorted(
            map(str, kept[name].drop("created_at").collect()))
