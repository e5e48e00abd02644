from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from staffmart.functions import (
    GENERATION_BANDS,
    age_in_full_years,
    correct,
    exact_decimal,
    excel_serial_to_date,
    generation,
    is_code,
    parse_day_first,
    strip_leading,
    tenure_days,
    title_case,
)


def test_excel_serial_to_date(spark):
    df = spark.createDataFrame([("43831",), ("43831.75",), ("1",), ("n/a",), (None,)], "s string")
    got = [r[0] for r in df.select(excel_serial_to_date("s")).collect()]
    assert got == [dt.date(2020, 1, 1), dt.date(2020, 1, 1), dt.date(1899, 12, 31), None, None]


def test_parse_day_first_never_throws(spark):
    df = spark.createDataFrame([("10/03/2019",), ("31/01/2019",), ("157500",), ("2019-03-10",),
                                (None,)], "s string")
    got = [r[0] for r in df.select(parse_day_first("s")).collect()]
    assert got == [dt.date(2019, 3, 10), dt.date(2019, 1, 31), None, None, None]


def test_tenure_and_age(spark):
    df = spark.createDataFrame([
        (dt.date(2020, 1, 1), dt.date(2021, 1, 1), dt.date(2000, 2, 29)),
        (dt.date(2023, 12, 1), None, dt.date(2000, 1, 1)),
        (dt.date(2023, 12, 1), None, dt.date(2000, 1, 2)),
    ], "hire date, term date, birth date")
    got = df.select(tenure_days("hire", "term", "2024-01-01").alias("t"),
                    age_in_full_years("birth", "2024-01-01").alias("a")).collect()
    assert [r["t"] for r in got] == [366, 31, 31]
    assert [r["a"] for r in got] == [23, 24, 23]
    feb = spark.createDataFrame([(dt.date(2000, 2, 29),)], "b date")
    assert feb.select(age_in_full_years("b", "2024-02-28")).first()[0] == 23
    assert feb.select(age_in_full_years("b", "2024-02-29")).first()[0] == 24


def test_generation_band_edges(spark):
    ages = [-1, 0, 24, 25, 40, 41, 56, 57, 75, 76, 100, 101, None]
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    got = [r[0] for r in df.select(generation("age")).collect()]
    assert got == ["Unknown", "Gen Z", "Gen Z", "Millennial", "Millennial", "Gen X", "Gen X",
                   "Boomer", "Boomer", "Silent", "Silent", "Unknown", "Unknown"]


def test_text_cleanup(spark):
    df = spark.createDataFrame([("@@@Operações",), ("Logísitca",), ("a@b",), ("@",), (None,)],
                               "s string")
    got = [r[0] for r in df.select(
        correct(strip_leading("s"), {"Logísitca": "Logística"})).collect()]
    assert got == ["Operações", "Logística", "a@b", "@", None]


def test_title_case_and_code_tests(spark):
    df = spark.createDataFrame([("MARIA dantas ", "FIIV", "12"), ("do monteiro", "Ab", "1.5")],
                               "n string, c string, i string")
    got = df.select(title_case("n"), is_code("c")).collect()
    assert [tuple(r) for r in got] == [("Maria Dantas ", True), ("Do Monteiro", False)]


def test_exact_decimals_lose_no_digit(spark):
    values = {"10.99": "10.99", "10.990": "10.99", "12.": "12.00", " -1 ": "-1.00", "0": "0.00", ".5": "0.50",
              "10.999": None, "99999999999999999999": None, "1.2E8": None, "1,5": None, "abc": None, ".": None,
              "": None, "1.0000000000000000000000000001": None, None: None, "9999999999999999.99": "9999999999999999.99"}
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = {r["v"]: None if r["d"] is None else str(r["d"])
           for r in df.select("v", exact_decimal("v").alias("d")).collect()}
    assert got == values


def test_bands_stay_in_the_jvm(spark, capsys):
    df = spark.createDataFrame([(30,)], "age int").select(generation("age").alias("g"))
    df.explain()
    plan = capsys.readouterr().out
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert df.first()["g"] == "Millennial"


def band_model(age):
    if age is None:
        return "Unknown"
    for name, low, high in GENERATION_BANDS:
        if low <= age <= high:
            return name
    return "Unknown"


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ages=st.lists(st.one_of(st.none(), st.integers(-5, 110)), min_size=1, max_size=30))
def test_generation_matches_the_band_model(spark, ages):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(ages)], "i int, age int")
    got = {r["i"]: r["g"] for r in df.select("i", generation("age").alias("g")).collect()}
    assert [got[i] for i in range(len(ages))] == [band_model(a) for a in ages]


def test_only_plain_serials_become_dates(spark):
    texts = ["45292", " 45292.75 ", "0", "-213", "NaN", "12d", "1e3", "Infinity", "2958465", "2958466",
             "2000000000", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [str(r[0]) for r in df.orderBy("i").select(excel_serial_to_date("t")).collect()]
    assert got == ["2024-01-01", "2024-01-01", "1899-12-30", "1899-05-31", *["None"] * 4, "9999-12-31",
                   *["None"] * 4]
