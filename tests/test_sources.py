from __future__ import annotations

import glob

import pyarrow.parquet as pq

from conftest import write_lines

import pytest

from staffmart.sources import HeaderError, WIDE_LINE, is_wide
from staffmart.sources import read_delimited, read_header_split, read_table, write_by_month, write_table
from staffmart.sources.delimited import wide_line
from staffmart.sources.sinks import STAMP_COLUMN


def test_explicit_schema_keeps_overflow_cell_and_spaces(spark, tmp_path):
    path = write_lines(tmp_path, "pos.csv", [
        "Cargo;Nível;Área",
        "OPV;Diretor;   JAJ",
        "LOIV;;Gerente;Logística",
        "",
        "ADI;Estagiário;Administrativo",
    ])
    df = read_delimited(spark, path, ";", ["Cargo", "Nível", "Área"], overflow=1)
    assert df.columns == ["Cargo", "Nível", "Área", "_c3"]
    rows = {r["Cargo"]: r for r in df.collect()}
    assert len(rows) == 3                                  # blank line skipped, header not a row
    assert rows["OPV"]["Área"] == "   JAJ"                  # leading spaces kept
    assert rows["LOIV"]["Nível"] is None and rows["LOIV"]["_c3"] == "Logística"
    assert "\ufeff" not in "".join(rows)                     # BOM stripped


def test_header_driven_names(spark, tmp_path):
    path = write_lines(tmp_path, "emp.csv", [
        "ID RH||Cargo||Cargo",
        "1||OPV||X",
    ])
    df = read_delimited(spark, path, "|")
    assert df.columns == ["ID RH", "_c1", "Cargo2", "_c3", "Cargo4"]
    assert df.first()["Cargo2"] == "OPV"


def test_header_split_squashes_doubled_pipes_and_drops_header(spark, tmp_path):
    path = write_lines(tmp_path, "cep.csv", [
        "CEP|Estado|Região",
        "20125535|Mato Grosso|Centro - Oeste",
        "34949262||Pará|Norte",
        "44060184|Pernambuco",
    ])
    df = read_header_split(spark, path, "|", ["CEP", "Estado", "Região"])
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [("20125535", "Mato Grosso", "Centro - Oeste"),
                    ("34949262", "Pará", "Norte"),
                    ("44060184", "Pernambuco", None)]      # past the end -> NULL, no error


def test_header_split_peeks_names_when_unknown(spark, tmp_path):
    path = write_lines(tmp_path, "cep.csv", ["CEP|Estado|Região", "1|A|B"])
    df = read_header_split(spark, path, "|")
    assert df.columns == ["CEP", "Estado", "Região"]
    assert [tuple(r) for r in df.collect()] == [("1", "A", "B")]


def test_stamped_and_month_partitioned_writes(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "2019-03-10"), (2, "2019-03-31"), (3, "2018-12-14"), (4, None)],
        "id int, d string").selectExpr("id", "cast(d as date) as hire_date")
    out = str(tmp_path / "by_month")
    write_by_month(df, "hire_date", out, run_ts="2024-01-01 00:00:00")
    back = read_table(spark, out)
    assert {"year_hire_date", "month_hire_date", STAMP_COLUMN} <= set(back.columns)
    counts = {(r[0], r[1]): r[2] for r in
              back.groupBy("year_hire_date", "month_hire_date").count().collect()}
    assert counts == {(2019, 3): 2, (2018, 12): 1, (None, None): 1}
    assert back.filter(back[STAMP_COLUMN].isNull()).count() == 0

    flat = str(tmp_path / "flat")
    write_table(df, flat, run_ts="2024-01-01 00:00:00")
    stamps = {r[0] for r in read_table(spark, flat).select(STAMP_COLUMN).collect()}
    assert len(stamps) == 1                                # one stamp per run


def test_month_partitioned_write_sorted_within_files(spark, tmp_path):
    df = spark.range(20_000).selectExpr(
        "id", "pmod(hash(id), 1000) AS v", "date_add(DATE'2020-01-01', CAST(id % 40 AS INT)) AS d")
    out = str(tmp_path / "sorted")
    write_by_month(df, "d", out, run_ts="2024-01-01 00:00:00", sort_by=["v"])
    assert read_table(spark, out).count() == 20_000
    files = glob.glob(f"{out}/**/*.parquet", recursive=True)
    assert files
    for f in files:
        values = pq.ParquetFile(f).read(["v"]).column("v").to_pylist()
        assert values == sorted(values)


def test_every_part_file_may_carry_a_header(spark, tmp_path):
    d = tmp_path / "parts"
    for i in range(3):
        write_lines(d, f"part-{i}.csv", ["Cargo;Nível", f"C{i};Analista", f"D{i};Gerente"])
    df = read_delimited(spark, str(d), ";", ["Cargo", "Nível"])
    assert sorted(r["Cargo"] for r in df.collect()) == ["C0", "C1", "C2", "D0", "D1", "D2"]
    p = tmp_path / "pipes"
    for i in range(3):
        write_lines(p, f"part-{i}.txt", ["CEP|Estado|Região", f"{i}||SP|Sudeste"])
    back = read_header_split(spark, str(p), "|", ["CEP", "Estado", "Região"])
    assert sorted(tuple(r) for r in back.collect()) == [(str(i), "SP", "Sudeste") for i in range(3)]


def test_cells_past_the_schema_keep_their_line(spark, tmp_path):
    path = write_lines(tmp_path, "w.csv", [
        "a;b;;",
        "1;2;3;4",
        "5;6;7;8;;",            # empty cells past the last lose nothing
        '"x;y";2',
        "9;8;7;6;5",
        '"p;q";2;3;4;"r;s"',
        "short",
    ])
    df = read_delimited(spark, path, ";", ["a", "b"], overflow=2, wide_lines=True)
    assert df.columns == ["a", "b", "_c2", "_c3", WIDE_LINE]
    wide = {r["a"]: r[WIDE_LINE] for r in df.select("a", WIDE_LINE).collect()}
    assert wide == {"1": None, "5": None, "x;y": None, "9": "9;8;7;6;5",
                    "p;q": '"p;q";2;3;4;"r;s"', "short": None}


def test_foreign_and_reordered_headers(spark, tmp_path):
    foreign = write_lines(tmp_path, "f.csv", ["b;a", "1;2"])
    with pytest.raises(HeaderError, match="expected"):
        read_delimited(spark, foreign, ";", ["a", "b"])
    two = tmp_path / "two"
    write_lines(two, "1.csv", ["a;b", "1;2"])
    write_lines(two, "2.csv", ["b;a", "4;3"])
    assert sorted(tuple(r) for r in read_delimited(spark, str(two), ";").collect()) == [
        ("1", "2"), ("3", "4")]
    write_lines(two, "3.csv", ["a;c", "4;3"])
    with pytest.raises(HeaderError, match="3.csv"):
        read_delimited(spark, str(two), ";")


def test_header_split_maps_by_name(spark, tmp_path):
    names = ["CEP", "Estado", "Região"]
    d = tmp_path / "pipes"
    write_lines(d, "a b.txt", ["Região|CEP||Estado", "Sul|1|PR", "Sul|2|SC|more"])
    df = read_header_split(spark, str(d), "|", names, wide_lines=True)
    assert sorted(tuple(r) for r in df.collect()) == [
        ("1", "PR", "Sul", None), ("2", "SC", "Sul", "Sul|2|SC|more")]
    write_lines(d, "b.txt", ["3|SP|Sudeste"])
    with pytest.raises(HeaderError, match="b.txt"):
        read_header_split(spark, str(d), "|", names)
    parts = read_header_split(spark, str(d), "|", names, header_in_each_file=False)
    assert sorted(r["CEP"] for r in parts.collect()) == ["1", "2", "3"]
    write_lines(d, "c.txt", ["CEP|UF|Região", "4|SP|Sudeste"])
    with pytest.raises(HeaderError, match="c.txt"):
        read_header_split(spark, str(d), "|", names, header_in_each_file=False)
    alone = write_lines(tmp_path, "alone.txt", ["x|y|z", "4|SP|Sudeste"])
    with pytest.raises(HeaderError):
        read_header_split(spark, alone, "|", names, header_in_each_file=False)


def test_many_files_are_looked_at_in_one_job(spark, tmp_path):
    """No job per file: one finds all first lines, one more reads the reordered headers."""
    d = tmp_path / "many"
    for i in range(60):
        write_lines(d, f"{i:03}.csv", ["b;a;;" if i == 7 else '"a";b' if i == 9 else "a;b;", f"{i};{i}x", "a;b"])
    sc = spark.sparkContext
    sc.setJobGroup("headers", "headers")
    try:
        df = read_delimited(spark, str(d), ";")
        planned = len(sc.statusTracker().getJobIdsForGroup("headers"))
        rows = {(r["a"], r["b"]) for r in df.collect()}
    finally:
        sc.setJobGroup("", "")
    assert planned < 8                                     # with AQE's stages as jobs of their own
    assert {(f"{i}", f"{i}x") for i in range(60) if i != 7} < rows and ("7x", "7") in rows
    write_lines(d, "zzz.csv", ["a;c", "1;2"])
    with pytest.raises(HeaderError, match="zzz.csv.*a;c"):
        read_delimited(spark, str(d), ";")


def test_headers_of_files_in_several_blocks(spark, tmp_path):
    """A line that looks like a foreign header is no header when it lies further down."""
    lines = ["a;b", *(f"{i};{'v' * 50}" for i in range(20_000)), "b;a"]
    path = write_lines(tmp_path, "big.csv", lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = read_delimited(spark, path, ";", ["a", "b"])
        assert df.count() == 20_001
        wrong = write_lines(tmp_path, "wrong.csv", ["x;y", *lines])
        with pytest.raises(HeaderError, match="x;y"):
            read_delimited(spark, wrong, ";", ["a", "b"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("cell", ["z" * 1_000_000, 'a;b\\"' * 200_000, '""' * 100_000, ";" * 100_000],
                         ids=["long", "escaped quotes", "doubled quotes", "separators"])
def test_wide_lines_with_long_quoted_cells(spark, tmp_path, cell):
    wide = f'1;"{cell}";3;lost'
    path = write_lines(tmp_path, "w.csv", ["a;b;c", f'0;"{cell}";3', wide, f'2;"{cell}";3;;', f'3;"{cell}'])
    df = read_delimited(spark, path, ";", ["a", "b", "c"], wide_lines=True)
    found = {r["a"]: r[WIDE_LINE] for r in df.collect()}
    if cell[0] != '"':  # the parser itself ends a cell at doubled quotes
        assert found == {"0": None, "1": wide, "2": None, "3": None}
    assert found["1"] == wide
    assert df.filter(is_wide()).count() == sum(v is not None for v in found.values())


def test_wide_lines_are_told_by_one_pattern(spark):
    lines = ['a|b', 'a|b|', 'a|b||', 'a|b|c', 'a|"b|c"', 'a|"b|c"|d', 'a|"b|c', 'a|b"|c', '"a\\"|b"|c|"d|', 'a|"b\\|c|"|', None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string")
    found = df.select("i", wide_line(df["value"], "|", 2).alias("wide"))
    assert [r["i"] for r in found.orderBy("i").collect() if r["wide"] is not None] == [3, 5, 7, 8]
    # no fold over the pieces of a line, and no recursion over those of a cell
    assert "aggregate(" not in found._jdf.queryExecution().optimizedPlan().toString()
    long = ['"' + "x|" * 200_000 + '"|b|lost', 'a|"' + '""|' * 200_000, "a|b|" + '"' * 200_001]
    df = spark.createDataFrame([(x,) for x in long], "value string")
    assert [r[0] for r in df.select(wide_line(df["value"], "|", 2).isNotNull()).collect()] == [True, False, True]
