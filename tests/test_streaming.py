from __future__ import annotations

import os

import pytest
from conftest import write_lines
from pyspark.errors import StreamingQueryException

from staffmart.streaming import ingest

HEADER = ("Cliente;Valor Contrato Anual;Quantidade de Serviços;Cargo Responsável;CEP;"
          "Data Início Contrato;Nivel de Importancia;;;;;")


def test_customer_drops_are_ingested_once(spark, tmp_path):
    src = tmp_path / "raw"
    write_lines(src, "day1.csv", [HEADER,
                                  "Teixeira Gonçalves;54000;37;ADIII;743419711;15/03/2019;3;;;;;",
                                  "Santos Costa;252000;;64;FIIV;430169311;10/03/2019;2;;;;;"])
    out, q, ckpt = (str(tmp_path / n) for n in ("silver", "quarantine", "ckpt"))
    ingest(spark, "customers", str(src), out, q, ckpt).awaitTermination()
    assert spark.read.parquet(out).count() == 2

    write_lines(src, "day2.csv", [HEADER,
                                  "Maria Dantas;135000;61;",
                                  "Do Monteiro;351000;;19;OPV;839424894;31/01/2019;3;;;;;"])
    ingest(spark, "customers", str(src), out, q, ckpt).awaitTermination()
    silver = spark.read.parquet(out)
    assert sorted(r["customer"] for r in silver.collect()) == \
        ["Do Monteiro", "Santos Costa", "Teixeira Gonçalves"]          # day1 not re-read
    assert silver.select("batch_id").distinct().count() == 2
    assert spark.read.parquet(q).count() == 1                           # the broken head
    assert os.path.isdir(ckpt)


def test_position_drops(spark, tmp_path):
    src = tmp_path / "raw"
    write_lines(src, "p.csv", ["Cargo;Nível;Área;COD Área;COD Nível;Quadro;Bonus;Contratacao",
                               "LOIV;;Gerente;Logísitca;EDE;ID;Efetivo;S;Diretoria"])
    out = str(tmp_path / "silver")
    ingest(spark, "positions", str(src), out, str(tmp_path / "q"),
           str(tmp_path / "ckpt")).awaitTermination()
    row = spark.read.parquet(out).first()
    assert (row["level_description"], row["area"], row["hiring"]) == ("Gerente", "Logística",
                                                                      "Diretoria")


def test_postal_drops(spark, tmp_path):
    src = tmp_path / "raw"
    write_lines(src, "a.txt", ["CEP|Estado|Região", "20125535|Mato Grosso|Centro - Oeste"])
    out = str(tmp_path / "silver")
    ckpt = str(tmp_path / "ckpt")
    ingest(spark, "postal", str(src), out, str(tmp_path / "q"), ckpt).awaitTermination()
    write_lines(src, "b.txt", ["CEP|Estado|Região", "34949262||Pará|Norte"])
    ingest(spark, "postal", str(src), out, str(tmp_path / "q"), ckpt).awaitTermination()
    rows = sorted((r["cep"], r["state"], r["region"]) for r in spark.read.parquet(out).collect())
    assert rows == [("20125535", "Mato Grosso", "Centro - Oeste"), ("34949262", "Pará", "Norte")]


def test_a_new_checkpoint_replaces_nothing_and_wide_lines_are_kept(spark, tmp_path):
    src, out, q = tmp_path / "raw", str(tmp_path / "silver"), str(tmp_path / "q")
    write_lines(src, "a.txt", ["CEP|Estado|Região", "1|PR|Sul", "2|SC|Sul|lost"])
    for run in range(2):
        ingest(spark, "postal", str(src), out, q, str(tmp_path / f"ckpt{run}")).awaitTermination()
    silver = spark.read.parquet(out)
    assert [r["cep"] for r in silver.collect()] == ["1", "1"]
    assert silver.select("stream_id").distinct().count() == 2
    assert [r["_wide_line"] for r in spark.read.parquet(q).collect()] == ["2|SC|Sul|lost"] * 2


@pytest.mark.parametrize("header", ["Cargo;Área;Nível;COD Área;COD Nível;Quadro;Bonus;Contratacao", "x;y"])
def test_a_stream_stops_at_another_header(spark, tmp_path, header):
    src, out = tmp_path / "raw", str(tmp_path / "silver")
    row = "LOIV;Logísitca;Gerente;EDE;ID;Efetivo;S;Diretoria"
    write_lines(src, "p.csv", [header, row])
    names = (str(src), out, str(tmp_path / "q"), str(tmp_path / "ckpt"))
    with pytest.raises(StreamingQueryException, match="p.csv"):
        ingest(spark, "positions", *names).awaitTermination()
    assert not os.path.exists(out)
    # the batch runs again once the file is mended
    write_lines(src, "p.csv", ["Cargo;Nível;Área;COD Área;COD Nível;Quadro;Bonus;Contratacao",
                               "LOIV;Gerente;Logística;EDE;ID;Efetivo;S;Diretoria"])
    ingest(spark, "positions", *names).awaitTermination()
    assert [r["area"] for r in spark.read.parquet(out).collect()] == ["Logística"]
