from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from staffmart.functions import GENERATION_BANDS, generation
from staffmart.operators import banding, marts, quality
from staffmart.plans import cli
from staffmart.session import checkpoint_root, scratch_path


def bands_table(spark, rows):
    return spark.createDataFrame(rows, "band string, band_from int, band_to int")


def test_bands_table_agrees_with_the_case_expression(spark):
    ages = spark.range(-3, 110).selectExpr("cast(id as int) AS age").union(
        spark.sql("SELECT CAST(NULL AS INT)"))
    for step in (1, 7, 16, 1000):
        got = banding.with_band(ages, "age", bands_table(spark, GENERATION_BANDS), "band", step)
        check = got.withColumn("case", generation("age"))
        assert check.count() == 114 and check.filter("band <> case").count() == 0


def test_bands_that_overlap_or_leave_holes_are_an_error(spark):
    bad = bands_table(spark, [("a", 0, 9), ("b", 8, 20), ("c", 25, 30), ("d", 40, 31), ("e", None, 5), (None, 31, 31)])
    found = {(r["problem"], r["band"], r["at"]) for r in banding.band_problems(bad).collect()}
    assert found == {("overlap", "b", 8), ("hole", "c", 21), ("reversed", "d", 40), ("incomplete", "e", None),
                     ("incomplete", None, 31)}
    with pytest.raises(banding.BandError, match="overlap at 8"):
        banding.with_band(spark.range(3), "id", bad, "band")
    assert banding.band_problems(bands_table(spark, [])).count() == 0


def test_scratch_paths_live_under_the_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    a, b = scratch_path(spark, "t"), scratch_path(spark, "t")
    assert a != b and a.startswith(root)
    spark.range(3).write.parquet(a)
    assert spark.read.parquet(a).count() == 3


def test_cli_parses_every_entity():
    for e in cli.ENTITIES:
        args = cli.parse(["silver", e, "--src", "in.csv", "--out", "out"])
        assert args.entity == e and args.src == "in.csv"
    g = cli.parse(["gold", "--postal", "p", "--employees", "e", "--positions", "c", "--out", "o"])
    assert g.command == "gold" and os.path.basename(g.out) == "o"


def test_hot_key_holding_a_third_of_rows(spark):
    """One id and one region carry a third of all rows: results stay whole."""
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("hr_id"),
        F.when(F.col("id") % 3 == 0, F.lit("Hot")).otherwise(
            F.concat(F.lit("R"), (F.col("id") % 7).cast("string"))).alias("region"),
        (F.col("id") % 100).cast("int").alias("days"))
    report = {r["rule"]: r for r in quality.quality_report(df, [quality.unique("hr_id"),
                                                               quality.not_null("region")]).collect()}
    assert report["unique"]["unexpected"] == n // 3 and report["unique"]["evaluated"] == n
    passing, failing = quality.split_quarantine(df, [quality.unique("hr_id")])
    assert passing.count() == n - n // 3 and failing.count() == n // 3
    hc = {r["region"]: r["total_employees"] for r in
          marts.headcount(df, ["region"], "hr_id").collect()}
    assert hc["Hot"] == 1 and sum(hc.values()) == 1 + (n - n // 3)
    means = marts.mean_years(df, ["region"], "days").filter("region = 'Hot'").first()
    expected = sum(i % 100 for i in range(0, n, 3)) / ((n // 3) * 365.25)
    assert means["average_time_on_job_in_years"] == expected


def test_cli_runs_a_job(spark, tmp_path):
    from conftest import write_lines
    src = write_lines(tmp_path, "positions.csv", [
        "Cargo;Nível;Área;COD Área;COD Nível;Quadro;Bonus;Contratacao",
        "LOIV;;Gerente;Logísitca;EDE;ID;Efetivo;S;Diretoria"])
    out = str(tmp_path / "silver")
    assert cli.main(["silver", "positions", "--src", src, "--out", out]) == 0
    assert spark.read.parquet(out).first()["area"] == "Logística"


def test_hot_join_key_is_split_by_adaptive_execution(spark, capsys):
    """A join key holding a third of the fact: the lookup's sort-merge join
    is eligible for adaptive skew handling, which splits the hot partition."""
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        fact = spark.range(30_000).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997).alias("k"), "id")
        dim = spark.range(997).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        df = marts.lookup(fact, dim, "k")
        rows = df.collect()
        df.explain()
        plan = capsys.readouterr().out
    finally:
        for k in confs:
            spark.conf.unset(k)
    hot = sum(1 for i in range(30_000) if i % 3 == 0 or i % 997 == 0)
    assert len(rows) == 30_000 and sum(1 for r in rows if r["k"] == 0) == hot
    assert "SortMergeJoin(skew=true)" in plan
