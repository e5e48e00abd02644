from __future__ import annotations

import hmac

import pytest
from pyspark.sql import functions as F

from staffmart.functions import TokenKey, key_from_conf, token
from staffmart.operators import marts, privacy


def test_token_is_deterministic_keyed_and_null_safe(spark):
    df = spark.createDataFrame([("123",), ("123",), ("456",), (None,)], "cpf string")
    got = [r[0] for r in df.select(token("cpf", "s3cret", "cpf")).collect()]
    assert got[0] == got[1] != got[2] and got[3] is None
    assert got[0] == "1." + hmac.new(b"s3cret", b"cpf:123", "sha256").hexdigest()
    other = df.select(token("cpf", "other", "cpf"), token("cpf", "s3cret", "rg")).first()
    assert len({got[0], *other}) == 3                       # another secret, another field
    long = TokenKey("k" * 100, "2024")
    assert df.select(token("cpf", long, "cpf")).first()[0] == "2024." + hmac.new(
        b"k" * 100, b"cpf:123", "sha256").hexdigest()


def test_vault_split_and_rejoin_loses_no_row(spark):
    df = spark.createDataFrame([("1", "Ana", "x", 10), ("2", "Bia", "y", 20)],
                               "cpf string, full_name string, login string, salary int")
    tok = privacy.pseudonymize(df, {"cpf": "cpf_encrypted"}, "k")
    vault, public = privacy.split_vault(tok, ["cpf", "full_name", "login", "cpf_encrypted"],
                                        ["cpf", "full_name", "login"])
    assert set(public.columns) == {"salary", "cpf_encrypted"}
    back = privacy.reidentify(public, vault, "cpf_encrypted", ["cpf", "full_name"])
    assert sorted((r["cpf"], r["salary"]) for r in back.collect()) == [("1", 10), ("2", 20)]


def test_lookup_and_marts(spark):
    fact = spark.createDataFrame([
        ("t1", "100", "OPV", 730, 30), ("t2", "100", "OPV", 365, 45),
        ("t3", "999", "XX", None, None), ("t4", "200", "FIV", 100, 60),
    ], "cpf_encrypted string, cep string, position string, time_on_job int, person_age int")
    postal = spark.createDataFrame([("100", "SP", "Sudeste"), ("100", "SP", "Sudeste"),
                                    ("200", "BA", "Nordeste")], "cep string, state string, region string")
    pos = spark.createDataFrame([("OPV", "Diretor", "Operações"), ("FIV", "Diretor", "Financeiro")],
                                "level string, level_description string, area string")
    x = marts.lookup(fact, marts.narrow_dimension(postal, ["cep", "state", "region"]), "cep")
    x = marts.lookup(x, pos, "position", "level")
    assert x.count() == 4                                  # duplicate dimension rows do not fan out
    assert "cep" in x.columns and {"position", "level"} <= set(x.columns)
    hc = {r["region"]: r["total_employees"] for r in
          marts.headcount(x, ["region"], "cpf_encrypted").collect()}
    assert hc == {"Sudeste": 2, "Nordeste": 1, None: 1}
    means = {r["level_description"]: r["average_time_on_job_in_years"] for r in
             marts.mean_years(x, ["level_description"], "time_on_job").collect()}
    assert means["Diretor"] == (730 + 365 + 100) / (3 * 365.25) and means[None] is None
    top = marts.ranked(marts.headcount(x, ["region"], "cpf_encrypted"), marts.HEADCOUNT).first()
    assert top["region"] == "Sudeste"


def test_approximate_headcount_is_close(spark):
    df = spark.range(20_000).selectExpr("id % 3 AS g", "id AS person")
    exact = {r["g"]: r["total_employees"] for r in marts.headcount(df, ["g"], "person").collect()}
    approx = {r["g"]: r["total_employees"] for r in
              marts.headcount(df, ["g"], "person", approx_rsd=0.01).collect()}
    assert set(exact) == set(approx)
    for g, n in exact.items():
        assert abs(approx[g] - n) <= 0.05 * n


def test_lookup_leaves_the_strategy_to_the_planner(spark, capsys):
    fact = spark.range(100).selectExpr("id % 3 AS k", "id")
    dim = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "k long, name string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        marts.lookup(fact, dim, "k").explain()
        plan = capsys.readouterr().out
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "SinglePartition" not in plan


def test_conflicting_dimension_keys_are_an_error(spark):
    dim = spark.createDataFrame([("1", "a"), ("1", "a"), ("2", "b"), (None, "x"), (None, "y")],
                                "k string, name string")
    once = marts.narrow_dimension(dim, ["k", "name"])
    marts.assert_unique_key(once, "k")  # exact repeats and null keys are none
    with pytest.raises(ValueError, match="for one k: 2"):
        marts.assert_unique_key(once.union(spark.createDataFrame([("2", "c")], dim.schema)), "k")


def test_reidentify_keeps_every_row(spark):
    public = spark.createDataFrame([("t1",), ("t2",), (None,)], "token string")
    vault = spark.createDataFrame([("t1", "b"), ("t1", "a")], "token string, name string")
    got = {r["token"]: r["name"] for r in privacy.reidentify(public, vault, "token", ["name"]).collect()}
    assert got == {"t1": "a", "t2": None, None: None}


def test_secret_is_not_in_printed_plans(spark, capsys):
    spark.conf.set("spark.staffmart.pseudonym.secret", "s3cret-value")
    try:
        key = key_from_conf(spark)
        spark.range(1).select(token(F.col("id"), key, "id")).explain(True)
        # a key that is handed over is hidden as well
        privacy.pseudonymize(spark.range(1), {"id": "t"}, "other-s3cret").explain(True)
    finally:
        spark.conf.unset("spark.staffmart.pseudonym.secret")
        spark.conf.unset("spark.sql.redaction.string.regex")
    printed = capsys.readouterr().out
    assert "s3cret" not in printed and "s3cret" not in repr(key)
    for pad in (*key.pads(), *TokenKey("other-s3cret").pads()):
        assert pad.hex().upper() not in printed.upper()


def test_rotation_re_keys_tables_one_by_one(spark):
    people = spark.createDataFrame([("1", "9"), ("2", "2"), (None, "7")], "cpf string, rg string")
    mapping = {"cpf": "cpf_t", "rg": "rg_t"}
    old, new = TokenKey("a"), TokenKey("b", "2")
    vault = privacy.pseudonymize(people, mapping, old)
    public = vault.drop("cpf", "rg")
    fresh, crosswalk = privacy.rotate(vault, mapping, new)
    expected = {tuple(r) for r in privacy.pseudonymize(people, mapping, new).select("cpf_t", "rg_t").collect()}
    once = privacy.apply_rotation(public, crosswalk, mapping, new)
    twice = privacy.apply_rotation(once, crosswalk, mapping, new)
    for df in (fresh.select("cpf_t", "rg_t"), once, twice):
        assert {tuple(r) for r in df.collect()} == expected
    assert crosswalk.count() == 5


def test_vault_keeps_one_row_per_person(spark, tmp_path):
    path = str(tmp_path / "vault")
    def drop(rows, ts):
        people = privacy.pseudonymize(spark.createDataFrame(rows, "cpf string, name string"), {"cpf": "t"}, "k")
        return privacy.merge_vault(people, path, "t", ts)
    drop([(str(i), "old") for i in range(600)], "2024-01-01 00:00:00")
    parts = drop([("7", "new"), ("7", "newer"), ("900", "added")], "2024-02-01 00:00:00")
    assert parts in (1, 2)
    vault = spark.read.parquet(path)
    assert vault.count() == 601 and vault.select("t").distinct().count() == 601
    changed = {r["cpf"]: r["name"] for r in vault.filter("created_at > '2024-01-15'").collect()
               if r["cpf"] in ("7", "900")}
    assert changed == {"7": "new", "900": "added"}
    gone = vault.filter("cpf IN ('7', '8')").select("t")
    assert privacy.erase(spark.createDataFrame(gone.collect(), gone.schema), path, "t") in (1, 2)
    left = spark.read.parquet(path)
    assert left.count() == 599 and left.filter("cpf IN ('7', '8')").count() == 0
    assert privacy.erase(gone.limit(0), path, "t") == 0


@pytest.mark.parametrize("dim_key", ["k", "other"])
def test_rows_without_a_key_are_spread_and_kept(spark, dim_key):
    fact = spark.range(9000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN id % 7 END AS k")
    dim = spark.range(7).selectExpr(f"id AS {dim_key}", "id * 10 AS v").union(
        spark.sql("SELECT CAST(NULL AS BIGINT), 99L"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = marts.lookup(fact, dim, "k", dim_key)
        assert set(out.columns) == {"id", "k", "v"} | {dim_key}
        at = out.filter("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
        got = {(r["k"], r["v"]) for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(at) > 1 and sum(r["count"] for r in at) == 6000
    assert got == {(None, None)} | {(i, 10 * i) for i in range(7)}
