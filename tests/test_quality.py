from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staffmart.operators import quality


@pytest.fixture
def people(spark):
    return spark.createDataFrame([
        (1, "a", dt.date(1990, 1, 1), 100.0, "12.5", 1),
        (2, "a", dt.date(1899, 1, 1), -5.0, "12.", 2),
        (2, None, dt.date(2030, 1, 1), 0.0, "1.2E8", 5),
        (3, "b", None, None, None, None),
    ], "hr_id int, cpf string, birth date, salary double, taxes string, imp int")


RULES = [
    quality.not_null("cpf"),
    quality.unique("cpf"),
    quality.unique("hr_id"),
    quality.between("birth", dt.date(1900, 1, 1), dt.date(2024, 1, 1)),
    quality.between("salary", 0, None),
    quality.matches("taxes", r"^\d+\.?\d*$"),
    quality.in_set("imp", [1, 2, 3, 4]),
]


def test_one_pass_report(people):
    rows = {(r["rule"], r["column_name"]): r for r in
            quality.quality_report(people, RULES).collect()}
    assert set(rows) == {(r.rule, r.column) for r in RULES}
    assert (rows[("not_null", "cpf")]["evaluated"], rows[("not_null", "cpf")]["unexpected"]) == (4, 1)
    assert rows[("unique", "cpf")]["unexpected"] == 2          # both rows of the repeated value
    assert rows[("unique", "cpf")]["evaluated"] == 3           # NULL skipped
    assert rows[("unique", "hr_id")]["unexpected"] == 2
    assert (rows[("between", "birth")]["evaluated"], rows[("between", "birth")]["unexpected"]) == (3, 2)
    assert rows[("between", "salary")]["unexpected"] == 1
    assert rows[("matches", "taxes")]["unexpected"] == 1
    assert rows[("in_set", "imp")]["unexpected"] == 1
    assert not rows[("in_set", "imp")]["success"]


def test_assert_quality_lists_every_failure(people):
    rows = quality.collect_report(quality.quality_report(people, RULES))
    with pytest.raises(quality.QualityError) as err:
        quality.assert_quality(rows)
    assert "unique(cpf)" in str(err.value) and "in_set(imp)" in str(err.value)
    ok = quality.collect_report(quality.quality_report(people.filter("hr_id = 1"), RULES))
    assert quality.assert_quality(ok)


def test_quarantine_split(people):
    passing, failing = quality.split_quarantine(people, RULES)
    assert [r["hr_id"] for r in passing.collect()] == [3]
    labels = sorted((r["hr_id"], r["cpf"] or "", r[quality.FAILED_COLUMN]) for r in failing.collect())
    assert labels[0] == (1, "a", "unique(cpf)")
    assert labels[1] == (2, "", "not_null(cpf),between(birth),matches(taxes),in_set(imp),unique(hr_id)")
    assert labels[2] == (2, "a", "between(birth),between(salary),unique(cpf),unique(hr_id)")
    good, _ = quality.split_quarantine(people, [quality.not_null("cpf")])
    assert good.count() == 3 and quality.FAILED_COLUMN not in good.columns


def test_schema_assertion_needs_no_job(spark):
    df = spark.createDataFrame([("x",)], "d string")
    with pytest.raises(ValueError):
        quality.assert_column_types(df, {"d": T.DateType()})
    quality.assert_column_types(df.select(F.col("d").try_cast("date").alias("d")),
                                {"d": T.DateType()})


def test_report_from_labels_equals_one_pass_report(people):
    def as_set(df):
        return {(r["rule"], r["column_name"], r["evaluated"], r["unexpected"], r["success"])
                for r in df.collect()}
    labelled = quality.label_rows(people, RULES)
    assert as_set(quality.report_from_labels(labelled, RULES)) == \
        as_set(quality.quality_report(people, RULES))


def test_cells_lost_to_a_cast_are_reported_with_their_text(spark):
    df = spark.createDataFrame([("1", "5"), ("2", "abc"), ("3", " "), ("4", None)], "id string, n string")
    cast = quality.cast_noting_losses(df, {"n": F.col("n").try_cast("int")})
    passing, failing = quality.split_quarantine(cast, [quality.castable("n")])
    assert sorted((r["id"], r["n"]) for r in passing.collect()) == [("1", 5), ("3", None), ("4", None)]
    (bad,) = failing.collect()
    assert bad["id"] == "2" and bad[quality.UNCAST_COLUMN] == {"n": "abc"}
    assert bad[quality.FAILED_COLUMN] == "castable(n)"


def test_observed_halves_give_the_report(people, tmp_path):
    passing, failing, seen = quality.split_observed(quality.label_rows(people, RULES), RULES)
    passing.write.parquet(str(tmp_path / "good"))
    failing.write.parquet(str(tmp_path / "bad"))
    by = lambda rows: sorted(rows, key=lambda r: (r["rule"], r["column_name"]))
    assert by(seen.report()) == by(quality.collect_report(quality.quality_report(people, RULES)))
    assert seen.quarantined() == 3


def test_duplicates_are_marked_without_moving_other_rows(spark):
    n = 40_000
    df = spark.range(n).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 1000 = 1 THEN NULL ELSE concat('u', id) END AS cpf",
        "CASE WHEN id IN (5, 17) THEN -1L ELSE id END AS hr_id", "repeat('x', 50) AS wide")
    rules = [quality.unique("cpf"), quality.unique("hr_id"), quality.unique("id")]
    passing, failing = quality.split_quarantine(df, rules)
    assert passing.columns == df.columns
    bad = {r["id"]: r[quality.FAILED_COLUMN] for r in failing.select("id", quality.FAILED_COLUMN).collect()}
    assert bad == {i: "unique(cpf)" for i in range(0, n, 3)} | {5: "unique(hr_id)", 17: "unique(hr_id)"}
    assert passing.count() == n - len(bad)
    plan = df._jdf.sparkSession().sessionState().executePlan(
        passing._jdf.queryExecution().logical(), passing._jdf.queryExecution().mode()).executedPlan().toString()
    # rows without a duplicate pass broadcast joins with the bitmaps only
    assert plan.count("Union") >= 1
    clean, none = quality.split_quarantine(df, [quality.unique("id")])
    assert clean.count() == n and none.count() == 0


@pytest.mark.parametrize("bits", [1 << 15])
def test_a_full_bitmap_changes_nothing(spark, monkeypatch, bits):
    monkeypatch.setattr(quality, "MOST_BITS", bits)
    df = spark.range(60_000).selectExpr("id", "id % 50000 AS k")
    _, failing = quality.split_quarantine(df, [quality.unique("k")])
    assert failing.count() == 20_000


def test_a_cast_is_worked_out_once(spark):
    df = spark.createDataFrame([(1, "5", "x"), (2, "junk", " "), (3, None, "7")], "id int, a string, b string")
    out = quality.cast_noting_losses(df, {c: F.col(c).try_cast("int") + F.floor(F.rand()) for c in "ab"}, later=["b"])
    assert out.columns == ["id", "a", "b", quality.UNCAST_COLUMN]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("rand(") == 2
    assert [(r["a"], r["b"], r[quality.UNCAST_COLUMN]) for r in out.orderBy("id").collect()] == [
        (5, "x", {"b": "x"}), (None, " ", {"a": "junk"}), (None, "7", {})]
