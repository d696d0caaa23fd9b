"""NULL and edge cases, against the values a pandas user expects."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from islet.functions import scalars as S
from islet.operators import clean, monitor, profile, stats
from islet.sources import io


def test_winsorise_keeps_null(spark):
    df = spark.createDataFrame([(1.0,), (5.0,), (9.0,), (None,)], "x double")
    got = lambda mode: sorted((r["x"] for r in clean.winsorise(df, "x", mode, threshold=5.0).collect()), key=str)
    assert got("cap") == [1.0, 5.0, 5.0, None]
    assert got("remove") == [1.0, None]


def test_null_group_has_its_median(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 5.0), ("a", 2.0)], "g string, x double")
    got = {r["g"]: (r["mean"], r["median"]) for r in profile.group_summary(df, "g", "x").collect()}
    assert got == {None: (3.0, 3.0), "a": (2.0, 2.0)}
    assert {r["g"]: r["q50"] for r in profile.describe(df, "x", "g").collect()} == {None: 3.0, "a": 2.0}


def test_share_counts_null_as_not_met(spark):
    df = spark.createDataFrame([(1, "t"), (1, "f"), (1, None), (1, None)], "k int, x string")
    r = profile.share_where(df, "k", F.col("x") == "t").first()
    assert (r["n_true"], r["n"], r["pct"]) == (1, 4, 25.0)


def test_null_levels_leave_the_table(spark):
    rows = [("a", "x")] * 3 + [("a", "y")] + [("b", "x")] + [("b", "y")] * 4 + [(None, "x")] * 5 + [("a", None)]
    df = spark.createDataFrame(rows, "r string, c string")
    got = stats.chi2(df, "r", "c").first()
    assert (got["dof"], got["n"]) == (1, 9) and got["chi2"] == pytest.approx(2.7225)
    assert {r["r"] for r in profile.crosstab(df, "r", "c").collect()} == {"a", "b"}
    assert profile.crosstab_margins(df, "r", "c").filter("r = 'All' and c = 'All'").first()["n"] == 9


def test_unknown_label_sorts_last(spark):
    df = spark.createDataFrame([("b",), ("z",), ("a",), (None,)], "x string")
    assert {r[0]: r[1] for r in df.select("x", S.category_rank("x", ["a", "b"])).collect()} == {"a": 1, "b": 2, "z": 3, None: None}


def test_minutes_over_a_skipped_hour(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("select timestamp_ntz'2024-03-10 02:30:59' a, timestamp_ntz'2024-03-10 03:00:00' b")
        assert df.select(S.minute_boundaries("a", "b")).first()[0] == 30
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_shift_needs_five_rows(spark):
    rows = [("train", 0)] * 9 + [("post", 1)] * 4
    df = spark.createDataFrame(rows, "era string, f int")
    assert not monitor.feature_shift(df, ["f"]).first()["shifted"]
    more = df.union(spark.createDataFrame([("post", 1)], df.schema))
    assert monitor.feature_shift(more, ["f"]).first()["shifted"]


def test_model_metadata_keeps_booleans(spark, tmp_path):
    io.write_meta(spark, {"log_target": True, "alpha": 0.5, "n": 3, "coefficients": {"a": 1.0}}, str(tmp_path / "m"))
    got = io.read_meta(spark, str(tmp_path / "m"))
    assert got["log_target"] is True and got["alpha"] == 0.5 and got["coefficients"] == {"a": 1.0}


def test_null_date_is_no_active_day(spark):
    from islet.operators import rollup

    day = dt.date(2024, 1, 1)
    df = spark.createDataFrame([("v", None, "Edit", 60), ("v", day, "Edit", 60)], "k string, d date, c string, n long")
    got = rollup.entity_rollup(df, "k", "c", "d", "n", descriptive=[], phases={"work": ["Edit"]}, categories=[], creation_phases=["work"])
    assert got.first()["work_active_days"] == 1 and got.first()["active_days_worked"] == 1


def test_chi2_yates_and_empty_cells(spark):
    # 2 x 2 with an empty cell: 6, 2 / 4, 0; every |o - e| is 2/3
    rows = [("a", "x")] * 6 + [("a", "y")] * 2 + [("b", "x")] * 4 + [(None, "x"), ("b", None)]
    got = stats.chi2(spark.createDataFrame(rows, "r string, c string"), "r", "c").first()
    inv = 12 / 80 + 12 / 16 + 12 / 40 + 12 / 8
    assert (got["dof"], got["n"]) == (1, 12)
    assert got["chi2"] == pytest.approx((2 / 3) ** 2 * inv)
    assert got["chi2_corrected"] == pytest.approx((2 / 3 - 0.5) ** 2 * inv)


def test_one_hot_reference_level(spark):
    from islet.operators import features
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,), ("z",)], "k string")
    train = df.filter("k in ('a', 'b', 'c')")
    out, names = features.one_hot(train, df, "k", reference="b")
    assert names == ["k_a", "k_c"]
    assert [(r.k_a, r.k_c) for r in out.collect()] == [(1, 0), (0, 0), (0, 1), (0, 0), (0, 0)]
    with pytest.raises(ValueError):
        features.one_hot(train, df, "k", reference="z")


def test_reports_scan_once(spark):
    from islet.operators import monitor, profile
    from tests.conftest import SF
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    scored = li.select(F.lit("post").alias("era"), F.col("l_tax").alias("resid_a"), F.col("l_discount").alias("resid_b"))
    for df in (stats.pearson(li, ["l_quantity", "l_tax"], "l_extendedprice"), monitor.rmse_report(scored, ["a", "b"]),
               profile.row_checks(li, [profile.not_null("l_tax"), profile.accepted("l_linenumber", [1, 2])])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1
