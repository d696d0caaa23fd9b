"""P-values, many-column statistics, chosen bins, labels and the run sink."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from islet.operators import clean, monitor, profile, stats
from islet.sources import io


def test_p_values_in_the_plan(spark):
    cases = [(x, d) for d in (1, 2, 3, 4, 7, 12, 21, 100, 999, 3000) for x in (0.0, 0.01, 0.9, 1.0, 3.84, 12.0, 17.9, 18.1, 40.0, 167.58, 900.0, 3100.0)]
    got = spark.createDataFrame(cases, "x double, d long").select("x", "d", stats.chi2_upper(F.col("x"), F.col("d")).alias("p")).collect()
    for r in got:
        assert r["p"] == pytest.approx(stats.chi2_pvalue(r["x"], r["d"]), abs=1e-9, rel=1e-6), r


def test_p_column_of_a_table(spark):
    rows = [("a", "x")] * 30 + [("a", "y")] * 10 + [("b", "x")] * 12 + [("b", "y")] * 25 + [(None, "x"), ("a", None)]
    r = stats.chi2(spark.createDataFrame(rows, "r string, c string"), "r", "c").first()
    assert r["dof"] == 1 and r["p"] == pytest.approx(stats.chi2_pvalue(r["chi2_corrected"], 1), abs=1e-12)
    assert stats.chi2(spark.createDataFrame([("a", "x")] * 3, "r string, c string"), "r", "c").first()["p"] is None


def numbers(n=300):
    rng = np.random.default_rng(3)
    d = pd.DataFrame({"a": rng.normal(10, 3, n), "b": rng.integers(0, 6, n).astype(float), "c": rng.exponential(2, n)})
    d.loc[rng.random(n) < 0.1, "b"] = np.nan
    d["d"] = np.nan
    return d


def frame(spark, d):
    return spark.createDataFrame([tuple(None if v != v else float(v) for v in r) for r in d.itertuples(index=False)], ", ".join(f"{c} double" for c in d.columns))


@pytest.mark.parametrize("blocks", [1, 5])
def test_describe_of_many_columns_is_pandas(spark, blocks):
    d = numbers()
    got = {r["column"]: r for r in profile.describe_many(frame(spark, d), list(d.columns), [0.1, 0.5, 0.75], n_blocks=blocks).collect()}
    for c in "abc":
        want = d[c].describe(percentiles=[0.1, 0.5, 0.75])
        assert got[c]["count"] == want["count"]
        for name, key in (("mean", "mean"), ("std", "std"), ("min", "min"), ("q10", "10%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")):
            assert got[c][name] == pytest.approx(want[key])
    assert got["d"]["count"] == 0 and got["d"]["q50"] is None


def test_describe_stays_in_the_jvm(spark, capsys):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    profile.describe_many(df, ["l_quantity", "l_tax"]).explain("formatted")
    plan = capsys.readouterr().out
    assert not any(x in plan for x in ("CartesianProduct", "NestedLoopJoin", "EvalPython"))


def test_spearman_of_all_pairs_is_pandas(spark):
    d = numbers().drop(columns="d")
    got = {(r["x"], r["y"]): r["r"] for r in stats.corr_matrix(frame(spark, d), ["a", "b", "c"], "spearman").collect()}
    want = d.dropna().corr("spearman")
    assert all(got[x, y] == pytest.approx(want.loc[x, y]) for x in "abc" for y in "abc")
    got = {(r["x"], r["y"]): r["r"] for r in stats.corr_matrix(frame(spark, d), ["a", "c"], "pearson").collect()}
    assert got["a", "c"] == pytest.approx(d.dropna().corr().loc["a", "c"], abs=0.1)


@pytest.mark.parametrize("values", [np.random.default_rng(0).normal(0, 1, 500), np.random.default_rng(1).exponential(1, 90), [5.0] * 4, [0.0, 10.0]])
def test_bins_chosen_by_the_data_are_numpys(spark, values):
    got = profile.histogram_auto(spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double"), "v").collect()
    counts, edges = np.histogram(values, bins="auto") if len(set(values)) > 1 else (np.array([len(values)]), np.array([values[0], values[0]]))
    assert {r["n_bins"] for r in got} == {len(counts)}
    assert {r["bin"]: r["count"] for r in got} == {i: c for i, c in enumerate(counts) if c}
    assert all(r["bin_lo"] == pytest.approx(edges[r["bin"]]) for r in got)


def test_bins_without_spread_between_the_quartiles(spark):
    got = profile.histogram_auto(spark.createDataFrame([(1.0,)] * 9 + [(2.0,)], "v double"), "v").collect()
    assert {(r["bin"], r["count"], r["n_bins"]) for r in got} == {(0, 9, 5), (4, 1, 5)}, "Sturges' five bins"


def test_histogram_of_nothing(spark):
    assert profile.histogram_auto(spark.createDataFrame([], "v double"), "v").count() == 0


def test_medians_gates_and_labels(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 90.0), ("b", 4.0), (None, None)], "k string, v double")
    r = profile.summary_with_without(df, "v", F.col("v") > 50).first()
    assert (r["median_all"], r["median_without"], r["n_outliers"]) == (3.0, 2.0, 1)
    got = {x["k"]: x["m"] for x in clean.relabel(df, "k", {"a": "first"}, "m").collect()}
    assert got == {"a": "first", "b": "b", None: None}
    days = spark.createDataFrame([("few", f"2024-01-0{i}", float(i)) for i in range(1, 5)] + [("many", f"2024-01-0{i}", 2.0 * i) for i in range(1, 6)], "k string, d string, v double")
    line = {x["k"]: x for x in profile.group_trend(days, "k", "d", "v").collect()}
    assert line["few"]["slope"] is None and line["few"]["n"] == 4 and line["many"]["slope"] == pytest.approx(2.0)
    share = profile.crosstab_long(days.withColumn("e", F.col("v") > 4), "k", "e", "all").agg(F.sum("share")).first()[0]
    assert share == pytest.approx(1.0)


def test_absent_tiers_and_ranks(spark):
    s = spark.createDataFrame([("train", 1, 0.5), ("train", 2, 1.0), ("train", None, 2.0), ("post", 1, 1.5)], "era string, t int, r double")
    got = {(x["era"], x["t"]): (x["n"], x["pct"]) for x in monitor.tier_mix(s, "t").collect()}
    assert got["post", 2] == (0, 0.0) and got["post", None] == (0, 0.0) and got["post", 1] == (1, 100.0) and len(got) == 6
    ranks = {x["era"]: x["rank"] for x in monitor.residuals_by(s, "era", "r").collect()}
    assert ranks == {"train": 1, "post": 2}


def test_a_repeated_run_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "runs")
    steps = spark.createDataFrame([("rmse", 0, 3.0), ("rmse", 1, 2.5)], "key string, step int, value double")
    for run, alpha, extra in (("r1", 1, steps), ("r2", 2, None), ("r1", 1, steps)):
        io.append_run(spark, path, "e", run, f"run {run}", {"alpha": alpha}, {"mae": 0.25}, extra)
    io.append_run(spark, path, "other", "r1", "run r1", {"alpha": 9}, {})
    assert spark.read.parquet(path).filter("experiment = 'e' and run_id = 'r1'").count() == 4
    got = {(r["experiment"], r["run_id"]): r for r in io.read_runs(spark, path, ["alpha"], ["mae", "rmse"]).collect()}
    assert len(got) == 3 and got["e", "r1"]["alpha"] == "1" and got["e", "r1"]["rmse"] == 2.5 and got["e", "r2"]["rmse"] is None and got["other", "r1"]["alpha"] == "9"
    assert sorted((r["step"], r["value"]) for r in io.metric_series(spark, path, "rmse").filter("run_id = 'r1'").collect()) == [(0, 3.0), (1, 2.5)]


def test_normal_distance_is_the_largest_gap(spark):
    import math

    import numpy as np

    from islet.operators import stats

    rng = np.random.default_rng(5)
    for values, nb in (([*rng.normal(3, 2, 300), *[3.5] * 120], 7), (list(rng.exponential(1, 200)), 1), ([-40.0, *range(30), 400.0], 64)):
        x = np.sort(np.array(values, float))
        z = (x - x.mean()) / x.std(ddof=1)
        p = np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in z])
        n = len(x)
        upto, below = np.searchsorted(x, x, "right") / n, np.searchsorted(x, x, "left") / n
        want = max(np.abs(upto - p).max(), np.abs(p - below).max())
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double")
        r = stats.normal_distance(df, "v", n_blocks=nb).first()
        assert r["n"] == n and abs(r["distance"] - want) < 1e-12 and abs(r["std"] - x.std(ddof=1)) < 1e-9


def test_normal_distance_without_spread(spark):
    from islet.operators import stats

    for rows in ([], [(None,)], [(1.0,)], [(2.0,), (2.0,)]):
        r = stats.normal_distance(spark.createDataFrame(rows, "v double"), "v").first()
        assert r["distance"] is None and r["n"] == sum(v is not None for v, in rows)


def test_ranks_take_a_row_for_each_value(spark, monkeypatch):
    from islet.operators import joins, ordered

    d = pd.DataFrame({"a": [float(i % 3) for i in range(300)], "b": [float(i * i % 17) for i in range(300)]})
    seen, blocks = [], ordered.range_blocks
    monkeypatch.setattr(ordered, "range_blocks", lambda df, *a, **k: seen.append(df.count()) or blocks(df, *a, **k))
    for most in (joins.BROADCAST_MAX_ROWS, 2):  # broadcast ranks, and joined ones
        monkeypatch.setattr(stats, "small_side", lambda x, most=most: joins.small_side(x, most), raising=False)
        got = {(r["x"], r["y"]): r["r"] for r in stats.corr_matrix(frame(spark, d), ["a", "b"], "spearman").collect()}
        assert got["a", "b"] == pytest.approx(d.corr("spearman").loc["a", "b"]) and got["a", "a"] == pytest.approx(1)
    assert max(seen) == d.b.nunique()
