"""FIXTURES §3.2 / §3.3 scalar, validation, model and monitoring cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from islet.functions import scalars as S
from islet.operators import features, models, monitor, profile, stats, validate
from tests.conftest import SF


def one(spark, expr, schema, row):
    return spark.createDataFrame([row], schema).select(expr.alias("v")).first().v


def test_12h_parse(spark):
    df = spark.createDataFrame([("9:05:00 AM",), ("12:05:00 AM",), ("10:05:00 PM",), ("junk",)], "t string")
    assert [r.v for r in df.select(S.time_12h_to_24h("t").alias("v")).collect()] == \
        ["09:05:00", "00:05:00", "22:05:00", None]


def test_md5_key(spark):
    assert one(spark, S.hash_key("a", "b", "c"), "a string, b string, c string", ("a", "b", "c")) == \
        "2e077b3ec5932ac3cf914ebdf242b4ee"
    assert one(spark, S.hash_key("a", "b", "c"), "a string, b string, c string", ("a", None, "c")) is None


def test_tiers(spark):
    df = spark.createDataFrame([(7,), (15,), (30,), (12,)], "m int")
    got = [(r.t, r.o) for r in df.select(S.length_tier("m").alias("t"), S.length_tier_ord("m").alias("o")).collect()]
    assert got == [("Short", 0), ("Average", 1), ("Long", 2), (None, None)]


def test_hour_bins(spark):
    df = spark.createDataFrame([(h,) for h in (5, 6, 11, 12, 17, 18)], "h int")
    got = [r.q for r in df.select(S.day_quarter("h").alias("q")).collect()]
    L = S.DAY_QUARTER_LABELS
    assert got == [L[0], L[1], L[1], L[2], L[2], L[3]]


def test_ridge_score_fixture(spark):
    m = {"intercept": 7.780522, "coefficients": {"length_tier_ord": 4.448954, "complexity_new": 2.959246,
                                                  "complexity_media_depth": 5.864206,
                                                  "complexity_delivery_style": 3.422362}}
    df = spark.createDataFrame([(1, 1, 1, 1), (0, 0, 0, 0)],
                               "length_tier_ord int, complexity_new int, complexity_media_depth int, complexity_delivery_style int")
    scored, dropped = monitor.score_pending(df, m)
    assert sorted(r.predicted_hours for r in scored.collect()) == [7.8, 24.5]
    assert dropped.first().n_dropped == 0


def test_fold_bounds():
    assert validate.rolling_fold_bounds(73) == [(25, 41), (41, 57), (57, 73)]
    assert validate.rolling_fold_bounds(75) == [(26, 42), (42, 58), (58, 74)]
    assert validate.inner_fold_bounds(73, 3) == [(19, 37), (37, 55), (55, 73)]
    assert validate.inner_fold_bounds(25, 3) == [(7, 13), (13, 19), (19, 25)]


def test_fold_frames_match_bounds(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderdate", "o_orderkey")
    n = o.count()
    f = validate.rolling_folds(o, ["o_orderdate", "o_orderkey"], n_blocks=3)
    for fold, (lo, hi) in enumerate(validate.rolling_fold_bounds(n)):
        test = f.filter((F.col("fold") == fold) & (F.col("role") == "test")).agg(F.min("idx"), F.max("idx"), F.count("*")).first()
        assert tuple(test) == (lo, hi - 1, hi - lo)
        assert f.filter((F.col("fold") == fold) & (F.col("role") == "train")).count() == lo


@pytest.mark.parametrize("alpha", [0.001, 0.719686, 10.0, 1e4])
def test_ridge_matches_numpy(spark, alpha):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    feats = ["l_quantity", "l_discount", "l_tax"]
    m = models.fit_ridge(li, feats, "l_extendedprice", alpha)
    pdf = li.select(*feats, "l_extendedprice").toPandas()
    X = pdf[feats].to_numpy()
    y = pdf["l_extendedprice"].to_numpy()
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(3), Xc.T @ yc)
    b = y.mean() - X.mean(0) @ w
    assert np.allclose([m["coefficients"][f] for f in feats], w, rtol=1e-8, atol=1e-8)
    assert abs(m["intercept"] - b) < 1e-6 * max(1, abs(b))


def test_inner_cv_matches_direct(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet").withColumn("x", F.col("o_custkey") / 100.0)
    o = o.withColumn("z", (F.col("o_orderstatus") == "F").cast("int"))
    t = models.tune_ridge(o, ["o_orderdate", "o_orderkey"], ["x", "z"], "o_totalprice", [0.1, 10.0], k=3, n_blocks=3)
    pdf = o.orderBy("o_orderdate", "o_orderkey").select("x", "z", "o_totalprice").toPandas()
    X, y = pdf[["x", "z"]].to_numpy(), pdf["o_totalprice"].to_numpy()
    rm = []
    for lo, hi in validate.inner_fold_bounds(len(y), 3):
        Xtr, ytr = X[:lo], y[:lo]
        xm, ym = Xtr.mean(0), ytr.mean()
        w = np.linalg.solve((Xtr - xm).T @ (Xtr - xm) + t["alpha"] * np.eye(2), (Xtr - xm).T @ (ytr - ym))
        pred = ym + (X[lo:hi] - xm) @ w
        rm.append(np.sqrt(np.mean((y[lo:hi] - pred) ** 2)))
    got = dict((a, m) for a, m, _ in t["curve"])[t["alpha"]]
    assert abs(got - np.mean(rm)) < 1e-6 * np.mean(rm)


def _drift_frame(spark, resids):
    rows = [(i, f"2030-01-{i + 1:02d}", float(r)) for i, r in enumerate(resids)]
    df = spark.createDataFrame(rows, "k long, d string, r double").withColumn("era", F.lit("post"))
    return monitor.drift_report(df, ["k"], "r", n_blocks=2)


def test_drift_edges(spark):
    d = _drift_frame(spark, [5.0, 5.0])
    assert d.count() == 0
    assert monitor.retrain_signal(d).first().drift_flag == 0
    assert monitor.retrain_signal(_drift_frame(spark, [2.0] * 5)).first().drift_flag == 0
    s = monitor.retrain_signal(_drift_frame(spark, [2.01] * 5)).first()
    assert (s.drift_flag, s.direction) == (1, "underpredicting")


def test_chi2_empty_cell_and_pvalue(spark):
    df = spark.createDataFrame([("a", "x")] * 10 + [("a", "y")] * 5 + [("b", "x")] * 7, "r string, c string")
    cells = {(r.r, r.c): r.observed for r in stats.chi2_cells(df, "r", "c").collect()}
    assert cells[("b", "y")] == 0
    assert abs(stats.chi2_pvalue(3.841458820694124, 1) - 0.05) < 1e-9
    assert abs(stats.chi2_pvalue(167.58, 21)) < 1e-20


def test_quantiles_match_numpy(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    got = profile.quantiles(li, "l_extendedprice", [0.0, 0.25, 0.5, 0.99, 1.0], n_blocks=5).first()
    v = li.select("l_extendedprice").toPandas()["l_extendedprice"].to_numpy()
    want = np.quantile(v, [0.0, 0.25, 0.5, 0.99, 1.0])
    assert np.allclose(list(got), want, rtol=1e-12)


def test_one_hot_unseen_level(spark):
    train = spark.createDataFrame([("a",), ("b",)], "t string")
    test = spark.createDataFrame([("a",), ("b",), ("c",)], "t string")
    out, names = features.one_hot(train, test, "t")
    assert names == ["t_b"]
    assert [r.t_b for r in out.orderBy("t").collect()] == [0, 1, 0]


def test_baseline_unseen_group(spark):
    s = spark.createDataFrame([("train", "g1", 2.0), ("train", "g1", 4.0), ("test", "g1", 5.0), ("test", "g2", 9.0)],
                              "role string, g string, y double")
    r = models.baseline_rmse(s, "y", ["g"]).first()
    assert (r.rmse, r.n_scored, r.n_test) == (2.0, 1, 2)


def test_label_checks(spark):
    lab = spark.createDataFrame([(1, 1, None, "k"), (0, None, 1, "k"), (1, 2, 0, "j")],
                                "is_complete int, flag int, other int, key string")
    res = {r.check: r.n_failures for r in profile.run_checks([
        profile.check_not_null(lab, "flag", where=F.col("is_complete") == 1),
        profile.check_accepted(lab, "flag", [0, 1]),
        profile.check_unique(lab, ["key"])]).collect()}
    assert res == {"not_null_where:flag": 0, "accepted_values:flag": 1, "unique:key": 1}


SEED = ("media_title string, video_type string, video_subtype string, expected_length_mins int, "
        "complexity_new int, complexity_media_depth int, complexity_delivery_style int, "
        "complexity_logistics int, complexity_worklife int, is_complete int")


def _seed_fail(spark, row):
    df = spark.createDataFrame([row], SEED)
    return {r.check: r.n_failures for r in features.seed_checks(df).collect() if r.n_failures}


def test_seed_checks_fixture(spark):
    # is_complete = 1 with a NULL flag fails; a flag of 2 fails; NULL flag on a planned row passes
    assert _seed_fail(spark, ("T", "R", "A", 15, None, 0, 0, 0, 0, 1)) == {"not_null_where:complexity_new": 1}
    assert _seed_fail(spark, ("T", "R", "A", 15, 2, 0, 0, 0, 0, 1)) == {"accepted_values:complexity_new": 1}
    assert _seed_fail(spark, ("T", "R", "A", 15, None, None, None, None, None, 0)) == {}


def test_duplicate_key_fails_before_join(spark):
    lab = spark.createDataFrame([("T", "R", "A", 15, 1, 0, 0, 0, 0, 1), ("T", "R", "A", 10, 1, 0, 0, 0, 0, 1)], SEED)
    ent = spark.createDataFrame([("T", "R", "A")], "media_title string, video_type string, video_subtype string")
    with pytest.raises(ValueError, match="duplicate natural key"):
        features.feature_table(ent, lab)


def test_spearman_matrix_matches_pairwise(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    m = {(r.x, r.y): r.r for r in stats.corr_matrix(li, ["l_quantity", "l_extendedprice", "l_discount"]).collect()}
    pair = stats.spearman(li, "l_quantity", "l_extendedprice", tie=["l_orderkey", "l_linenumber"], n_blocks=3).first().rho
    assert abs(m[("l_quantity", "l_extendedprice")] - pair) < 1e-9
    assert m[("l_discount", "l_discount")] == 1.0


@pytest.mark.parametrize("nb", [1, 3, 16])
def test_avg_rank_matches_pandas(spark, nb):
    import pandas as pd
    vals = [5, 1, 5, 5, 2, 2, 9, 5, 5, 5, 5, 1, 7, 7, 7, 7, 7, 7, 3]  # hot value crossing blocks
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "id long, v double")
    got = {r.id: r.rank_v for r in stats.avg_rank(df, "v", ["id"], n_blocks=nb).collect()}
    want = pd.Series(vals).rank(method="average").tolist()
    assert [got[i] for i in range(len(vals))] == want


def _np_ridge(X, y, alpha):
    xm, ym = X.mean(0), y.mean()
    w = np.linalg.solve((X - xm).T @ (X - xm) + alpha * np.eye(X.shape[1]), (X - xm).T @ (y - ym))
    return ym - xm @ w, w


def _np_rolling_cv(X, y, alphas, log, n_folds=3, start=0.35, k=3, min_train=10):
    n = len(y)
    st = int(n * start)
    fs = (n - st) // n_folds
    ok = ~(np.isnan(X).any(1) | np.isnan(y))
    out = []
    for f in range(n_folds):
        lo, hi = st + f * fs, st + (f + 1) * fs
        tr = np.arange(lo)[ok[:lo]]
        te = np.arange(lo, hi)[ok[lo:hi]]
        if len(tr) < min_train or len(te) == 0:
            continue
        Xt, yt = X[tr], (np.log(y[tr]) if log else y[tr])
        m = len(yt)
        ts = m // (k + 1)
        scores = []
        for a in alphas:
            r = []
            for j in range(k):
                s0, s1 = m - (k - j) * ts, m - (k - j - 1) * ts
                b, w = _np_ridge(Xt[:s0], yt[:s0], a)
                r.append(np.sqrt(np.mean((yt[s0:s1] - (b + Xt[s0:s1] @ w)) ** 2)))
            scores.append(np.mean(r))
        a = alphas[int(np.argmin(scores))]
        b, w = _np_ridge(Xt, yt, a)
        p = b + X[te] @ w
        p = np.exp(p) if log else p
        out.append((f, a, float(np.sqrt(np.mean((y[te] - p) ** 2)))))
    return out


@pytest.mark.parametrize("log", [False, True])
def test_rolling_cv_ridge_matches_numpy(spark, log):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    o = o.withColumns({"f1": F.when(F.col("o_orderkey") % 13 == 0, None).otherwise((F.col("o_orderstatus") == "F").cast("double")),
                       "f2": (F.col("o_custkey") % 7).cast("double"),
                       "y": F.col("o_totalprice") / 10000.0})
    alphas = [0.01, 1.0, 100.0]
    got = models.rolling_cv_ridge(o, ["o_orderdate", "o_orderkey"], ["f1", "f2"], "y", alphas, log=log, n_blocks=3)
    pdf = o.orderBy("o_orderdate", "o_orderkey").select("f1", "f2", "y").toPandas()
    want = _np_rolling_cv(pdf[["f1", "f2"]].to_numpy(dtype=float), pdf["y"].to_numpy(dtype=float), alphas, log)
    assert [(g["fold"], g["alpha"]) for g in got] == [(f, a) for f, a, _ in want]
    assert np.allclose([g["rmse"] for g in got], [r for _, _, r in want], rtol=1e-9)


def test_log_ridge_curve_is_on_the_raw_scale(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=40)
    y = np.exp(0.4 * x + 1 + rng.normal(scale=0.2, size=40))
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))], "i long, x double, y double")
    m = models.tune_ridge(df, ["i"], ["x"], "y", [1.0, 10.0], k=3, log=True)
    for alpha, mean, std in m["curve"]:
        errs = []
        for lo in (10, 20, 30):
            a, t = x[:lo], np.log(y[:lo])
            w = ((a - a.mean()) * (t - t.mean())).sum() / (((a - a.mean()) ** 2).sum() + alpha)
            pred = np.exp(t.mean() + w * (x[lo:lo + 10] - a.mean()))
            errs.append(np.sqrt(((pred - y[lo:lo + 10]) ** 2).mean()))
        assert (mean, std) == (pytest.approx(np.mean(errs)), pytest.approx(np.std(errs)))


def test_nested_tree_cv_never_sees_later_rows(spark):
    # the label jumps in the last quarter: folds before it fit exactly
    df = spark.range(100).select(F.col("id").alias("i"), (F.col("id") % 2).alias("x"),
                                 F.when(F.col("id") < 75, F.col("id") % 2).otherwise(50).alias("y"))
    got = models.rolling_cv_trees(df, ["i"], ["x"], "y", [{"n_trees": 3, "depth": 1}, {"n_trees": 3, "depth": 2}])
    assert [r["n_train"] for r in got] == [r["n_test"] * j + got[0]["n_train"] for j, r in enumerate(got)]
    assert got[0]["rmse"] == pytest.approx(0, abs=1e-9) and got[-1]["rmse"] > 10
