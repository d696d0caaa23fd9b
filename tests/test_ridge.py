"""Ridge solved in the plan against numpy and the Gram-based driver solution."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from islet.operators import models, ridge

FEATS = ["a", "b", "c"]
ALPHAS = [0.01, 1.0, 30.0, 1000.0]


def table(spark, n=200, nulls=True):
    rng = np.random.default_rng(4)
    d = pd.DataFrame({"i": np.arange(n), "a": rng.integers(0, 5, n), "b": rng.normal(50, 3, n), "c": rng.integers(0, 2, n)})
    d["y"] = 2.0 * d.a - 0.3 * d.b + d.c + rng.normal(0, 2, n) + 1000
    gone = rng.random(n) < (0.1 if nulls else 0)
    rows = [(int(r.i), int(r.a), None if g else float(r.b), int(r.c), float(r.y)) for r, g in zip(d.itertuples(), gone)]
    return d[~gone], spark.createDataFrame(rows, "i long, a int, b double, c int, y double")


@pytest.mark.parametrize("p", [1, 2, 6])
def test_solve_is_numpys(spark, p):
    rng = np.random.default_rng(p)
    rows, want = [], []
    for _ in range(20):
        m = rng.normal(size=(p + 3, p))
        a, b = m.T @ m + 0.01 * np.eye(p), rng.normal(size=p)
        rows.append((a.tolist(), b.tolist()))
        want.append(np.linalg.solve(a, b))
    got = spark.createDataFrame(rows, "a array<array<double>>, b array<double>").select(ridge.solve(F.col("a"), F.col("b")).alias("x")).collect()
    for r, w in zip(got, want):
        assert r["x"] == pytest.approx(w, rel=1e-7)


def test_fit_is_the_closed_form(spark):
    d, df = table(spark)
    got = {r["term"]: r["value"] for r in ridge.fit(df, FEATS, "y", 7.5).collect()}
    x = d[FEATS].to_numpy(float)
    c = x - x.mean(0)
    w = np.linalg.solve(c.T @ c + 7.5 * np.eye(3), c.T @ (d.y - d.y.mean()))
    assert [got[f] for f in FEATS] == pytest.approx(w) and got["intercept"] == pytest.approx(d.y.mean() - x.mean(0) @ w)


def test_curve_tuned_and_rolling_equal_the_driver_solution(spark):
    _, df = table(spark)
    want = models.tune_ridge(df, ["i"], FEATS, "y", ALPHAS)
    curve = {r["alpha"]: r for r in ridge.curve(df, ["i"], FEATS, "y", ALPHAS).collect()}
    for alpha, mean, std in want["curve"]:
        assert curve[alpha]["mean_rmse"] == pytest.approx(mean) and curve[alpha]["std_rmse"] == pytest.approx(std)
    got = {r["term"]: (r["value"], r["alpha"]) for r in ridge.tuned(df, ["i"], FEATS, "y", ALPHAS).collect()}
    assert got["intercept"] == (pytest.approx(want["intercept"]), want["alpha"])
    assert [got[f][0] for f in FEATS] == pytest.approx([want["coefficients"][f] for f in FEATS])
    folds = models.rolling_cv_ridge(df, ["i"], FEATS, "y", ALPHAS)
    rolled = sorted(ridge.rolling_cv(df, ["i"], FEATS, "y", ALPHAS).collect(), key=lambda r: r["fold"])
    assert len(rolled) == len(folds) == 3
    for r, f in zip(rolled, folds):
        assert (r["alpha"], r["n_train"], r["n_test"]) == (f["alpha"], f["n_train"], f["n_test"]) and r["rmse"] == pytest.approx(f["rmse"])


def test_ridge_of_nothing(spark):
    _, df = table(spark)
    none = df.limit(0)
    assert ridge.rolling_cv(none, ["i"], FEATS, "y", ALPHAS).count() == 0
    assert ridge.curve(none, ["i"], FEATS, "y", ALPHAS).count() == 0
    assert ridge.fit(none, FEATS, "y", 1.0).count() == 0
