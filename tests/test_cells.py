"""Tree models on cells against fits on rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from islet.operators import cells, models

FEATS = ["a", "b"]


def table(spark, n=240, seed=1, nulls=True):
    rng = np.random.default_rng(seed)
    d = pd.DataFrame({"i": np.arange(n), "a": rng.integers(0, 4, n), "b": rng.integers(0, 2, n)})
    d["y"] = 3.0 * (d.a > 1) + d.b * d.a + rng.normal(0, 1, n)
    if nulls:
        d["y"] = d.y.where(rng.random(n) > 0.05)
    return d, spark.createDataFrame([(int(i), int(a), int(b), None if y != y else float(y)) for i, a, b, y in d.itertuples(index=False)], "i long, a int, b int, y double")


def row_tree(x, y, w, depth, least):
    """A least-squares tree on rows, by trying every split of every row set."""
    def fit(at, level):
        s, t = (w[at] * y[at]).sum(), w[at].sum()
        value, best = (s / t if t else 0.0), None
        if not (depth and level == depth):
            for j in range(x.shape[1]):
                held = np.unique(x[at, j])
                for lo, hi in zip(held, held[1:]):
                    left, right = at[x[at, j] <= lo], at[x[at, j] > lo]
                    if min(len(left), len(right)) < least:
                        continue
                    gain = sum((w[p] * y[p]).sum() ** 2 / w[p].sum() for p in (left, right)) - s * s / t
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, j, (lo + hi) / 2, left, right)
        if best is None:
            return lambda row: value
        f, g = fit(best[3], level + 1), fit(best[4], level + 1)
        return lambda row: f(row) if row[best[1]] <= best[2] else g(row)

    return fit(np.flatnonzero(w > 0), 0)


@pytest.mark.parametrize("depth, least", [(1, 1), (2, 2), (3, 5), (0, 2), (0, 30)])
def test_trees_on_cells_are_trees_on_rows(depth, least):
    rng = np.random.default_rng(depth + least)
    for _ in range(15):
        rows = rng.integers(5, 60)
        x = np.stack([rng.integers(0, k, rows) for k in (4, 2, 3)], 1).astype(float)
        y = x @ [1.0, 2.0, -1.0] + rng.normal(0, 1, rows)
        weights = rng.poisson(1, (3, rows)).astype(float)
        vectors, code = np.unique(x, axis=0, return_inverse=True)
        code = code.reshape(-1)
        total = lambda v: np.stack([np.bincount(code, r, len(vectors)) for r in v])
        got = cells.grow(vectors, total(weights > 0), total(weights), total(weights * y), depth, least)
        for t in range(3):
            tree = row_tree(x, y, weights[t], depth, least)
            assert got[t] == pytest.approx([tree(v) for v in vectors])


def test_an_unbagged_tree_is_mllibs(spark):
    d, df = table(spark, 400, nulls=False)
    model = models.fit_forest(df, FEATS, "y", n_trees=1, depth=2, min_leaf=2, bootstrap=False)
    want = models.predict_tree(df, model, FEATS, "p").groupBy(*FEATS).agg(F.first("p").alias("p")).toPandas().sort_values(FEATS)
    c = cells.cube(df.withColumn("segment", F.lit(0)), FEATS, "y").toPandas().sort_values(FEATS)
    got = cells.grow(c[FEATS].to_numpy(float), c[["n"]].to_numpy(float).T, c[["n"]].to_numpy(float).T, c[["sum_y"]].to_numpy().T, 2, 2)
    assert got[0] == pytest.approx(want.p.to_numpy())


def draws(d, replicates, share=None):
    """Weights by the row's hash, in plain Python."""
    from hashlib import md5
    from math import exp, factorial

    steps = [int(sum(exp(-1) / factorial(i) for i in range(k + 1)) * cells.PRIME) for k in range(12)]
    out = np.zeros((replicates, len(d)))
    for at, i in enumerate(d.i):
        h = md5(str(i).encode()).hexdigest()
        a, b, c = (int(h[8 * k : 8 * k + 8], 16) % cells.PRIME for k in range(3))
        for r in range(replicates):
            u = (a + b * r + c * r * r) % cells.PRIME
            out[r, at] = sum(u >= s for s in steps) if share is None else u < int(share * cells.PRIME)
    return out


@pytest.mark.parametrize("share", [None, 0.7])
def test_replicates_are_the_rows_draws(spark, share):
    d, df = table(spark, nulls=False)
    want = draws(d, 30, share)
    assert abs(want.mean() - (share or 1)) < 0.05
    for x in (df, df.repartition(7)):
        got = cells.replicate_cube(x.withColumn("segment", F.col("i") % 2), FEATS, "y", ["i"], 30, share).collect()
        assert sum(r["weight"] for r in got) == want.sum()
        for r in got[::17]:
            own = ((d.i % 2 == r["segment"]) & (d.a == r["a"]) & (d.b == r["b"])).to_numpy()
            w = want[r["replicate"], own]
            assert (r["n"], r["weight"]) == ((w > 0).sum(), w.sum()) and r["sum_y"] == pytest.approx((w * d.y[own]).sum())


def test_stumps_in_the_plan_are_grown_stumps(spark):
    d, df = table(spark, nulls=False)
    bag = cells.replicate_cube(df.withColumn("segment", F.lit(0)), FEATS, "y", ["i"], 25)
    found = cells.stumps(bag, FEATS)
    got = {r["replicate"]: r for r in found.collect()}
    w, x = draws(d, 25), d[FEATS].to_numpy(float)
    vectors = np.unique(x, axis=0)
    every = []
    for r in range(25):
        tree = row_tree(x, d.y.to_numpy(), w[r], 1, 2)
        side = lambda v: got[r]["left_mean"] if v[FEATS.index(got[r]["feature"])] <= got[r]["threshold"] else got[r]["right_mean"]  # noqa: E731, B023
        every.append([tree(v) for v in vectors])
        assert [side(v) for v in vectors] == pytest.approx(every[-1])
    mean = {(r["a"], r["b"]): r["prediction"] for r in cells.stump_forest(df, found, FEATS).collect()}
    assert [mean[tuple(v)] for v in vectors] == pytest.approx(np.mean(every, 0))


def test_nested_search_is_the_search_on_rows(spark):
    d, df = table(spark)
    grid = {"n_trees": [3, 8], "depth": [1, 2], "min_leaf": [2, 20]}
    scores = cells.search(df, ["i"], FEATS, "y", "forest", grid, whole=True)
    got = {(r["outer"], r["part"], r["n_trees"], r["depth"], r["min_leaf"]): r for r in scores.collect()}
    weights, n = draws(d, 8), len(d)
    start = int(n * 0.35)
    size, full = (n - start) // 3, d.y.notna().to_numpy()
    rank = np.cumsum(full) - full
    for outer in range(4):
        lo, hi = (start + outer * size, start + (outer + 1) * size) if outer < 3 else (n, n)
        a, b = full[:lo].sum(), full[:hi].sum()
        t = a // 4
        parts = [(j, a - (3 - j) * t, a - (2 - j) * t) for j in range(3)] + [(-1, a, b)]
        for part, p, q in parts:
            if p == q:
                continue
            train, test = full & (rank < p), full & (rank >= p) & (rank < q)
            for depth in (1, 2):
                trees = [row_tree(d[FEATS].to_numpy(float)[train], d.y.to_numpy()[train], w[train], depth, 20) for w in weights]
                each = np.array([[f(v) for v in d[FEATS].to_numpy(float)[test]] for f in trees])
                for k in (3, 8):
                    r = got[outer, part, k, depth, 20]
                    assert (r["n_train"], r["n_test"]) == (p, q - p)
                    assert r["rmse"] == pytest.approx(np.sqrt(np.mean((each[:k].mean(0) - d.y.to_numpy()[test]) ** 2)))
    point = ["n_trees", "depth", "min_leaf"]
    for r in cells.nested_cv(scores, point).collect():
        mean = {key[2:]: np.mean([got[r["fold"], j, *key[2:]]["rmse"] for j in range(3)]) for key in got if key[0] == r["fold"]}
        best = min(mean, key=lambda k: (mean[k], k))
        assert (r["n_trees"], r["depth"], r["min_leaf"]) == best and r["rmse"] == got[r["fold"], -1, *best]["rmse"]
    scape = cells.landscape(scores.filter("outer = 3"), point)
    heat = {(r["depth"], r["min_leaf"]): r for r in cells.best_per_cell(scape, ["depth", "min_leaf"]).collect()}
    for r in scape.collect():
        assert heat[r["depth"], r["min_leaf"]]["mean_rmse"] <= r["mean_rmse"]


def test_boosting_fits_residuals(spark):
    d, df = table(spark, nulls=False)
    grid = {"rounds": [2, 5], "depth": [1], "rate": [0.5], "subsample": [0.7, 1.0]}
    got = {(r["part"], r["rounds"], r["subsample"]): r["rmse"] for r in cells.search(df, ["i"], FEATS, "y", "boosted", grid, folds=0, whole=True).collect()}
    x, y, n = d[FEATS].to_numpy(float), d.y.to_numpy(), len(d)
    w = draws(d, 5, 0.7)
    for part in range(3):
        lo, hi = n - (3 - part) * (n // 4), n - (2 - part) * (n // 4)
        for share in (0.7, 1.0):
            pred = np.full(n, y[:lo].mean())
            for r in range(5):
                own = np.flatnonzero(w[r, :lo] > 0) if share < 1 else np.arange(lo)
                res, best = y - pred, None
                for j in range(2):
                    for c in np.unique(x[own, j])[:-1]:
                        left, right = own[x[own, j] <= c], own[x[own, j] > c]
                        gain = sum(res[p].sum() ** 2 / (len(p) + 1) for p in (left, right)) - res[own].sum() ** 2 / (len(own) + 1)
                        if best is None or gain > best[0] + 1e-9:
                            best = (gain, j, c, res[left].sum() / (len(left) + 1), res[right].sum() / (len(right) + 1))
                if best[0] > 0:
                    pred = pred + 0.5 * np.where(x[:, best[1]] <= best[2], best[3], best[4])
                else:
                    pred = pred + 0.5 * res[own].sum() / (len(own) + 1)
                if r + 1 in (2, 5):
                    assert got[part, r + 1, share] == pytest.approx(np.sqrt(np.mean((pred[lo:hi] - y[lo:hi]) ** 2)))


def test_search_of_nothing(spark):
    none = spark.createDataFrame([], "i long, a int, b int, y double")
    assert cells.search(none, ["i"], FEATS, "y").count() == 0


def test_replicates_keep_null_features_and_labels(spark):
    d, _ = table(spark, 150, nulls=False)
    rows = [(int(i), None if i % 7 == 0 else int(a), int(b), None if i % 5 == 0 else float(y)) for i, a, b, y in d.itertuples(index=False)]
    df = spark.createDataFrame([(*r, 0) for r in rows] + [(1000, 99, 1, None, 0)], "i long, a int, b int, y double, segment int")
    got = cells.replicate_cube(df, FEATS, "y", ["i"], 20)
    got = {(r["replicate"], r["a"], r["b"]): (r["n"], r["weight"], r["sum_y"]) for r in got.collect()}
    w = draws(pd.DataFrame({"i": [r[0] for r in rows] + [1000]}), 20)
    want = {}
    for at, (_, a, b, y) in enumerate([*rows, (1000, 99, 1, None)]):
        for r in np.flatnonzero(w[:, at]):
            n, weight, total = want.get((r, a, b), (0, 0, None))
            want[r, a, b] = n + 1, weight + w[r, at], total if y is None else (total or 0.0) + w[r, at] * y
    assert got == {k: (n, weight, total if total is None else pytest.approx(total)) for k, (n, weight, total) in want.items()}


def test_replicates_make_no_row_for_each_draw(spark, capsys):
    _, df = table(spark)
    cells.replicate_cube(df.withColumn("segment", F.lit(0)), FEATS, "y", ["i"], 30).explain("formatted")
    assert "Generate" not in capsys.readouterr().out


def test_replicates_of_many_cells_are_sent_on(spark, monkeypatch):
    d, df = table(spark, nulls=False)
    df = df.withColumn("segment", F.lit(0))
    read = lambda: {(r["replicate"], r["a"], r["b"]): (r["n"], r["weight"], r["sum_y"]) for r in cells.replicate_cube(df, FEATS, "y", ["i"], 9).collect()}
    want = read()
    monkeypatch.setattr(cells, "HELD", 1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 20)
    try:
        assert read() == {k: (n, w, pytest.approx(s)) for k, (n, w, s) in want.items()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_bagged_rows_are_in_bounded_partitions(spark, monkeypatch):
    _, df = table(spark, 400, nulls=False)
    given, assemble = [], models._assemble
    monkeypatch.setattr(models, "_assemble", lambda x, f: given.append(x) or assemble(x, f))
    models.fit_forest(df.coalesce(1), FEATS, "y", n_trees=3, depth=1)
    assert given[-1].rdd.getNumPartitions() == 1
    monkeypatch.setattr(models, "BAG_BYTES", 50 * 220, raising=False)  # 50 rows of 3 trees and 2 features
    models.fit_forest(df.coalesce(1), FEATS, "y", n_trees=3, depth=1)
    sizes = [r["count"] for r in given[-1].groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 400 and max(sizes) <= 51
