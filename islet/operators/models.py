"""Models (ML2, ML5-ML14): mean baselines, ridge, forest and boosted trees.

Ridge is fitted from Gram aggregates: one Spark aggregate per data segment
gives n, sum(x), sum(y), X'X, X'y and y'y; these add up, so the train and
test statistics of every fold — and therefore every alpha on the grid — come
from a single pass.  The p x p solve on the driver is bounded by the number
of features, not by the data.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from islet.functions.scalars import cast_to, exp_back, linear_score, log_target
from islet.operators.joins import attach_scalar
from islet.operators.validate import inner_fold_bounds, indexed, rolling_fold_bounds


# ----------------------------------------------------------------- baselines

def mean_baseline(split: DataFrame, target: str, keys: Sequence[str] = (), name: str = "pred") -> DataFrame:
    """ML2 / J8: train-only mean (global or per group) as the prediction for
    test rows; an unseen group predicts NULL and is left out of the RMSE."""
    train = split.filter(F.col("role") == "train")
    test = split.filter(F.col("role") == "test")
    means = train.groupBy(*keys).agg(F.avg(target).alias(name))
    return test.join(means, list(keys), "left") if keys else attach_scalar(test, means)


def baseline_rmse(split: DataFrame, target: str, keys: Sequence[str] = (), model: str = "B0") -> DataFrame:
    """ML2 + M8: RMSE of a mean baseline on the test rows."""
    p = mean_baseline(split, target, keys)
    d = F.col("pred") - F.col(target)
    return p.agg(F.sqrt(F.avg(d * d)).alias("rmse"), F.count(d).alias("n_scored"),
                 F.count(F.lit(1)).alias("n_test")).select(F.lit(model).alias("model"), "*")


# --------------------------------------------------------------------- ridge

@dataclass
class Gram:
    """Sums over a segment of the *shifted* data x - cx, y - cy (the shift is
    a first-pass mean, so the products stay small and sums do not cancel)."""
    n: float
    sx: np.ndarray
    sy: float
    xx: np.ndarray
    xy: np.ndarray
    yy: float
    cx: np.ndarray = field(default=None)
    cy: float = 0.0

    def __add__(self, o: "Gram") -> "Gram":
        return Gram(self.n + o.n, self.sx + o.sx, self.sy + o.sy, self.xx + o.xx, self.xy + o.xy, self.yy + o.yy,
                    self.cx if self.cx is not None else o.cx, self.cy or o.cy)


def gram_aggs(features: Sequence[str], label_expr, cx: Sequence[float] | None = None, cy: float = 0.0) -> list:
    p = len(features)
    cx = list(cx) if cx is not None else [0.0] * p
    x = [F.col(f).cast("double") - F.lit(float(cx[i])) for i, f in enumerate(features)]
    y = label_expr - F.lit(float(cy))
    aggs = [F.count(F.lit(1)).alias("g_n"), F.sum(y).alias("g_sy"), F.sum(y * y).alias("g_yy")]
    aggs += [F.sum(x[i]).alias(f"g_sx_{i}") for i in range(p)]
    aggs += [F.sum(x[i] * y).alias(f"g_xy_{i}") for i in range(p)]
    aggs += [F.sum(x[i] * x[j]).alias(f"g_xx_{i}_{j}") for i in range(p) for j in range(i, p)]
    return aggs


def gram_from_row(r, p: int, cx=None, cy: float = 0.0) -> Gram:
    def v(k):
        return float(r[k] or 0.0)
    xx = np.zeros((p, p))
    for i in range(p):
        for j in range(i, p):
            xx[i, j] = xx[j, i] = v(f"g_xx_{i}_{j}")
    return Gram(v("g_n"), np.array([v(f"g_sx_{i}") for i in range(p)]), v("g_sy"), xx,
                np.array([v(f"g_xy_{i}") for i in range(p)]), v("g_yy"),
                np.array(cx if cx is not None else [0.0] * p, dtype=float), cy)


def grams_by(df: DataFrame, by: str, features: Sequence[str], label: str, log: bool = False) -> dict:
    """Two small aggregates -> {segment: Gram}: the means (the shift), then
    the shifted sums per segment; rows with a NULL feature/label dropped."""
    y = log_target(label) if log else cast_to(label, "double")
    clean = df.dropna(subset=[*features, label])
    m = clean.agg(*[F.avg(F.col(f).cast("double")).alias(f"m{i}") for i, f in enumerate(features)],
                  F.avg(y).alias("my")).first()
    cx = [float(m[f"m{i}"] or 0.0) for i in range(len(features))]
    cy = float(m["my"] or 0.0)
    rows = clean.groupBy(by).agg(*gram_aggs(features, y, cx, cy)).collect()  # one row per segment
    return {r[by]: gram_from_row(r, len(features), cx, cy) for r in rows}


def ridge_solve(g: Gram, alpha: float) -> tuple[float, np.ndarray]:
    """Ridge with an unpenalised intercept: centre, solve (Sxx + aI) w = Sxy;
    the intercept is mapped back from the shifted frame."""
    xm = g.sx / g.n
    ym = g.sy / g.n
    sxx = g.xx - g.n * np.outer(xm, xm)
    sxy = g.xy - g.n * xm * ym
    w = np.linalg.solve(sxx + alpha * np.eye(len(xm)), sxy)
    cx = g.cx if g.cx is not None else np.zeros(len(xm))
    return float(ym - xm @ w + g.cy - cx @ w), w


def sse(g: Gram, b: float, w: np.ndarray) -> float:
    """Sum of squared errors of y ~ b + x'w on a segment, from its Gram."""
    cx = g.cx if g.cx is not None else np.zeros(len(w))
    b = b - g.cy + cx @ w  # the same line in the shifted frame
    return float(g.yy - 2 * (b * g.sy + w @ g.xy) + b * b * g.n + 2 * b * (w @ g.sx) + w @ g.xx @ w)


def fit_ridge(df: DataFrame, features: Sequence[str], label: str, alpha: float, log: bool = False) -> dict:
    """ML5: closed-form ridge fit (one aggregate)."""
    g = grams_by(df.withColumn("_seg", F.lit(0)), "_seg", features, label, log)[0]
    b, w = ridge_solve(g, alpha)
    return {"intercept": b, "coefficients": dict(zip(features, map(float, w))), "alpha": alpha,
            "features": list(features), "log_target": log, "train_n": int(g.n)}


def _segment_expr(index: str, cuts: Sequence[int]):
    """Segment number of a row from sorted cut points on its position."""
    e = F.lit(len(cuts))
    for i in reversed(range(len(cuts))):
        e = F.when(F.col(index) < F.lit(cuts[i]), F.lit(i)).otherwise(e)
    return e


def inner_cv(grams: list[Gram], head: Gram, alphas: Sequence[float]) -> np.ndarray:
    """RMSE[alpha, fold] of the k-split time-series CV, from segment Grams:
    ``head`` = rows before the first test segment, ``grams`` = test segments."""
    out = np.zeros((len(alphas), len(grams)))
    for j, test in enumerate(grams):
        train = head
        for g in grams[:j]:
            train = train + g
        for a, alpha in enumerate(alphas):
            b, w = ridge_solve(train, alpha)
            out[a, j] = np.sqrt(max(sse(test, b, w), 0.0) / test.n)
    return out


def _raw_cv(x: DataFrame, tests: list[Gram], head: Gram, alphas: Sequence[float], features: Sequence[str],
            label: str) -> np.ndarray:
    """RMSE[alpha, fold] on the label's own scale of log models: every
    (alpha, fold) model is one conditional aggregate of a single pass."""
    aggs = []
    for alpha in alphas:
        train = head
        for j, test in enumerate(tests):
            b, w = ridge_solve(train, alpha)
            pred = exp_back(linear_score(dict(zip(features, map(float, w))), b))
            d = F.when(F.col("_seg") == j + 1, pred - F.col(label))
            aggs.append(F.sqrt(F.avg(d * d)))
            train = train + test
    row = x.agg(*[a.alias(f"r{i}") for i, a in enumerate(aggs)]).first()
    return np.array([np.nan if v is None else v for v in row], dtype=float).reshape(len(alphas), len(tests))


def tune_ridge(df: DataFrame, order: Sequence[str], features: Sequence[str], label: str,
               alphas: Sequence[float], k: int = 3, log: bool = False, n_blocks: int | None = None) -> dict:
    """ML6 / ML7: pick alpha by mean inner-CV RMSE, refit on all rows; also
    returns the validation curve (mean and population std per alpha).  With
    ``log`` alpha is picked on the log scale, and the curve is the error of
    the back-transformed prediction (one more pass for all its points)."""
    clean = df.dropna(subset=[*features, label])
    x = indexed(clean, order, "_i", n_blocks)
    n = x.select("n").first()[0]
    bounds = inner_fold_bounds(n, k)
    cuts = [bounds[0][0]] + [hi for _, hi in bounds[:-1]]
    x = x.withColumn("_seg", _segment_expr("_i", cuts))
    segs = grams_by(x, "_seg", features, label, log)
    any_g = next(iter(segs.values()))
    p = len(features)
    empty = Gram(0.0, np.zeros(p), 0.0, np.zeros((p, p)), np.zeros(p), 0.0, any_g.cx, any_g.cy)
    head = segs.get(0, empty)
    tests = [segs.get(j + 1, empty) for j in range(k)]
    cv = inner_cv(tests, head, alphas)
    mean = cv.mean(axis=1)
    best = int(np.argmin(mean))
    total = head
    for g in tests:
        total = total + g
    b, w = ridge_solve(total, alphas[best])
    shown = _raw_cv(x, tests, head, alphas, features, label) if log else cv
    curve = [(float(a), float(m), float(s)) for a, m, s in zip(alphas, shown.mean(axis=1), shown.std(axis=1))]
    return {"alpha": float(alphas[best]), "intercept": b, "coefficients": dict(zip(features, map(float, w))),
            "curve": curve, "features": list(features), "log_target": log, "train_n": int(total.n)}


def predict_expr(model: dict):
    e = linear_score(model["coefficients"], model["intercept"])
    return exp_back(e) if model.get("log_target") else e


def rolling_cv_ridge(df: DataFrame, order: Sequence[str], features: Sequence[str], label: str,
                     alphas: Sequence[float], n_folds: int = 3, start_frac: float = 0.35, k: int = 3,
                     log: bool = False, min_train: int = 10, n_blocks: int | None = None) -> list[dict]:
    """ML3 + ML6 + ML8: expanding-window CV; inside each fold's train window
    alpha is tuned by the inner time-series split (in log space when
    ``log``), the fold is scored on the raw scale.

    Fold bounds are positions among all rows; a fold drops its incomplete
    rows afterwards, and its inner split runs on what is left.  So every
    train / test / inner segment of every fold is a contiguous range of the
    rank among complete rows.  One Gram aggregate over the elementary ranges
    therefore serves every fold and every alpha; the log variant needs one
    more aggregate for its raw-scale test error."""
    from islet.operators.ordered import with_global_index
    x = indexed(df, order, "_i", n_blocks)
    n = x.select("n").first()[0]
    bounds = rolling_fold_bounds(n, n_folds, start_frac)
    complete = x.dropna(subset=[*features, label]).select("_i", *features, label)
    ranked = with_global_index(complete, ["_i"], "_j", n_blocks=n_blocks)
    cut_i = sorted({c for lo, hi in bounds for c in (lo, hi)})
    before = ranked.agg(*[F.count_if(F.col("_i") < c).alias(f"c{c}") for c in cut_i]).first()
    rank_at = {c: int(before[f"c{c}"]) for c in cut_i}
    specs, cuts = [], {0}
    for fold, (lo, hi) in enumerate(bounds):
        n_tr, n_te = rank_at[lo], rank_at[hi] - rank_at[lo]
        if n_tr < min_train or n_te == 0:
            continue
        inner = inner_fold_bounds(n_tr, k)
        specs.append((fold, lo, hi, n_tr, n_te, inner))
        cuts |= {n_tr, n_tr + n_te} | {v for seg in inner for v in seg}
    if not specs:
        return []
    cuts = sorted(cuts)
    grams = grams_by(ranked.withColumn("_seg", _segment_expr("_j", cuts[1:])), "_seg", features, label, log)
    p = len(features)
    any_g = next(iter(grams.values()))
    zero = Gram(0.0, np.zeros(p), 0.0, np.zeros((p, p)), np.zeros(p), 0.0, any_g.cx, any_g.cy)

    def span(a: int, b: int) -> Gram:
        g = zero
        for si in range(len(cuts) - 1):
            if a <= cuts[si] and cuts[si + 1] <= b:
                g = g + grams.get(si, zero)
        return g

    fitted = []
    for fold, lo, hi, n_tr, n_te, inner in specs:
        cv = inner_cv([span(s0, s1) for s0, s1 in inner], span(0, inner[0][0]), alphas)
        alpha = float(alphas[int(np.argmin(cv.mean(axis=1)))])
        b, w = ridge_solve(span(0, n_tr), alpha)
        fitted.append((fold, lo, hi, n_tr, n_te, alpha, b, w))
    if log:  # raw-scale error of exp(prediction): one pass for all folds
        aggs = []
        for fold, lo, hi, n_tr, n_te, alpha, b, w in fitted:
            pred = F.exp(linear_score(dict(zip(features, map(float, w))), b))
            in_test = (F.col("_j") >= n_tr) & (F.col("_j") < n_tr + n_te)
            d = F.when(in_test, pred - F.col(label))
            aggs.append(F.sqrt(F.avg(d * d)).alias(f"r{fold}"))
        raw = ranked.agg(*aggs).first()
    results = []
    for fold, lo, hi, n_tr, n_te, alpha, b, w in fitted:
        if log:
            rmse = float(raw[f"r{fold}"])
        else:
            t = span(n_tr, n_tr + n_te)
            rmse = float(np.sqrt(max(sse(t, b, w), 0.0) / t.n))
        results.append({"fold": fold, "test_start": lo, "test_end": hi, "alpha": alpha, "rmse": rmse,
                        "n_train": n_tr, "n_test": n_te})
    return results


def compare_models(spark, cv: dict[str, list[dict]], baseline_rmse_value: float) -> DataFrame:
    """ML11: mean CV RMSE per variant, delta vs the baseline, beats flag."""
    rows = [(name, fold["fold"], float(fold["rmse"])) for name, folds in cv.items() for fold in folds]
    df = spark.createDataFrame(rows, "variant string, fold int, rmse double")
    return (df.groupBy("variant").agg(F.avg("rmse").alias("mean_rmse"), F.count("*").alias("n_folds"))
            .withColumn("delta_vs_baseline", F.col("mean_rmse") - F.lit(baseline_rmse_value))
            .withColumn("beats_baseline", F.col("mean_rmse") < F.lit(baseline_rmse_value)))


# --------------------------------------------------------------------- trees

#: Bytes of bagged rows in a partition that MLlib holds, at most.
BAG_BYTES = 128 << 20


def _spread(df: DataFrame, n_trees: int, features: int) -> DataFrame:
    """The rows in partitions of about ``BAG_BYTES`` once they are bagged.
    MLlib caches every row with a draw for each tree (4 bytes each, beside
    objects and binned features), and each round reads a partition whole.
    Rows stay where they are while no partition is larger."""
    most = BAG_BYTES // (4 * n_trees + 4 * features + 200)
    sizes = df.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    return df.repartition(-(-sizes[1] // most)) if (sizes[0] or 0) > most else df


def _assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip").transform(
        df.select(*[F.col(f).cast("double").alias(f) for f in features], *[c for c in df.columns if c not in features]))


def fit_forest(df: DataFrame, features: Sequence[str], label: str, n_trees: int = 200, depth: int = 2,
               min_leaf: int = 2, seed: int = 42, bootstrap: bool = True):
    """ML9: random forest; every tree sees all features like the source's
    default (featureSubsetStrategy='all'); min samples per leaf -> minInstancesPerNode."""
    from pyspark.ml.regression import RandomForestRegressor
    rf = RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=n_trees, maxDepth=depth,
                               minInstancesPerNode=min_leaf, featureSubsetStrategy="all", seed=seed,
                               bootstrap=bootstrap)
    return rf.fit(_assemble(_spread(df.select(*features, label).dropna(), n_trees, len(features)), features))


def fit_gbt(df: DataFrame, features: Sequence[str], label: str, rounds: int = 100, depth: int = 2,
            rate: float = 0.1, subsample: float = 1.0, seed: int = 42):
    """ML10: gradient-boosted trees (same family as the source's boosted model)."""
    from pyspark.ml.regression import GBTRegressor
    gbt = GBTRegressor(featuresCol="features", labelCol=label, maxIter=rounds, maxDepth=depth,
                       stepSize=rate, subsamplingRate=subsample, seed=seed)
    return gbt.fit(_assemble(_spread(df.select(*features, label).dropna(), 1, len(features)), features))


def predict_tree(df: DataFrame, model, features: Sequence[str], name: str) -> DataFrame:
    """Add a fitted tree model's prediction; NULL where a feature is NULL."""
    from pyspark.ml.feature import VectorAssembler
    inputs = [f"_x{i}" for i in range(len(features))]
    x = df.withColumns({c: F.col(f).cast("double") for c, f in zip(inputs, features)})
    x = VectorAssembler(inputCols=inputs, outputCol="_features", handleInvalid="keep").transform(x)
    out = model.copy({model.featuresCol: "_features", model.predictionCol: name}).transform(x)
    absent = F.exists(F.array(*inputs), lambda v: v.isNull())
    return out.withColumn(name, F.when(~absent, F.col(name))).drop("_features", *inputs)


def tree_rmse(model, df: DataFrame, features: Sequence[str], label: str) -> float:
    pred = model.transform(_assemble(df.dropna(subset=[*features, label]), features))
    d = F.col("prediction") - F.col(label)
    return float(pred.agg(F.sqrt(F.avg(d * d))).first()[0])


def search_landscape(spark, grid_results: Sequence[dict]) -> DataFrame:
    """ML12: one row per grid point with mean and population std RMSE
    across folds; callers pivot (A24) and take the arg-min per cell (A23)."""
    rows = [(json.dumps(r["params"], sort_keys=True), int(r["fold"]), float(r["rmse"]),
             *[r["params"].get(k) for k in ("n_trees", "depth", "min_leaf")]) for r in grid_results]
    df = spark.createDataFrame(rows, "params string, fold int, rmse double, n_trees int, depth int, min_leaf int")
    return df.groupBy("params", "n_trees", "depth", "min_leaf").agg(
        F.avg("rmse").alias("mean_rmse"), F.stddev_pop("rmse").alias("std_rmse"))


def importances(spark, model, features: Sequence[str]) -> DataFrame:
    """ML13: feature importances (trees) or coefficients (ridge dict), sorted."""
    if isinstance(model, dict):
        rows = [(f, float(model["coefficients"][f])) for f in features]
    else:
        rows = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.abs("importance").desc())


def evaluate(scored: DataFrame, pred: str, label: str, by: str | None = None) -> DataFrame:
    """ML14: holdout RMSE / bias / std overall or by group."""
    d = F.col(label) - F.col(pred)
    keys = [by] if by else []
    return scored.groupBy(*keys).agg(F.count(d).alias("n"), F.sqrt(F.avg(d * d)).alias("rmse"),
                                     F.avg(d).alias("bias"), F.stddev_pop(d).alias("std"))


def tune_trees(df: DataFrame, order: Sequence[str], features: Sequence[str], label: str, grid: Sequence[dict],
               kind: str = "forest", k: int = 3, n_blocks: int | None = None) -> dict:
    """ML9 / ML10: grid search with the inner time-series split (expanding
    train, next segment as test; ``CrossValidator`` shuffles, so the fold
    loop is explicit), refit of the best point on all rows.  Every fit is a
    distributed MLlib job; the grid and folds are small driver loops."""
    x = indexed(df.dropna(subset=[*features, label]), order, "_i", n_blocks)
    return _tune_upto(x, x.select("n").first()[0], features, label, grid, kind, k)


def _tune_upto(x: DataFrame, n: int, features: Sequence[str], label: str, grid: Sequence[dict], kind: str, k: int) -> dict:
    """``tune_trees`` on the first n rows of indexed rows."""
    fit = fit_forest if kind == "forest" else fit_gbt
    rows = []
    for params in grid:
        for fold, (lo, hi) in enumerate(inner_fold_bounds(n, k)):
            m = fit(x.filter(F.col("_i") < lo), features, label, **params)
            te = x.filter((F.col("_i") >= lo) & (F.col("_i") < hi))
            rows.append({"params": params, "fold": fold, "rmse": tree_rmse(m, te, features, label)})
    means = {}
    for r in rows:
        means.setdefault(json.dumps(r["params"], sort_keys=True), []).append(r["rmse"])
    best_key = min(means, key=lambda s: float(np.mean(means[s])))
    best = json.loads(best_key)
    return {"best_params": best, "cv_rmse": float(np.mean(means[best_key])), "results": rows,
            "model": fit(x.filter(F.col("_i") < n), features, label, **best)}


def rolling_cv_trees(df: DataFrame, order: Sequence[str], features: Sequence[str], label: str, grid: Sequence[dict],
                     kind: str = "forest", folds: int = 3, start: float = 0.35, k: int = 3,
                     n_blocks: int | None = None) -> list[dict]:
    """ML9-ML11 nested: in every expanding fold the grid is searched by the
    inner time-series split of the rows before the test window, and the best
    point, refitted on all of these, is scored on the window."""
    x = indexed(df.dropna(subset=[*features, label]), order, "_i", n_blocks)
    out = []
    for fold, (lo, hi) in enumerate(rolling_fold_bounds(x.select("n").first()[0], folds, start)):
        t = _tune_upto(x, lo, features, label, grid, kind, k)
        window = x.filter((F.col("_i") >= lo) & (F.col("_i") < hi))
        out.append({"fold": fold, "params": t["best_params"], "cv_rmse": t["cv_rmse"],
                    "rmse": tree_rmse(t["model"], window, features, label), "n_train": lo, "n_test": hi - lo})
    return out
