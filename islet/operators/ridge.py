"""Ridge regression solved in the plan (ML5-ML8).

Gram sums of segments of the time order are one aggregate; they add up to the
train and test sums of every split.  A row per (split, alpha) then holds its
p x p system as arrays and is solved by elimination with higher-order
functions, so a fit, a validation curve and a nested rolling CV are plans like
any other: nothing comes to the driver, and systems are solved in parallel.
The rows solved are splits x alphas, whatever the data's size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from islet.functions.scalars import cast_to, log_target
from islet.operators.joins import attach_scalar
from islet.operators.ordered import with_global_index
from islet.operators.validate import indexed


def solve(a: Column, b: Column) -> Column:
    """x with a x = b, for a symmetric positive definite array of rows a: a
    Gauss-Jordan step for each row, the right-hand side as a last column."""
    m = F.transform(F.zip_with(a, b, lambda row, v: F.struct(row.alias("row"), v.alias("v"))), lambda s: F.concat(s["row"], F.array(s["v"])))

    def step(m, k):
        pivot = F.transform(F.get(m, k), lambda v: v / F.get(F.get(m, k), k))
        return F.transform(m, lambda row, i: F.when(i == k, pivot).otherwise(F.zip_with(row, pivot, lambda v, u: v - F.get(row, k) * u)))

    done = F.aggregate(F.sequence(F.lit(0), F.size(b) - 1), m, step)
    return F.transform(done, lambda row: F.element_at(row, -1))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda t, v: t + v)


def _names(p: int) -> list[str]:
    return ["n", "sy", "yy", *[f"sx{i}" for i in range(p)], *[f"xy{i}" for i in range(p)], *[f"xx{i}_{j}" for i in range(p) for j in range(i, p)]]


def _products(df: DataFrame, features: Sequence[str], label: Column, means: Sequence[str], mean: str) -> DataFrame:
    """The summands of a Gram table, of data shifted by the means, so that sums do not cancel."""
    x = [F.col(f).cast("double") - F.col(m) for f, m in zip(features, means)]
    y, p = label - F.col(mean), len(features)
    cols = {"n": F.lit(1.0), "sy": y, "yy": y * y} | {f"sx{i}": x[i] for i in range(p)} | {f"xy{i}": x[i] * y for i in range(p)}
    return df.withColumns(cols | {f"xx{i}_{j}": x[i] * x[j] for i in range(p) for j in range(i, p)})


def _system(p: int, prefix: str = "") -> dict[str, Column]:
    """Gram columns as arrays: sx, xy and the full xx."""
    c = lambda name: F.col(prefix + name)
    xx = F.array(*[F.array(*[c(f"xx{min(i, j)}_{max(i, j)}") for j in range(p)]) for i in range(p)])
    return {"sx": F.array(*[c(f"sx{i}") for i in range(p)]), "xy": F.array(*[c(f"xy{i}") for i in range(p)]), "xx": xx}


def fits(grams: DataFrame, p: int, alphas: Sequence[float], prefix: str = "") -> DataFrame:
    """Gram rows -> a row for each alpha with ``w`` and ``b`` (of shifted data):
    centred, (Sxx + alpha I) w = Sxy, with an unpenalised intercept."""
    g = grams.withColumns({f"_{k}": v for k, v in _system(p, prefix).items()}).withColumn("alpha", F.explode(F.array(*[F.lit(float(a)) for a in alphas])))
    n, sy = F.col(f"{prefix}n"), F.col(f"{prefix}sy")
    sxx = F.transform("_xx", lambda row, i: F.transform(row, lambda v, j: v - F.get("_sx", i) * F.get("_sx", j) / n + F.when(i == j, F.col("alpha")).otherwise(0.0)))
    sxy = F.zip_with("_xy", "_sx", lambda a, s: a - s * sy / n)
    g = g.withColumns({"_a": sxx, "_b": sxy}).withColumn("w", solve(F.col("_a"), F.col("_b")))
    return g.withColumn("b", (sy - dot(F.col("w"), F.col("_sx"))) / n).drop("_a", "_b", "_sx", "_xy", "_xx")


def squares(p: int, prefix: str = "") -> Column:
    """Sum of squared errors of b + x'w on a Gram's rows."""
    s = _system(p, prefix)
    w, b, c = F.col("w"), F.col("b"), lambda name: F.col(prefix + name)
    quad = dot(F.transform(s["xx"], lambda row: dot(row, w)), w)
    return c("yy") - 2 * (b * c("sy") + dot(w, s["xy"])) + b * b * c("n") + 2 * b * dot(w, s["sx"]) + quad


def _label(label: str, log: bool) -> Column:
    return log_target(label) if log else cast_to(label, "double")


def _shift(clean: DataFrame, features: Sequence[str], y: Column) -> list[Column]:
    return [*[F.avg(F.col(f).cast("double")).alias(f"_m{i}") for i, f in enumerate(features)], F.avg(y).alias("_my")]


def model_rows(fitted: DataFrame, features: Sequence[str]) -> DataFrame:
    """Fits with the shift -> (term, value, alpha): intercept and coefficients
    on the data's own scale."""
    means = F.array(*[F.col(f"_m{i}") for i in range(len(features))])
    intercept = F.col("b") + F.col("_my") - dot(F.col("w"), means)
    terms = F.array(F.struct(F.lit("intercept").alias("term"), intercept.alias("value")), *[F.struct(F.lit(f).alias("term"), F.get("w", F.lit(i)).alias("value")) for i, f in enumerate(features)])
    return fitted.select("alpha", F.explode(terms).alias("t")).select("t.term", "t.value", "alpha")


def fit(df: DataFrame, features: Sequence[str], label: str, alpha: float, log: bool = False) -> DataFrame:
    """ML5: (term, value, alpha) of one ridge fit on the complete rows."""
    clean, y, p = df.dropna(subset=[*features, label]), _label(label, log), len(features)
    means = clean.agg(*_shift(clean, features, y))
    rows = _products(attach_scalar(clean, means), features, y, [f"_m{i}" for i in range(p)], "_my")
    gram = rows.groupBy(*[f"_m{i}" for i in range(p)], "_my").agg(*[F.sum(c).alias(c) for c in _names(p)])
    return model_rows(fits(gram, p, [alpha]), features)


def _inner(n: Column, k: int) -> list[tuple[Column, Column]]:
    size = F.floor(n / (k + 1))
    return [(n - size * (k - j), n - size * (k - j - 1)) for j in range(k)]


def _split_sums(ranked: DataFrame, splits: list[tuple[int, int, Column, Column]], features: Sequence[str], y: Column) -> DataFrame:
    """Rows with rank ``_j``, shift and the splits' borders -> a row for each
    (outer, part) with its train (``r_``) and test (``t_``) Gram columns.
    Rows are summed by elementary range first; only ranges meet splits."""
    p = len(features)
    keep = [f"_m{i}" for i in range(p)] + ["_my"]
    borders = F.array(*[F.struct(F.lit(o).alias("outer"), F.lit(part).alias("part"), a.cast("long").alias("a"), b.cast("long").alias("b")) for o, part, a, b in splits])
    rows = ranked.withColumn("_seg", sum(((F.col("_j") >= c).cast("int") for _, _, a, b in splits for c in (a, b)), F.lit(0)))
    rows = _products(rows, features, y, keep[:-1], "_my")
    ranges = rows.groupBy("_seg", *keep).agg(F.min("_j").alias("_at"), F.min(borders).alias("_splits"), *[F.sum(c).alias(c) for c in _names(p)])
    met = ranges.withColumn("_s", F.explode("_splits"))
    train, test = F.col("_at") < F.col("_s.a"), (F.col("_at") >= F.col("_s.a")) & (F.col("_at") < F.col("_s.b"))
    sums = [F.sum(F.when(cond, F.col(c)).otherwise(0.0)).alias(f"{pre}{c}") for pre, cond in (("r_", train), ("t_", test)) for c in _names(p)]
    return met.groupBy(F.col("_s.outer").alias("outer"), F.col("_s.part").alias("part"), *keep).agg(*sums).filter("r_n > 0 and t_n > 0")


def _errors(sums: DataFrame, p: int, alphas: Sequence[float]) -> DataFrame:
    scored = fits(sums, p, alphas, "r_")
    return scored.withColumn("rmse", F.sqrt(F.greatest(squares(p, "t_"), F.lit(0.0)) / F.col("t_n")))


def curve(df: DataFrame, order: Sequence[str], features: Sequence[str], label: str, alphas: Sequence[float], k: int = 3, n_blocks: int | None = None) -> DataFrame:
    """ML6 / ML7: (alpha, mean_rmse, std_rmse) over the inner time-series
    splits of the complete rows."""
    clean, y, p = df.dropna(subset=[*features, label]), _label(label, False), len(features)
    ranked = indexed(clean.select(*order, *features, label), order, "_j", n_blocks)
    ranked = attach_scalar(ranked, ranked.agg(*_shift(ranked, features, y)))
    # the Gram's own n must not clash with the row count
    ranked = ranked.withColumnRenamed("n", "_n")
    splits = [(0, j, a, b) for j, (a, b) in enumerate(_inner(F.col("_n"), k))]
    scored = _errors(_split_sums(ranked, splits, features, y), p, alphas)
    return scored.groupBy("alpha").agg(F.avg("rmse").alias("mean_rmse"), F.stddev_pop("rmse").alias("std_rmse"))


def tuned(df: DataFrame, order: Sequence[str], features: Sequence[str], label: str, alphas: Sequence[float], k: int = 3, n_blocks: int | None = None) -> DataFrame:
    """ML6: (term, value, alpha) of the fit on all complete rows with the alpha
    of least mean inner error (equal ones: the least alpha)."""
    best = curve(df, order, features, label, alphas, k, n_blocks).agg(F.min(F.struct("mean_rmse", "alpha")).alias("b")).select(F.col("b.alpha").alias("best"))
    clean, y, p = df.dropna(subset=[*features, label]), _label(label, False), len(features)
    means = clean.agg(*_shift(clean, features, y))
    rows = _products(attach_scalar(clean, means), features, y, [f"_m{i}" for i in range(p)], "_my")
    gram = rows.groupBy(*[f"_m{i}" for i in range(p)], "_my").agg(*[F.sum(c).alias(c) for c in _names(p)])
    chosen = attach_scalar(gram, best)
    return model_rows(fits(chosen, p, alphas).filter("alpha = best"), features)


def rolling_cv(df: DataFrame, order: Sequence[str], features: Sequence[str], label: str, alphas: Sequence[float], folds: int = 3,
               start: float = 0.35, k: int = 3, min_train: int = 10, n_blocks: int | None = None) -> DataFrame:
    """ML3 + ML6 + ML8: (fold, alpha, rmse, n_train, n_test).  Fold bounds are
    positions among all rows; incomplete rows go afterwards, and the inner
    splits run on what is left.  Folds with fewer complete train rows than
    ``min_train`` are left out."""
    y, p = _label(label, False), len(features)
    x = indexed(df.select(*order, *features, label), order, "_i", n_blocks)
    complete = x.dropna(subset=[*features, label])
    first = F.floor(F.col("n") * F.lit(start))
    size = F.floor((F.col("n") - first) / folds)
    at = [F.count_if(F.col("_i") < first + size * o).alias(f"_c{o}") for o in range(folds + 1)]
    facts = complete.agg(*at, *_shift(complete, features, y))
    ranked = attach_scalar(with_global_index(complete.drop("n"), ["_i"], "_j", n_blocks=n_blocks), facts)
    splits = []
    for o in range(folds):
        lo, hi = F.col(f"_c{o}"), F.col(f"_c{o + 1}")
        splits += [(o, j, a, b) for j, (a, b) in enumerate(_inner(lo, k))] + [(o, -1, lo, hi)]
    scored = _errors(_split_sums(ranked, splits, features, y), p, alphas).select("outer", "part", "alpha", "rmse", "r_n", "t_n")
    mean = scored.filter("part >= 0").groupBy("outer", "alpha").agg(F.avg("rmse").alias("m"))
    best = mean.groupBy("outer").agg(F.min(F.struct("m", "alpha")).alias("b")).select("outer", F.col("b.alpha").alias("alpha"))
    out = scored.filter((F.col("part") == -1) & (F.col("r_n") >= min_train)).join(best, ["outer", "alpha"])
    return out.select(F.col("outer").alias("fold"), "alpha", "rmse", F.col("r_n").cast("long").alias("n_train"), F.col("t_n").cast("long").alias("n_test"))
