"""Time-ordered validation (ML1, ML3, ML4, ML23, O7).

Rows get a global position from the block-decomposed index; every split is
then a filter on that position, so no fold ever gathers rows on the driver.
Fold bounds are small integers computed from the row count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from islet.operators.joins import attach_scalar
from islet.operators.ordered import with_global_index


def rolling_fold_bounds(n: int, n_folds: int = 3, start_frac: float = 0.35) -> list[tuple[int, int]]:
    """ML3: expanding window; test windows of equal size after int(start*n);
    the remainder at the tail stays unused."""
    start = int(n * start_frac)
    size = (n - start) // n_folds
    return [(start + i * size, start + (i + 1) * size) for i in range(n_folds)]


def inner_fold_bounds(n: int, k: int = 3) -> list[tuple[int, int]]:
    """ML4: time-series split with test size n // (k + 1), the last k segments."""
    ts = n // (k + 1)
    return [(n - (k - j) * ts, n - (k - j - 1) * ts) for j in range(k)]


def indexed(df: DataFrame, order: Sequence[str], index: str = "idx", n_blocks: int | None = None) -> DataFrame:
    """Global 0-based position plus the total row count ``n`` on every row."""
    idx = with_global_index(df, list(order), index, n_blocks=n_blocks)
    return attach_scalar(idx, idx.agg(F.count(F.lit(1)).alias("n")))


def time_split(df: DataFrame, order: Sequence[str], n_test: int | None = None, frac_test: float | None = None,
               index: str = "idx", n_blocks: int | None = None) -> DataFrame:
    """ML1 / O7: the last ``n_test`` rows (or last ``floor(n * frac_test)``) in
    the order are the test set; the rest is train.  Adds ``role``."""
    x = indexed(df, order, index, n_blocks)
    nt = F.lit(n_test) if n_test is not None else F.floor(F.col("n") * F.lit(frac_test))
    return x.withColumn("role", F.when(F.col(index) >= F.col("n") - nt, F.lit("test")).otherwise(F.lit("train")))


def _fold_rows(x: DataFrame, index: str, bounds_expr) -> DataFrame:
    """Explode each row into the folds it takes part in (train or test)."""
    return (x.select("*", F.explode(bounds_expr).alias("_f"))
            .withColumn("fold", F.col("_f.fold"))
            .withColumn("role", F.when(F.col(index) < F.col("_f.lo"), F.lit("train"))
                        .when(F.col(index) < F.col("_f.hi"), F.lit("test")))
            .filter(F.col("role").isNotNull()).drop("_f"))


def rolling_folds(df: DataFrame, order: Sequence[str], n_folds: int = 3, start_frac: float = 0.35,
                  index: str = "idx", n_blocks: int | None = None) -> DataFrame:
    """ML3 long form: (fold, role, row...) for every row in every fold it is in."""
    x = indexed(df, order, index, n_blocks)
    start = F.floor(F.col("n") * F.lit(start_frac))
    size = F.floor((F.col("n") - start) / F.lit(n_folds))
    bounds = F.array(*[F.struct(F.lit(i).alias("fold"), (start + size * i).alias("lo"),
                                (start + size * (i + 1)).alias("hi")) for i in range(n_folds)])
    return _fold_rows(x, index, bounds)


def inner_folds(df: DataFrame, order: Sequence[str], k: int = 3, index: str = "idx",
                n_blocks: int | None = None) -> DataFrame:
    """ML4 long form."""
    x = indexed(df, order, index, n_blocks)
    ts = F.floor(F.col("n") / F.lit(k + 1))
    bounds = F.array(*[F.struct(F.lit(j).alias("fold"), (F.col("n") - ts * (k - j)).alias("lo"),
                                (F.col("n") - ts * (k - j - 1)).alias("hi")) for j in range(k)])
    return _fold_rows(x, index, bounds)


def split_summary(split: DataFrame, date: str, target: str, flag: str | None = None,
                  klass: str | None = None, levels: Sequence | None = None) -> DataFrame:
    """ML23: per role its size, date range, target mean, flag percentage and
    class mix (one column per class of ``levels``, counted; without levels they
    are looked up first, which Spark refuses above ``spark.sql.pivotMaxValues``)."""
    aggs = [F.count(F.lit(1)).alias("n"), F.min(date).alias("date_min"), F.max(date).alias("date_max"),
            F.avg(target).alias("target_mean")]
    if flag:
        aggs.append((F.avg(F.col(flag).cast("double")) * 100).alias("flag_pct"))
    out = split.groupBy("role").agg(*aggs)
    if klass:
        mix = split.groupBy("role").pivot(klass, list(levels) if levels is not None else None).count().fillna(0)
        out = out.join(mix, "role")
    return out
