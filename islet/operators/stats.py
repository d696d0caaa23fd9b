"""Statistics (M1-M9, W10): correlations, chi-square, normality, errors.

All are aggregates over the whole table (partial per partition, merged
once); ranks come from the block-decomposed global index.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from islet.operators.joins import attach_scalar, small_side
from islet.operators.ordered import with_global_index


def pearson(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """M1: Pearson r of each column with the target, NULL pairs dropped
    pairwise; one aggregate, returned long (feature, r, n)."""
    aggs = []
    for c in cols:
        both = F.col(c).isNotNull() & F.col(target).isNotNull()
        aggs += [F.corr(F.when(both, F.col(c)), F.when(both, F.col(target))).alias(f"r_{c}"),
                 F.count_if(both).alias(f"n_{c}")]
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"r_{c}").alias("r"), F.col(f"n_{c}").alias("n")) for c in cols]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def avg_rank(df: DataFrame, col: str, tie: Sequence[str], name: str | None = None,
             n_blocks: int | None = None) -> DataFrame:
    """1-based average rank of ``col`` (ties share the mean of their
    positions); NULLs get no rank.  ``tie`` makes the sort unique.

    Equal values are contiguous in the sorted block table, so a value's
    first and last positions come from a window inside its block; a value
    that crosses block edges can only be a block's first or last value, and
    those are resolved on a table of at most 2 x blocks rows (broadcast).
    No row is shuffled after the block table, and a hot value needs no
    join on value."""
    from islet.operators.ordered import BKT, BLK, POS, _block_offsets, range_blocks
    name = name or f"rank_{col}"
    base = df.filter(F.col(col).isNotNull())
    b = range_blocks(base, [col, *tie], n_blocks)
    offs = F.broadcast(_block_offsets(b).select(BLK, "_off", "_cnt"))
    wv = Window.partitionBy(BKT, BLK, col)
    rows = (b.join(offs, BLK)
            .withColumn("_lo", F.min(POS).over(wv) + F.col("_off"))
            .withColumn("_hi", F.max(POS).over(wv) + F.col("_off")))
    # runs touching a block edge: the block's first and last value
    edge = (rows.filter((F.col(POS) == 0) | (F.col(POS) == F.col("_cnt") - 1))
            .select(F.col(col).alias("_v"), "_lo", "_hi")
            .groupBy("_v").agg(F.min("_lo").alias("_glo"), F.max("_hi").alias("_ghi")))
    out = rows.join(F.broadcast(edge), rows[col].eqNullSafe(edge["_v"]), "left")
    lo = F.coalesce(F.col("_glo"), F.col("_lo"))
    hi = F.coalesce(F.col("_ghi"), F.col("_hi"))
    return (out.withColumn(name, (lo + hi) / 2.0 + 1.0)
            .drop(BLK, POS, BKT, "_off", "_cnt", "_lo", "_hi", "_v", "_glo", "_ghi"))


def running_counts(base: DataFrame, col: str, n_blocks: int | None = None) -> DataFrame:
    """(_v, _c, _end) of every different value of ``col``: its rows, and the
    rows up to and with it.  Values are counted inside the scan, so blocks hold
    different values and one with very many rows is a single row of its block."""
    from islet.operators.ordered import BKT, BLK, POS, range_blocks
    from islet.session import scratch_table
    spark = base.sparkSession
    name, path = scratch_table(spark, "values")  # counted once, not at each look of range_blocks
    base.groupBy(F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_c")).write.format("parquet").option("path", path).saveAsTable(name)
    b = range_blocks(spark.table(name), ["_v"], n_blocks)
    before = Window.orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    offs = (b.groupBy(BKT, BLK).agg(F.sum("_c").alias("_bc"))
            .select(BLK, F.coalesce(F.sum("_bc").over(before), F.lit(0)).alias("_off")))
    upto = Window.partitionBy(BKT, BLK).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    return b.join(F.broadcast(offs), BLK).select("_v", "_c", (F.col("_off") + F.sum("_c").over(upto)).alias("_end"))


def spearman(df: DataFrame, x: str, y: str, tie: Sequence[str], n_blocks: int | None = None) -> DataFrame:
    """M2: Spearman rho = Pearson r of average ranks (rows with both present)."""
    base = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*tie, x, y)
    rx = avg_rank(base, x, tie, "_rx", n_blocks)
    rxy = avg_rank(rx, y, tie, "_ry", n_blocks)
    return rxy.agg(F.corr("_rx", "_ry").alias("rho"), F.count(F.lit(1)).alias("n"))


def _cells(df: DataFrame, r: str, c: str) -> DataFrame:
    """Observed cells with their totals: (r, c, observed, _rt, _ct, _n); rows
    with a NULL level are left out.  Row data is only counted per cell; the
    rest works on one row per cell."""
    cells = df.dropna(subset=[r, c]).groupBy(r, c).agg(F.count(F.lit(1)).alias("observed"))
    rt = cells.groupBy(r).agg(F.sum("observed").alias("_rt"))
    ct = cells.groupBy(c).agg(F.sum("observed").alias("_ct"))
    n = cells.agg(F.sum("observed").alias("_n"))
    return attach_scalar(cells.join(rt, r).join(ct, c), n).select(r, c, "observed", "_rt", "_ct", "_n")


def contingency(df: DataFrame, r: str, c: str) -> DataFrame:
    """Dense r x c counts in long form: absent cells are present with 0 (H8);
    rows with a NULL level are left out.

    Every level of ``r`` takes the levels of ``c`` it lacks from one array of
    all of them, which is no larger than that level's own part of the
    result, so neither a pivot's level limit nor a cross join is needed."""
    cells = df.dropna(subset=[r, c]).groupBy(r, c).agg(F.count(F.lit(1)).alias("observed"))
    levels = cells.agg(F.collect_set(c).alias("_levels"))
    every = attach_scalar(cells.select(r).distinct(), levels).select(r, F.explode("_levels").alias(c))
    return every.join(cells, [r, c], "left").fillna(0, ["observed"]).select(r, c, "observed")


def chi2_cells(df: DataFrame, r: str, c: str) -> DataFrame:
    """M4: per cell observed, expected = row * col / total, and the Pearson
    residual (o - e) / sqrt(e)."""
    cells = contingency(df, r, c)
    rt = cells.groupBy(r).agg(F.sum("observed").alias("_rt"))
    ct = cells.groupBy(c).agg(F.sum("observed").alias("_ct"))
    both = attach_scalar(cells.join(rt, r).join(ct, c), cells.agg(F.sum("observed").alias("_n")))
    e = both.withColumn("expected", F.col("_rt") * F.col("_ct") / F.col("_n"))
    return (e.withColumn("residual", (F.col("observed") - F.col("expected")) / F.sqrt("expected"))
            .select(r, c, "observed", "expected", "residual"))


def chi2(df: DataFrame, r: str, c: str) -> DataFrame:
    """M3: one row: chi-square statistic of independence (``chi2``), the same
    with Yates' continuity correction where the source applies it, at dof 1
    (``chi2_corrected``, else equal), degrees of freedom, n, and the p-value
    ``p`` of the corrected statistic (NULL without a degree of freedom).

    Absent cells add e each to the statistic and all e sum to n, so it is
    sum(o^2 / e) - n over the observed cells alone.  In a 2 x 2 table
    |o - e| is the same in all cells, so the correction is one factor."""
    x = _cells(df, r, c).withColumn("_e", F.col("_rt") * F.col("_ct") / F.col("_n"))
    d = F.col("_d")
    one = (x.agg((F.sum(F.col("observed") * F.col("observed") / F.col("_e")) - F.sum("observed")).alias("chi2"),
                  ((F.countDistinct(r) - 1) * (F.countDistinct(c) - 1)).alias("dof"),
                  F.sum("observed").alias("n"), F.max(F.abs(F.col("observed") - F.col("_e"))).alias("_d"))
            .select("chi2", F.when((F.col("dof") == 1) & (d > 0), F.col("chi2") * F.pow((d - F.least(F.lit(0.5), d)) / d, F.lit(2)))
                    .otherwise(F.col("chi2")).alias("chi2_corrected"), "dof", "n"))
    return one.withColumn("p", F.when(F.col("dof") > 0, chi2_upper(F.col("chi2_corrected"), F.col("dof"))))


def erfc(z: Column) -> Column:
    """The complementary error function of z >= 0: a series below 3, a
    continued fraction of 60 steps from there on."""
    square = z * z
    grow = F.aggregate(F.sequence(F.lit(1), F.lit(60)), F.struct(z.alias("term"), z.alias("sum")),
                       lambda a, k: F.struct((a["term"] * 2 * square / (2 * k + 1)).alias("term"), (a["sum"] + a["term"] * 2 * square / (2 * k + 1)).alias("sum")), lambda a: a["sum"])
    tail = F.aggregate(F.sequence(F.lit(60), F.lit(1)), F.lit(0.0), lambda t, k: k / 2 / (z + t))
    root = F.lit(math.sqrt(math.pi))
    return F.when(z < 3, 1 - 2 / root * F.exp(-square) * grow).otherwise(F.exp(-square) / root / (z + tail))


def chi2_upper(stat: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution as a column: Q(a, x) with
    x = stat / 2 is stepped from a = 1 (even dof) or 1/2 (odd) up to dof / 2,
    a positive term a step, in logs so that no step underflows."""
    x, odd = F.greatest(stat, F.lit(0.0)) / 2, dof % 2 == 1
    first = F.when(odd, F.lit(0.5)).otherwise(1.0)
    start = F.when(odd, erfc(F.sqrt(x))).otherwise(F.exp(-x))
    log_term = first * F.log(x) - x - F.when(odd, F.lit(math.lgamma(1.5))).otherwise(0.0)
    steps = F.floor((dof - 1) / 2).cast("int")

    def step(acc, k):
        return F.struct((acc["log"] + F.log(x) - F.log(first + k)).alias("log"), (acc["sum"] + F.exp(acc["log"])).alias("sum"))

    more = F.aggregate(F.sequence(F.lit(1), steps), F.struct(log_term.alias("log"), F.lit(0.0).alias("sum")), step, lambda a: a["sum"])
    return F.when(x <= 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), start + F.when(steps > 0, more).otherwise(0.0)))


def chi2_pvalue(stat: float, dof: int) -> float:
    """Upper tail of the chi-square distribution (regularised upper
    incomplete gamma Q(dof/2, stat/2)), for the scalar result of ``chi2``."""
    a, x = dof / 2.0, stat / 2.0
    if x <= 0:
        return 1.0
    if x < a + 1:  # series for P, then Q = 1 - P
        term = total = 1.0 / a
        n = a
        for _ in range(10000):
            n += 1
            term *= x / n
            total += term
            if abs(term) < abs(total) * 1e-15:
                break
        return max(0.0, 1.0 - total * math.exp(-x + a * math.log(x) - math.lgamma(a)))
    # continued fraction for Q (Lentz)
    tiny = 1e-300
    b = x + 1 - a
    cc = 1 / tiny
    d = 1 / b
    h = d
    for i in range(1, 10000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = tiny if abs(d) < tiny else d
        cc = b + an / cc
        cc = tiny if abs(cc) < tiny else cc
        d = 1 / d
        delta = d * cc
        h *= delta
        if abs(delta - 1) < 1e-15:
            break
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def moments(df: DataFrame, value: str) -> DataFrame:
    """M7: n, mean, population skewness g1, excess kurtosis g2 and the
    Jarque-Bera statistic n/6 (g1^2 + g2^2 / 4)."""
    v = F.col(value)
    one = df.agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.skewness(v).alias("skewness"),
                 F.kurtosis(v).alias("kurtosis"))
    return one.withColumn("jarque_bera", F.col("n") / 6.0 * (F.col("skewness") ** 2 + F.col("kurtosis") ** 2 / 4.0))


def normal_cdf(z: Column) -> Column:
    """The standard normal distribution function as a column."""
    tail = erfc(F.abs(z) / math.sqrt(2.0)) / 2
    return F.when(z > 0, 1 - tail).otherwise(tail)


def normal_distance(df: DataFrame, value: str, n_blocks: int | None = None) -> DataFrame:
    """M7: one row (n, mean, std, distance): the Kolmogorov-Smirnov distance
    between the values and the normal distribution of their mean and sample
    std.  NULL and NaN are left out; without spread the distance is NULL.

    The empirical distribution is a running count over the different values:
    they are counted inside the scan and cut into blocks, each block gives its
    largest gap once it knows the rows before it, and the largest of these is
    the distance."""
    from islet.operators.ordered import BKT, BLK, POS, range_blocks
    v = F.col(value).cast("double")
    base = df.select(v.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    b = range_blocks(base.groupBy("_v").agg(F.count(F.lit(1)).alias("_c")), ["_v"], n_blocks)
    before = Window.orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    offs = (b.groupBy(BKT, BLK).agg(F.sum("_c").alias("_bc"))
            .select(BLK, F.coalesce(F.sum("_bc").over(before), F.lit(0)).alias("_off")))
    moments_ = base.agg(F.count("_v").alias("n"), F.avg("_v").alias("mean"), F.stddev_samp("_v").alias("std"))
    upto = Window.partitionBy(BKT, BLK).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    runs = b.join(F.broadcast(offs), BLK).select("_v", "_c", (F.col("_off") + F.sum("_c").over(upto)).alias("_end"))
    at = attach_scalar(runs, moments_)
    p = normal_cdf(F.when(F.col("std") > 0, (F.col("_v") - F.col("mean")) / F.nullif(F.col("std"), F.lit(0.0))))
    gap = F.greatest(F.abs(F.col("_end") / F.col("n") - p), F.abs(p - (F.col("_end") - F.col("_c")) / F.col("n")))
    return attach_scalar(moments_, at.filter("std > 0").agg(F.max(gap).alias("distance")))


def _norm_ppf() -> callable:
    """Inverse standard normal CDF as a column expression (Acklam's rational
    approximation, |error| < 1.2e-9), so Q-Q points stay in the JVM."""
    a = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
         1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
    b = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
         6.680131188771972e+01, -1.328068155288572e+01]
    c = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
         -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
    d = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00]

    def poly(coef, x):
        out = F.lit(coef[0])
        for k in coef[1:]:
            out = out * x + F.lit(k)
        return out

    def ppf(p):
        plow = 0.02425
        q_lo = F.sqrt(-2 * F.log(p))
        q_hi = F.sqrt(-2 * F.log(1 - p))
        q = p - 0.5
        r = q * q
        low = poly(c, q_lo) / (poly(d, q_lo) * q_lo + 1)
        mid = poly(a, r) * q / (poly(b, r) * r + 1)
        high = -poly(c, q_hi) / (poly(d, q_hi) * q_hi + 1)
        return F.when(p < plow, low).when(p > 1 - plow, high).otherwise(mid)

    return ppf


def qq_points(df: DataFrame, value: str, tie: Sequence[str], n_blocks: int | None = None) -> DataFrame:
    """M5: normal Q-Q points with Filliben plotting positions (as scipy's
    probplot), plus the fit R^2 in every row."""
    base = df.select(value, *tie).filter(F.col(value).isNotNull())
    idx = with_global_index(base, [value, *tie], "i", start=1, n_blocks=n_blocks)
    n = idx.agg(F.count(F.lit(1)).alias("_n"))
    x = attach_scalar(idx, n)
    nn = F.col("_n").cast("double")
    last = F.pow(F.lit(0.5), 1.0 / nn)
    m = (F.when(F.col("i") == 1, 1 - last)
         .when(F.col("i") == F.col("_n"), last)
         .otherwise((F.col("i") - 0.3175) / (nn + 0.365)))
    pts = x.withColumn("theoretical", _norm_ppf()(m)).withColumnRenamed(value, "ordered")
    r2 = pts.agg((F.corr("theoretical", "ordered") ** 2).alias("r2"))
    return attach_scalar(pts.select("i", "theoretical", "ordered"), r2)


def sparse_levels(df: DataFrame, col: str, k: int = 5) -> DataFrame:
    """M6: level counts with a flag for fewer than k rows."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).withColumn("sparse", F.col("n") < k)


def rmse(df: DataFrame, pred: str, actual: str, by=None, name: str = "rmse") -> DataFrame:
    """M8: sqrt(mean((pred - actual)^2)) over rows with both present."""
    d = F.col(pred) - F.col(actual)
    by = [by] if isinstance(by, str) else list(by or [])
    return df.groupBy(*by).agg(F.sqrt(F.avg(d * d)).alias(name), F.count(d).alias("n"))


def bias_std(df: DataFrame, resid: str, by=None) -> DataFrame:
    """M9: mean signed residual and population std (numpy ddof=0)."""
    by = [by] if isinstance(by, str) else list(by or [])
    return df.groupBy(*by).agg(F.avg(resid).alias("bias"), F.stddev_pop(resid).alias("std"))


def corr_matrix(df: DataFrame, cols: Sequence[str], method: str = "spearman") -> DataFrame:
    """M1 / M2 matrix form: Pearson or Spearman correlation of every column
    pair, long (x, y, r), over rows where all columns are present.  Spearman
    is Pearson of average ranks, ties averaged like pandas: a rank for each
    different value of each column, joined to the rows, and one aggregate for
    all pairs.  So a column of few values puts no more rows into a task than
    one of many.  A column without spread has no r."""
    base = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    names, rows = list(cols), base
    if method == "spearman":
        names = [f"_r{i}" for i in range(len(cols))]
        for i, c in enumerate(cols):
            ranks = running_counts(base, c).select(F.col("_v").alias(f"_v{i}"), (F.col("_end") - (F.col("_c") - 1) / 2.0).alias(f"_r{i}"))
            rows = rows.join(small_side(ranks), rows[c] == F.col(f"_v{i}"))
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    one = rows.agg(*[F.corr(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs])
    each = [F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"c{min(i, j)}_{max(i, j)}").alias("r")) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return one.select(F.inline(F.array(*each)))
