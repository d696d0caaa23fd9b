"""Profiling, grouping and cross-tabulation.

Exact quantiles never gather a group's values into one buffer: counts per
(group, value) are sorted over range blocks, and the two values around each
wanted position are picked out (linear interpolation, as pandas and DuckDB's
``quantile_cont`` do).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from islet.operators.joins import attach_scalar
from islet.operators.ordered import BKT, BLK, POS, range_blocks


def _l(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def freq(df: DataFrame, cols, keep_null: bool = True, name: str = "count") -> DataFrame:
    """A1 / A2: value counts; the NULL bucket is kept unless keep_null=False."""
    cols = _l(cols)
    base = df if keep_null else df.dropna(subset=cols)
    return base.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))


def duplicate_groups(df: DataFrame, keys: Sequence[str], name: str = "n_copies", at_least: int = 2,
                     firsts: Mapping[str, str] | None = None) -> DataFrame:
    """Groups of identical keys with HAVING count >= at_least;
    ``firsts`` adds the smallest value of a column under a name."""
    more = [F.min(c).alias(n) for n, c in (firsts or {}).items()]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name), *more).filter(F.col(name) >= at_least)


def quantiles(df: DataFrame, value: str, qs: Sequence[float], by=None, names: Sequence[str] | None = None,
              n_blocks: int | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles of ``value`` per group
    (NULLs ignored), one row per group with a column per quantile.

    Rows are counted per (group, value) first, so a repeated value is one
    row however often it occurs; cumulative counts over the blocks of these
    give each value the run of positions it fills, and a partial aggregate
    picks the values whose runs hold the wanted positions."""
    by = _l(by)
    names = list(names) if names else [f"q{int(round(q * 100)):02d}" for q in qs]
    vals = (df.select(*by, value).filter(F.col(value).isNotNull())
            .groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c")))
    b = range_blocks(vals, by + [value], n_blocks)
    sums = b.groupBy(BKT, BLK).agg(F.sum("_c").alias("_bc")).drop(BKT)
    before = Window.orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    offs = sums.select(BLK, F.coalesce(F.sum("_bc").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(BKT, BLK).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    runs = (b.join(F.broadcast(offs), BLK)
            .select(*by, F.col(value).alias("_v"), "_c", (F.col("_off") + F.sum("_c").over(inside)).alias("_end")))
    grp = runs.groupBy(*by).agg(F.min(F.col("_end") - F.col("_c")).alias("_first"), F.sum("_c").alias("_n"))
    runs = _join_groups(runs, grp, by) if by else attach_scalar(runs, grp)
    start, end = F.col("_end") - F.col("_c") - F.col("_first"), F.col("_end") - F.col("_first")
    aggs = []
    for i, q in enumerate(qs):
        h = (F.col("_n") - 1) * F.lit(float(q))
        for side, at in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            aggs.append(F.max(F.when((start <= at) & (at < end), F.col("_v"))).alias(f"_{side}{i}"))
        aggs.append(F.max(h - F.floor(h)).alias(f"_frac{i}"))
    got = runs.groupBy(*by).agg(*aggs)
    return got.select(*by, *[(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_frac{i}")).alias(n)
                             for i, n in enumerate(names)])


def _join_groups(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of two one-row-per-group tables; a NULL group meets itself."""
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = [left[k].eqNullSafe(right[f"_r_{k}"]) for k in keys]
    return left.join(right, same, "left").drop(*[f"_r_{k}" for k in keys])


def median(df: DataFrame, value: str, by=None, name: str = "median", n_blocks: int | None = None) -> DataFrame:
    return quantiles(df, value, [0.5], by, [name], n_blocks=n_blocks)


def group_summary(df: DataFrame, keys, value: str, n_blocks: int | None = None) -> DataFrame:
    """Mean, median, sample std (pandas ddof=1) and count per group."""
    keys = _l(keys)
    agg = df.groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
                                F.count(value).alias("count"))
    med = median(df, value, keys, n_blocks=n_blocks)
    return _join_groups(agg, med, keys) if keys else attach_scalar(agg, med)


def group_means(df: DataFrame, keys, values: Sequence[str]) -> DataFrame:
    """A14."""
    return df.groupBy(*_l(keys)).agg(*[F.avg(v).alias(f"mean_{v}") for v in values])


def describe(df: DataFrame, value: str, by=None, n_blocks: int | None = None) -> DataFrame:
    """Count, mean, std, min, quartiles, max (pandas ``describe``)."""
    by = _l(by)
    agg = df.groupBy(*by).agg(F.count(value).alias("count"), F.avg(value).alias("mean"),
                              F.stddev_samp(value).alias("std"), F.min(value).alias("min"),
                              F.max(value).alias("max"))
    q = quantiles(df, value, [0.25, 0.5, 0.75], by, ["q25", "q50", "q75"], n_blocks=n_blocks)
    return _join_groups(agg, q, by) if by else attach_scalar(agg, q)


def describe_many(df: DataFrame, cols: Sequence[str], qs: Sequence[float] = (0.25, 0.5, 0.75), n_blocks: int | None = None) -> DataFrame:
    """A16 over several columns: a row for each with count, mean, std, min, the
    quantiles and max.  The columns are stacked into one (column, value) table
    that is counted by value inside the scan, so all of them share one row
    shuffle.  A column without values has count 0 and NULLs."""
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols]))
    long = df.select(stacked.alias("_s")).select("_s.*")
    v = F.col("value")
    agg = long.groupBy("column").agg(F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"))
    return _join_groups(agg, quantiles(long, "value", qs, ["column"], n_blocks=n_blocks), ["column"])


def box_stats(df: DataFrame, key, value: str, n_blocks: int | None = None) -> DataFrame:
    """q1 / median / q3 per category."""
    return quantiles(df, value, [0.25, 0.5, 0.75], key, ["q1", "median", "q3"], n_blocks=n_blocks)


def crosstab(df: DataFrame, r: str, c: str, levels: Sequence | None = None) -> DataFrame:
    """Wide counts, absent cells 0 (pivot levels are given or discovered).
    Rows with a NULL level are left out here and in the other crosstabs."""
    p = df.dropna(subset=[r, c]).groupBy(r).pivot(c, list(levels) if levels is not None else None).count()
    return p.fillna(0)


def crosstab_long(df: DataFrame, r: str, c: str, normalize: str | None = None, name: str = "n") -> DataFrame:
    """A17 / A18 in long form: one row per observed cell, share by row,
    column or all (``normalize`` in {None, 'index', 'columns', 'all'})."""
    cells = df.dropna(subset=[r, c]).groupBy(r, c).agg(F.count(F.lit(1)).alias(name))
    if normalize is None:
        return cells
    if normalize == "all":
        total = cells.agg(F.sum(name).alias("_total"))
        return attach_scalar(cells, total).withColumn("share", F.col(name) / F.col("_total")).drop("_total")
    return cells.withColumn("share", F.col(name) / F.sum(name).over(Window.partitionBy({"index": r, "columns": c}[normalize])))


def crosstab_margins(df: DataFrame, r: str, c: str, label: str = "All", name: str = "n") -> DataFrame:
    """Counts with row, column and grand totals (CUBE + grouping id)."""
    cube = df.dropna(subset=[r, c]).cube(r, c).agg(F.count(F.lit(1)).alias(name), F.grouping_id(r, c).alias("_g"))
    return cube.select(F.when(F.col("_g").bitwiseAND(2) > 0, F.lit(label)).otherwise(F.col(r).cast("string")).alias(r),
                       F.when(F.col("_g").bitwiseAND(1) > 0, F.lit(label)).otherwise(F.col(c).cast("string")).alias(c),
                       name)


def group_share(df: DataFrame, outer, inner, name: str = "count") -> DataFrame:
    """Count per (outer, inner) and its share within outer."""
    outer, inner = _l(outer), _l(inner)
    cells = df.groupBy(*outer, *inner).agg(F.count(F.lit(1)).alias(name))
    return cells.withColumn("proportion", F.col(name) / F.sum(name).over(Window.partitionBy(*outer)))


def monthly_counts(df: DataFrame, date: str, fmt: str = "yyyy_MM", name: str = "n") -> DataFrame:
    """A11 / F11."""
    return df.groupBy(F.date_format(date, fmt).alias("month")).agg(F.count(F.lit(1)).alias(name))


def coverage(df: DataFrame, date: str) -> DataFrame:
    """A10: range and span of a date column plus NULL count, one row."""
    return df.agg(F.min(date).alias("first"), F.max(date).alias("last"),
                  F.datediff(F.max(date), F.min(date)).alias("span_days"),
                  F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(date).isNull()).alias("n_null"))


def residual_stats(df: DataFrame, keys, resid: str) -> DataFrame:
    """N, mean and RMSE of residuals per group."""
    r = F.col(resid)
    return df.groupBy(*_l(keys)).agg(F.count(r).alias("n"), F.avg(r).alias("mean"),
                                     F.sqrt(F.avg(r * r)).alias("rmse"))


def argmin_rows(df: DataFrame, keys, metric: str, cols: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """Per group, the row with the smallest metric (ties by ``tie``)."""
    keys = _l(keys)
    order = F.struct(F.col(metric), *[F.col(t) for t in tie])
    best = F.min_by(F.struct(*[F.col(c) for c in cols]), order)
    return df.groupBy(*keys).agg(best.alias("_b")).select(*keys, *[F.col(f"_b.{c}").alias(c) for c in cols])


def pivot_wide(df: DataFrame, r: str, c: str, value: str, order: Sequence, agg: str = "avg") -> DataFrame:
    """Long -> wide with a fixed column order."""
    return df.groupBy(r).pivot(c, list(order)).agg(getattr(F, agg)(value))


def range_stats(df: DataFrame, keys, metric: str) -> DataFrame:
    """Min / max / mean and spread per group."""
    m = F.col(metric)
    return (df.groupBy(*_l(keys)).agg(F.min(m).alias("min"), F.max(m).alias("max"), F.avg(m).alias("mean"))
            .withColumn("spread", F.col("max") - F.col("min")))


def share_where(df: DataFrame, keys, pred: Column, name: str = "pct") -> DataFrame:
    """Percentage of rows meeting pred, with the count; a NULL pred is
    a row that does not meet it."""
    return df.groupBy(*_l(keys)).agg(F.count_if(pred).alias("n_true"), F.count(F.lit(1)).alias("n"),
                                     (F.count_if(pred) * 100.0 / F.count(F.lit(1))).alias(name))


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Equal-width bin counts between min and max (the last bin closed)."""
    rng = df.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    x = attach_scalar(df.select(value).filter(F.col(value).isNotNull()), rng)
    width = F.col("_hi") - F.col("_lo")
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col(value) - F.col("_lo")) / width * F.lit(bins)), F.lit(bins - 1)))
    return (x.withColumn("bin", b.cast("int"))
            .groupBy("bin").agg(F.count(F.lit(1)).alias("count"),
                                F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"))
            .withColumn("bin_lo", F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("bin") / F.lit(bins))
            .drop("_lo", "_hi"))


def histogram_auto(df: DataFrame, value: str, n_blocks: int | None = None) -> DataFrame:
    """A27 with bins chosen by the data: the narrower of the Freedman-Diaconis
    width (2 IQR / n^(1/3)) and Sturges' (range / (log2 n + 1)), the latter
    alone without spread between the quartiles; one bin without any spread.
    Columns bin, count, bin_lo, n_bins; empty bins are left out."""
    x = df.select(F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    facts = attach_scalar(x.agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count("_v").alias("_n")), quantiles(x, "_v", [0.25, 0.75], n_blocks=n_blocks))
    spread = F.col("_hi") - F.col("_lo")
    fd = 2 * (F.col("q75") - F.col("q25")) / F.pow(F.col("_n").cast("double"), F.lit(1 / 3))
    sturges = spread / (F.log2(F.col("_n").cast("double")) + 1)
    width = F.when(fd > 0, F.least(fd, sturges)).otherwise(sturges)
    facts = facts.select("_lo", "_hi", F.when(spread > 0, F.ceil(spread / width)).otherwise(1).cast("long").alias("n_bins"))
    x = attach_scalar(x, facts)
    at = F.when(spread > 0, F.least(F.floor((F.col("_v") - F.col("_lo")) / spread * F.col("n_bins")), F.col("n_bins") - 1)).otherwise(0)
    out = x.groupBy(at.cast("long").alias("bin"), "_lo", "_hi", "n_bins").agg(F.count(F.lit(1)).alias("count"))
    return out.select("bin", "count", (F.col("_lo") + spread * F.col("bin") / F.col("n_bins")).alias("bin_lo"), "n_bins")


def group_trend(df: DataFrame, key, date: str, value: str, min_n: int = 5) -> DataFrame:
    """Least-squares line of value on day number per group;
    groups of fewer than ``min_n`` values have no line."""
    x = F.unix_date(F.to_date(date)).cast("double")
    y = F.col(value).cast("double")
    line = lambda v: F.when(F.count(y) >= min_n, v)
    return df.groupBy(*_l(key)).agg(line(F.regr_slope(y, x)).alias("slope"), line(F.regr_intercept(y, x)).alias("intercept"),
                                    F.count(y).alias("n"))


def summary_with_without(df: DataFrame, value: str, outlier: Column, n_blocks: int | None = None) -> DataFrame:
    """Mean / median / std with and without flagged rows; both medians
    come from one table of value counts."""
    v = F.col(value)
    kept = F.when(~outlier, v)
    both = df.select(F.explode(F.array(F.struct(F.lit("all").alias("side"), v.alias("v")), F.struct(F.lit("without").alias("side"), kept.alias("v")))).alias("_s"))
    med = median(both.select("_s.*"), "v", ["side"], n_blocks=n_blocks)
    med = med.agg(*[F.max(F.when(F.col("side") == s, F.col("median"))).alias(f"median_{s}") for s in ("all", "without")])
    one = df.agg(F.avg(v).alias("mean_all"), F.stddev_samp(v).alias("std_all"),
                 F.avg(kept).alias("mean_without"), F.stddev_samp(kept).alias("std_without"),
                 F.count_if(outlier).alias("n_outliers"))
    return attach_scalar(one, med)


def null_profile(df: DataFrame) -> DataFrame:
    """Per column its type, non-NULL and NULL counts, from one pass
    (one aggregate row, unpivoted)."""
    aggs = [F.count(F.col(c)).alias(c) for c in df.columns] + [F.count(F.lit(1)).alias("__n")]
    one = df.agg(*aggs)
    types = {c: t for c, t in df.dtypes}
    long = one.unpivot("__n", [F.col(c).alias(c) for c in df.columns], "column_name", "non_null")
    dt = df.sparkSession.createDataFrame([(c, types[c], i) for i, c in enumerate(df.columns)],
                                         "column_name string, dtype string, position int")
    return (long.join(F.broadcast(dt), "column_name")
            .select("position", "column_name", "dtype", "non_null", (F.col("__n") - F.col("non_null")).alias("nulls")))


def transpose(df: DataFrame, id_col: str) -> DataFrame:
    """(id, column, value) long form of a small wide result."""
    vals = [c for c in df.columns if c != id_col]
    return df.select(id_col, *[F.col(c).cast("string").alias(c) for c in vals]).unpivot(
        id_col, vals, "column", "value")


# -- data-quality checks (Q1-Q5): one row (check, n_failures) per check --

def not_null(col: str, where: Column | None = None) -> tuple[str, Column]:
    """Q1 / Q2 as a rule for ``row_checks``: (name, failing condition)."""
    if where is None:
        return f"not_null:{col}", F.col(col).isNull()
    return f"not_null_where:{col}", where & F.col(col).isNull()


def accepted(col: str, values: Sequence) -> tuple[str, Column]:
    """Q3 as a rule: NULL passes, like dbt's accepted_values."""
    return f"accepted_values:{col}", F.col(col).isNotNull() & ~F.col(col).isin(list(values))


def row_checks(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """Failing rows of every rule, in one aggregate over one scan."""
    one = df.agg(*[F.count_if(fail).alias(f"_{i}") for i, (_, fail) in enumerate(rules)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(name).alias("check"), F.col(f"_{i}").alias("n_failures"))
                                         for i, (name, _) in enumerate(rules)])))


def check_not_null(df: DataFrame, col: str, where: Column | None = None) -> DataFrame:
    """Q1 / Q2."""
    return row_checks(df, [not_null(col, where)])


def check_accepted(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Q3."""
    return row_checks(df, [accepted(col, values)])


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q4: number of key values that occur more than once."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return row_checks(dup, [("unique:" + ",".join(keys), F.col("_n") > 1)])


def run_checks(checks: Sequence[DataFrame]) -> DataFrame:
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out.withColumn("passed", F.col("n_failures") == 0)


# -- sorts and top-k (O1, O2, O4-O6) --

def top_k(df: DataFrame, keys: Sequence, k: int) -> DataFrame:
    """O2: ORDER BY keys LIMIT k (mixed asc / desc Columns allowed); planned
    as TakeOrderedAndProject: each task keeps its own k, then one merge."""
    return df.orderBy(*keys).limit(k)


def n_largest(df: DataFrame, col: str, k: int, tie: Sequence[str] = ()) -> DataFrame:
    """The k rows with the largest ``col`` (ties by ``tie``)."""
    return top_k(df, [F.col(col).desc(), *[F.col(t) for t in tie]], k)


def sort_abs(df: DataFrame, col: str, descending: bool = True) -> DataFrame:
    """Sort by absolute value (output ordering only)."""
    a = F.abs(F.col(col))
    return df.orderBy(a.desc() if descending else a.asc())


def sort_category(df: DataFrame, col: str, order: Sequence[str]) -> DataFrame:
    """Sort by a custom level order; unknown levels last."""
    pos = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(col))
    return df.orderBy(F.when(pos == 0, F.lit(len(order) + 1)).otherwise(pos))


# -- log audit (Q5) --

def audit(df: DataFrame, date: str, duration: str, keys: Sequence[str], seq: str,
          long_minutes: int = 240, n_blocks: int | None = None) -> DataFrame:
    """Q5: the log's quality audit as one long table (check, n):
    remaining NULL dates, zero and over-long durations, duplicated rows
    (groups of identical keys with more than one row) and dates that go
    backwards in arrival order."""
    from islet.operators.ordered import order_violations
    base = df.agg(F.count_if(F.col(date).isNull()).alias("null_dates"),
                  F.count_if(F.col(duration) == 0).alias("zero_duration"),
                  F.count_if(F.col(duration) > long_minutes).alias("over_long"))
    dups = duplicate_groups(df, list(keys)).agg(F.count(F.lit(1)).alias("duplicate_groups"))
    back = order_violations(df, [seq], date, n_blocks=n_blocks).agg(F.count(F.lit(1)).alias("out_of_order"))
    one = attach_scalar(attach_scalar(base, dups), back)
    names = ["null_dates", "zero_duration", "over_long", "duplicate_groups", "out_of_order"]
    return one.unpivot([], names, "check", "n")
