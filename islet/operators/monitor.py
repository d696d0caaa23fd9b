"""Scoring and monitoring (ML15-ML22, C10, C11, P19-P21).

Linear models are scored as column expressions (no model object, no UDF);
rolling drift statistics use the block-decomposed rolling window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from islet.functions import scalars as S
from islet.operators.clean import drop_incomplete
from islet.operators.joins import attach_scalar
from islet.operators.models import predict_tree
from islet.operators.ordered import rolling, with_global_index
from islet.operators.profile import group_share, residual_stats


def score_pending(df: DataFrame, model: Mapping, digits: int = 1, name: str = "predicted_hours") -> tuple[DataFrame, DataFrame]:
    """ML15: drop rows missing an input, score with the linear expression,
    round half-to-even (numpy's rounding), highest first.  Also returns the
    one-row count of skipped rows."""
    kept, dropped = drop_incomplete(df, list(model["coefficients"]))
    pred = S.linear_score(model["coefficients"], model["intercept"])
    return kept.withColumn(name, F.bround(pred, digits)).orderBy(F.col(name).desc()), dropped


def era(df: DataFrame, date: str, cutoff: str, name: str = "era") -> DataFrame:
    """ML18: 'train' up to and including the cutoff date, 'post' after."""
    return df.withColumn(name, F.when(F.to_date(date) <= F.to_date(F.lit(cutoff)), F.lit("train"))
                         .otherwise(F.lit("post")))


def score_many(df: DataFrame, models: Sequence[Mapping], label: str, fill_missing: bool = False) -> DataFrame:
    """ML16: pred_<id> and resid_<id> (= label - pred) per model: a linear one
    (``coefficients``, ``intercept``) or a fitted tree model (``model``, ``features``).
    ``fill_missing`` zero-fills absent feature columns (the source's
    behaviour, SURVEY D3); by default absent features are an error."""
    out = df
    for m in models:
        feats = list(m["features"] if "model" in m else m["coefficients"])
        missing = [f for f in feats if f not in out.columns]
        if missing:
            if not fill_missing:
                raise ValueError(f"model {m['id']} needs {missing}")
            out = out.withColumns({f: F.lit(0) for f in missing})
        if "model" in m:
            out = predict_tree(out, m["model"], feats, f"pred_{m['id']}")
        else:
            out = out.withColumn(f"pred_{m['id']}", S.linear_score(m["coefficients"], m["intercept"]))
        out = out.withColumn(f"resid_{m['id']}", F.col(label) - F.col(f"pred_{m['id']}"))
    return out


def rmse_report(scored: DataFrame, model_ids: Sequence[str], era_col: str = "era",
                holdout: float = S.HOLDOUT_RMSE, b1: float = S.B1_RMSE) -> DataFrame:
    """ML17 + P20: overall and post-era RMSE per model with the verdict."""
    aggs = []
    for m in model_ids:
        r = F.col(f"resid_{m}")
        post = F.when(F.col(era_col) == "post", r)
        aggs += [F.sqrt(F.avg(r * r)).alias(f"{m}__all"), F.sqrt(F.avg(post * post)).alias(f"{m}__post"),
                 F.count(r).alias(f"{m}__n"), F.count(post).alias(f"{m}__npost")]
    rows = [F.struct(F.lit(m).alias("model_id"), F.col(f"{m}__all").alias("overall_rmse"),
                     F.col(f"{m}__post").alias("post_rmse"), F.col(f"{m}__n").alias("n_total"),
                     F.col(f"{m}__npost").alias("n_post")) for m in model_ids]
    out = scored.agg(*aggs).select(F.inline(F.array(*rows)))
    return out.withColumn("verdict", S.verdict("overall_rmse", holdout, b1))


def drift_report(scored: DataFrame, order: Sequence[str], resid: str, era_col: str = "era",
                 k: int = S.DRIFT_WINDOW, min_periods: int = S.DRIFT_MIN_PERIODS,
                 threshold: float = S.DRIFT_THRESHOLD, n_blocks: int | None = None) -> DataFrame:
    """ML19 + P19: rolling mean residual and rolling RMSE over the post-era
    rows in order; ``step`` is the 1-based position; rows before
    ``min_periods`` are dropped (they have no value), ``drift`` flags
    |mean| > threshold."""
    post = scored.filter(F.col(era_col) == "post")
    r = rolling(post, list(order), resid, k, min_periods, aggs=("mean", "rmse"), index="_i", n_blocks=n_blocks)
    return (r.withColumn("step", F.col("_i") + 1).drop("_i")
            .filter(F.col("rolling_mean").isNotNull())
            .withColumnRenamed("rolling_mean", "rolling_mean_resid")
            .withColumn("drift", S.flag_abs("rolling_mean_resid", threshold)))


def retrain_signal(drift: DataFrame, threshold: float = S.DRIFT_THRESHOLD, rmse_limit: float = S.B1_RMSE) -> DataFrame:
    """ML22 + P21: the latest drift row (max step) -> drift flag, direction
    and the retrain recommendation; an empty drift table gives flag 0."""
    latest = drift.agg(F.max_by(F.struct("step", "rolling_mean_resid", "rolling_rmse"), F.col("step")).alias("l"),
                       F.count(F.lit(1)).alias("n_rows"))
    m = F.col("l.rolling_mean_resid")
    return latest.select(
        F.col("n_rows"), F.col("l.step").alias("step"), m.alias("latest_mean_resid"),
        F.col("l.rolling_rmse").alias("latest_rolling_rmse"),
        F.coalesce(S.flag_abs(m, threshold).cast("int"), F.lit(0)).alias("drift_flag"),
        F.when(S.flag_abs(m, threshold), S.drift_direction(m)).alias("direction"),
        F.coalesce((S.flag_abs(m, threshold) | (F.col("l.rolling_rmse") > F.lit(rmse_limit))).cast("int"),
                   F.lit(0)).alias("retrain"))


def residuals_by(scored: DataFrame, col: str, resid: str, order: Sequence[str] | None = None) -> DataFrame:
    """ML20 + A22 + O6: residual n / mean / RMSE per level, in a fixed level
    order when given (``rank``), else by n descending."""
    s = residual_stats(scored, [col], resid)
    if order:
        s = s.withColumn("rank", S.category_rank(col, order))
    else:
        s = with_global_index(s, [F.col("n").desc(), F.col(col).asc()], "rank", start=1)
    return s


def feature_shift(scored: DataFrame, flags: Sequence[str], era_col: str = "era",
                  threshold: float = S.SHIFT_THRESHOLD, min_post: int = 5) -> DataFrame:
    """ML21: per flag its train-era and post-era mean, the delta and |delta|
    > threshold, never flagged on fewer than ``min_post`` post-era rows; one
    scan, unpivoted."""
    aggs = [F.count_if(F.col(era_col) == "post").alias("_post")]
    for f in flags:
        x = F.col(f).cast("double")
        aggs += [F.avg(F.when(F.col(era_col) == "train", x)).alias(f"{f}__t"),
                 F.avg(F.when(F.col(era_col) == "post", x)).alias(f"{f}__p")]
    one = scored.agg(*aggs)
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"{f}__t").alias("train_mean"),
                                        F.col(f"{f}__p").alias("post_mean")) for f in flags]))
    out = one.select("_post", each.alias("_f")).select("_post", "_f.*")
    out = out.withColumn("delta", F.col("post_mean") - F.col("train_mean"))
    return out.withColumn("shifted", S.flag_abs("delta", threshold) & (F.col("_post") >= min_post)).drop("_post")


def tier_mix(scored: DataFrame, tier: str, era_col: str = "era") -> DataFrame:
    """ML21 / A26: share (%) of each tier within each era; a tier that an era
    lacks has a row of 0%."""
    cells = group_share(scored, [era_col], [tier], "n").withColumn("pct", F.col("proportion") * 100).drop("proportion")
    level = F.struct(F.col(tier).alias("level"))  # so that a NULL level is in the set
    every = attach_scalar(cells.select(era_col).distinct(), cells.agg(F.collect_set(level).alias("_levels")))
    every = every.select(F.col(era_col).alias("_era"), F.explode("_levels").alias("_l"))
    met = every.join(cells, F.col("_era").eqNullSafe(F.col(era_col)) & F.col("_l.level").eqNullSafe(F.col(tier)), "left")
    return met.select(F.col("_era").alias(era_col), F.col("_l.level").alias(tier), F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.coalesce("pct", F.lit(0.0)).alias("pct"))


def share_over_time(df: DataFrame, date: str, hour: str, month_fmt: str = "yyyy-MM") -> DataFrame:
    """Per month, the share of rows in each quarter of the day."""
    x = df.withColumn("month_year", F.date_format(date, month_fmt)).withColumn("day_quarter", S.day_quarter(hour))
    return group_share(x, ["month_year"], ["day_quarter"], "count")


def regime_view(df: DataFrame, order: Sequence[str], date: str, value: str, klass: str, shift_date: str,
                k: int = 10, min_periods: int = 5, n_blocks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """C11: (series, summary).  ``series`` is every row with its position and
    the rolling mean of value over k rows in date order; ``summary`` has the
    per-class means before / after the shift date and the first position on
    or after it."""
    r = rolling(df, list(order), value, k, min_periods, aggs=("mean",), index="idx", n_blocks=n_blocks)
    after = F.to_date(date) >= F.to_date(F.lit(shift_date))
    r = r.withColumn("regime", F.when(after, F.lit("after")).otherwise(F.lit("before")))
    first = r.filter(after).agg(F.min("idx").alias("shift_index"))
    means = r.groupBy(klass, "regime").agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n"))
    return r, attach_scalar(means, first)
