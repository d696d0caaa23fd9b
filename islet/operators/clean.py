"""Cleaning the raw log (C1) and the projection / filter / set operators it is
made of (P1-P5, P9, P13, P14, P18, X1-X9, X13, X14, U1-U3)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from islet.functions import scalars as S
from islet.operators.joins import attach_scalar
from islet.operators.ordered import forward_fill


def null_filter(df: DataFrame, cols: Sequence[str], keep: str = "not_null") -> DataFrame:
    """X1."""
    cond = None
    for c in cols:
        e = F.col(c).isNotNull() if keep == "not_null" else F.col(c).isNull()
        cond = e if cond is None else cond & e
    return df.filter(cond) if cond is not None else df


def not_in(col, values: Sequence) -> Column:
    """SQL NOT IN; a NULL operand drops the row (three-valued logic)."""
    return ~S._c(col).isin(list(values))


def trim_ne(col, value: str, fold_case: bool = False) -> Column:
    """Inequality on trimmed (optionally lower-cased) text."""
    if fold_case:
        return S.trim_lower(col) != F.lit(value.lower())
    return F.trim(S._c(col)) != F.lit(value)


def drop_incomplete(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with every column present, plus a one-row count of the dropped."""
    any_null = None
    for c in cols:
        e = F.col(c).isNull()
        any_null = e if any_null is None else any_null | e
    kept = df.filter(~any_null)
    dropped = df.agg(F.count_if(any_null).alias("n_dropped"))
    return kept, dropped


def min_group_size(agg: DataFrame, count_col: str, k: int) -> DataFrame:
    """Keep groups with at least k rows."""
    return agg.filter(F.col(count_col) >= k)


def is_empty(df: DataFrame) -> bool:
    """Empty-result guard (reads at most one row)."""
    return df.isEmpty()


def replace_values(df: DataFrame, mapping: Mapping[str, str], subset: Sequence[str]) -> DataFrame:
    """P9."""
    return df.replace(dict(mapping), subset=list(subset))


def ensure_columns(df: DataFrame, cols: Sequence[str], fill=0) -> DataFrame:
    """Add absent feature columns filled with a constant."""
    missing = {c: F.lit(fill) for c in cols if c not in df.columns}
    return df.withColumns(missing) if missing else df


def as_double(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P18."""
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def dedupe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Whole-row DISTINCT, or distinct rows of a column subset."""
    return df.select(*cols).distinct() if cols else df.distinct()


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """U2."""
    return df.select(col).distinct()


def filter_raw_then_rewrite(df: DataFrame, predicate: Column, rewrites: Mapping[str, Column]) -> DataFrame:
    """X9 + P1: the WHERE sees the raw columns, the rewrite comes after."""
    return df.filter(predicate).withColumns(dict(rewrites))


def log_scope_predicate(title="media_title", series="media_series", vtype="video_type",
                        subtype="video_subtype", media="media_type",
                        category="creation_category") -> Column:
    """The log's in-scope rule, on raw values (D6, D8: NULL subtype / media
    type rows fall out through three-valued logic, like the source)."""
    return (F.col(series).isNotNull()
            & F.col(title).isNotNull()
            & not_in(title, S.EXCLUDED_TITLES)
            & F.col(vtype).isNotNull()
            & not_in(subtype, S.EXCLUDED_SUBTYPES)
            & trim_ne(media, S.EXCLUDED_MEDIA_TYPE)
            & not_in(category, S.EXCLUDED_CATEGORIES)
            & F.col(category).isNotNull())


STG_COLUMNS = ["media_title", "video_type", "video_subtype", "creation_category", "date_workflow",
               "time_start", "time_end", "duration", "media_type", "media_series"]


ARRIVAL = ["_src_file", "_src_block", "_src_row"]


def clean_log(raw: DataFrame, seq=None, n_blocks: int | None = None) -> DataFrame:
    """C1 (stg_workload): filter on raw values, canonicalise, 12h -> 24h text,
    forward-fill the date in arrival order (after the filter, so a dropped
    row's date is never carried), repair negative durations, DISTINCT, and
    the md5 surrogate key.  ``seq`` is the arrival order: a column or
    columns; by default ``_seq`` when present, else the scan-time ARRIVAL
    columns of ``read_log``."""
    if seq is None:
        seq = "_seq" if "_seq" in raw.columns else ARRIVAL
    rewritten = filter_raw_then_rewrite(raw, log_scope_predicate(), {
        "media_type": S.canonical_media_type("media_type"),
        "creation_category": S.canonical_category("creation_category"),
        "time_start": S.time_12h_to_24h("time_start"),
        "time_end": S.time_12h_to_24h("time_end"),
    })
    filled = (forward_fill(rewritten, [seq] if isinstance(seq, str) else list(seq), ["date"], n_blocks=n_blocks)
              .withColumnRenamed("date", "date_workflow"))
    fixed = filled.withColumn("duration", S.repair_wrap("duration"))
    return (fixed.select(*STG_COLUMNS).distinct()
            .withColumn("video_id", S.hash_key("media_title", "video_type", "video_subtype")))


def relabel(df: DataFrame, col: str, labels: dict, name: str | None = None) -> DataFrame:
    """Values replaced by their labels; values without one, NULL too, stay."""
    pairs = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv]) if labels else None
    return df.withColumn(name or col, F.coalesce(F.element_at(pairs, F.col(col)), F.col(col)) if labels else F.col(col))


def winsorise(df: DataFrame, col: str, mode: str = "cap", q: float = 0.99,
              threshold: float | None = None, out: str | None = None) -> DataFrame:
    """Keep / remove / cap values above a quantile (or fixed threshold).
    ``remove`` drops values at the threshold too; NULL stays NULL throughout.

    The quantile is exact and distributed (``profile.quantiles``: ranked
    through range blocks, never one task holding all values); the one-row
    threshold is attached as a scalar subquery."""
    out = out or col
    if mode == "keep":
        return df.withColumn(out, F.col(col)) if out != col else df
    if threshold is not None:
        thr = df.sparkSession.range(1).select(F.lit(float(threshold)).alias("_thr"))
    else:
        from islet.operators.profile import quantiles
        thr = quantiles(df, col, [q], names=["_thr"])
    j = attach_scalar(df, thr)
    if mode == "remove":
        return j.filter(F.col(col).isNull() | (F.col(col) < F.col("_thr"))).drop("_thr")
    if mode == "cap":
        return j.withColumn(out, F.when(F.col(col) > F.col("_thr"), F.col("_thr")).otherwise(F.col(col))).drop("_thr")
    raise ValueError(mode)
