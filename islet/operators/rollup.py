"""Entity roll-up (C3) and the conditional aggregates it uses.

Counting distinct days per phase four times would plan an Expand (one copy
of every row per distinct aggregate).  Instead the roll-up is two ordinary
aggregates: (entity, day) first, then entity.  Both get a partial
(map-side) aggregate, so a hot entity never ships its raw rows: the second
shuffle carries at most one row per entity-day.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from islet.functions import scalars as S


def snake(label: str) -> str:
    return label.lower().replace("-", "_").replace(" ", "_")


def cond_sum(value, pred: Column) -> Column:
    """A4: SUM(CASE WHEN pred THEN value ELSE 0 END)."""
    return F.sum(F.when(pred, S._c(value)).otherwise(F.lit(0)))


def cond_min(value, pred: Column) -> Column:
    """A5."""
    return F.min(F.when(pred, S._c(value)))


def cond_max(value, pred: Column) -> Column:
    """A5."""
    return F.max(F.when(pred, S._c(value)))


def count_where(pred: Column) -> Column:
    """COUNT(*) FILTER (WHERE pred)."""
    return F.count_if(pred)


def n_unique(df: DataFrame, keys: Sequence[str], col: str, name: str = "n_unique") -> DataFrame:
    """Distinct count per group, as two plain aggregates (no Expand)."""
    return (df.select(*keys, col).filter(F.col(col).isNotNull()).distinct()
            .groupBy(*keys).agg(F.count(F.lit(1)).alias(name)))


def entity_rollup(sessions: DataFrame, key: str = "video_id", category: str = "creation_category",
                  date: str = "date_workflow", duration: str = "duration",
                  descriptive: Sequence[str] = ("media_title", "video_type", "video_subtype",
                                                "media_type", "media_series"),
                  phases: Mapping[str, Sequence[str]] = S.PHASES, phase_default: str = S.PHASE_DEFAULT,
                  categories: Sequence[str] = S.ROLLUP_CATEGORIES,
                  creation_phases: Sequence[str] = S.CREATION_PHASES,
                  span_phases: Sequence[str] | None = None, digits: int = 2) -> DataFrame:
    """C3 (dim_videos): one row per entity with total / creation / category /
    phase hours, first and last dates, inclusive spans and active days."""
    phase_labels = list(phases) + [phase_default]
    span_phases = list(phases) if span_phases is None else list(span_phases)
    ph = S.phase_of(category, phases, phase_default)
    x = sessions.withColumn("_ph", ph)

    # level 1: entity x day
    l1 = [F.min(c).alias(c) for c in descriptive]
    l1.append(F.sum(duration).alias("_d"))
    l1.append(cond_sum(duration, F.col("_ph").isin(list(creation_phases))).alias("_dc"))
    l1.append(count_where(F.col("_ph").isin(list(creation_phases))).alias("_nc"))
    for c in categories:
        l1.append(cond_sum(duration, F.col(category) == F.lit(c)).alias(f"_c_{snake(c)}"))
    for p in phase_labels:
        l1.append(cond_sum(duration, F.col("_ph") == F.lit(p)).alias(f"_p_{snake(p)}"))
        l1.append(count_where(F.col("_ph") == F.lit(p)).alias(f"_n_{snake(p)}"))
    day = x.groupBy(key, date).agg(*l1)

    # level 2: entity
    d = F.col(date)
    l2 = [F.min(c).alias(c) for c in descriptive]
    l2 += [S.hours(F.sum("_d"), digits).alias("total_hours"),
           F.min(d).alias("date_first"), F.max(d).alias("date_last"),
           F.count(d).alias("active_days_worked"),
           S.hours(F.sum("_dc"), digits).alias("hours_creation"),
           cond_min(d, F.col("_nc") > 0).alias("_cf"), cond_max(d, F.col("_nc") > 0).alias("_cl")]
    for c in categories:
        l2.append(S.hours(F.sum(f"_c_{snake(c)}"), digits).alias(f"hours_{snake(c)}"))
    for p in phase_labels:
        l2.append(S.hours(F.sum(f"_p_{snake(p)}"), digits).alias(f"hours_{snake(p)}"))
    for p in span_phases:
        has = F.col(f"_n_{snake(p)}") > 0
        l2 += [cond_min(d, has).alias(f"{snake(p)}_date_first"),
               cond_max(d, has).alias(f"{snake(p)}_date_last"),
               count_where(has & d.isNotNull()).alias(f"{snake(p)}_active_days")]
    out = day.groupBy(key).agg(*l2)
    out = out.withColumn("total_day_span", S.day_span("date_first", "date_last"))
    out = out.withColumn("creation_day_span", S.day_span("_cf", "_cl"))
    for p in span_phases:
        out = out.withColumn(f"{snake(p)}_total_day_span",
                             S.day_span(f"{snake(p)}_date_first", f"{snake(p)}_date_last"))
    cols = [key, *descriptive, "total_hours", "date_first", "date_last", "total_day_span",
            "active_days_worked", "hours_creation", "creation_day_span"]
    cols += [f"hours_{snake(c)}" for c in categories] + [f"hours_{snake(p)}" for p in phase_labels]
    for p in span_phases:
        cols += [f"{snake(p)}_date_first", f"{snake(p)}_date_last", f"{snake(p)}_total_day_span",
                 f"{snake(p)}_active_days"]
    return out.select(*cols)
