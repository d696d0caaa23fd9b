"""Feature and pending tables (C4, C5) and encoders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from islet.functions import scalars as S
from islet.operators.joins import BROADCAST_MAX_ROWS, label_join, pending_join
from islet.operators.profile import check_accepted, check_not_null, check_unique, run_checks

NATURAL_KEY = ["media_title", "video_type", "video_subtype"]
LABEL_COLUMNS = ["expected_length_mins", "complexity_new", "complexity_media_depth",
                 "complexity_delivery_style", "complexity_logistics", "complexity_worklife", "is_complete"]
FLAG_COLUMNS = ["complexity_new", "complexity_media_depth", "complexity_delivery_style"]


def with_tiers(df: DataFrame, length: str = "expected_length_mins") -> DataFrame:
    """P7 + P8."""
    return df.withColumns({"length_tier": S.length_tier(length), "length_tier_ord": S.length_tier_ord(length)})


def require_unique(labels: DataFrame, keys: Sequence[str]) -> None:
    """Q4: the natural key must be unique before it is joined (a duplicate
    would fan out the join).  One aggregate; raises on a duplicate."""
    dup = labels.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    if not dup.isEmpty():
        raise ValueError(f"duplicate natural key in labels: {dup.drop('_n').first().asDict()}")


def seed_checks(labels: DataFrame, done: str = "is_complete", flags: Sequence[str] = (
        "complexity_new", "complexity_media_depth", "complexity_delivery_style", "complexity_logistics",
        "complexity_worklife"), keys: Sequence[str] = NATURAL_KEY,
        lengths: Sequence[int] = (7, 10, 15, 20, 25, 30)) -> DataFrame:
    """Q1-Q4 on the label seed: key columns and the done flag not NULL; each
    flag not NULL where done = 1 and in {0, 1}; lengths from the accepted
    set; natural key unique.  One row per check with its failure count."""
    checks = [check_not_null(labels, c) for c in [*keys, done]]
    checks += [check_accepted(labels, done, [0, 1]), check_accepted(labels, "expected_length_mins", list(lengths))]
    for f in flags:
        checks += [check_not_null(labels, f, where=F.col(done) == 1), check_accepted(labels, f, [0, 1])]
    checks.append(check_unique(labels, list(keys)))
    return run_checks(checks)


def feature_table(entities: DataFrame, labels: DataFrame, keys: Sequence[str] = NATURAL_KEY,
                  label_cols: Sequence[str] = LABEL_COLUMNS, length: str = "expected_length_mins",
                  max_rows: int = BROADCAST_MAX_ROWS, validate_keys: bool = True) -> DataFrame:
    """C4 (dim_videos_ml): entities LEFT JOIN labels on the natural key, plus
    tiers.  The labels' key is checked unique first (SURVEY §1.4)."""
    if validate_keys:
        require_unique(labels, keys)
    lab = labels.select(*keys, *label_cols)
    return with_tiers(label_join(entities, lab, keys, max_rows), length)


def pending_table(labels: DataFrame, entities: DataFrame, keys: Sequence[str] = NATURAL_KEY,
                  carry: Sequence[str] = ("media_type", "date_first"), done: str = "is_complete",
                  length: str = "expected_length_mins", id_col: str = "video_id",
                  max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """C5 (fct_videos_pending): planned labels (done = 0) with entity facts
    when they exist; the surrogate key is recomputed from the natural key."""
    planned = labels.filter(F.col(done) == 0)
    facts = entities.select(*keys, *carry)
    j = pending_join(planned, facts, keys)
    rest = [c for c in planned.columns if c not in keys and c != done and c != length]
    return (with_tiers(j, length)
            .withColumn(id_col, S.hash_key(*keys))
            .select(id_col, *keys, *carry, length, "length_tier", "length_tier_ord", *rest))


def one_hot(train: DataFrame, df: DataFrame, col: str, prefix: str | None = None,
            drop_first: bool = True, reference: str | None = None) -> tuple[DataFrame, list[str]]:
    """Dummies from the levels seen in ``train``, sorted.  The level
    left out is ``reference``, or else the first.  A level absent from train
    gets no column, so its rows score as the reference level.  The level
    list, as long as the result is wide, comes to the driver."""
    prefix = prefix or col
    levels = [r[0] for r in train.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col).collect()]
    if reference is not None:
        if reference not in levels:
            raise ValueError(f"{col} has no level {reference}")
        kept = [lv for lv in levels if lv != reference]
    else:
        kept = levels[1:] if drop_first else levels
    names = [f"{prefix}_{lv}" for lv in kept]
    out = df.withColumns({n: F.when(F.col(col) == F.lit(lv), 1).otherwise(0) for n, lv in zip(names, kept)})
    return out, names
