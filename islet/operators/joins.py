"""Joins (J1-J10) with size-checked broadcasts.

A side is broadcast only when its size is proven: either it is built with a
fixed bound (one row per block, one row total, top-k), or a look at no more
than n + 1 rows shows their number and bytes.  Otherwise the
join is left to Spark (sort-merge, or AQE's runtime broadcast when the
shuffle statistics show it is small).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# a dimension is broadcast only below both bounds
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 256 * 1024 * 1024

# bytes of fixed-width types; other values are measured
_WIDTH = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "date": 4, "float": 4,
          "bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8}


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: 16, the fixed-width types at their size, and the real
    length of strings and binaries (decimals and nested values as JSON)."""
    out = F.lit(16 + sum(_WIDTH.get(t, 0) for _, t in df.dtypes)).cast("long")
    for c, t in df.dtypes:
        if t not in _WIDTH:
            x = F.col(f"`{c}`") if t in ("string", "binary") else F.to_json(F.struct(F.col(f"`{c}`")))
            out = out + F.lit(16) + F.coalesce(F.octet_length(x), F.lit(0))
    return out


def is_small(df: DataFrame, max_rows: int, max_bytes: int) -> bool:
    """True when df has at most ``max_rows`` rows of ``max_bytes`` in all;
    reads at most max_rows + 1 rows, of which only the sizes leave their tasks."""
    r = df.select(row_bytes(df).alias("b")).limit(max_rows + 1).agg(F.count("b"), F.sum("b")).first()
    return r[0] <= max_rows and (r[1] or 0) <= max_bytes


def small_side(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
               max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast-hint a stored dimension only when its size is proven small:
    at most ``max_rows`` rows and at most ``max_bytes`` by the real length of
    its values.  Use it on stored tables (the check reads at most n + 1
    rows), not on derived frames, whose lineage the look would run again."""
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def attach_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame to every row as an
    uncorrelated scalar subquery (computed once, no join at all; more than
    one row is an error, none gives NULLs)."""
    cols = one_row.columns
    sub = one_row.select(F.struct(*cols).alias("_s")).scalar()
    return (df.withColumn("_s", sub)
            .select("*", *[F.col(f"_s.{c}").alias(c) for c in cols]).drop("_s"))


def label_join(facts: DataFrame, labels: DataFrame, keys: Sequence[str],
               max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Facts LEFT JOIN labels on the natural key."""
    return facts.join(small_side(labels, max_rows), list(keys), "left")


def pending_join(labels: DataFrame, facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Labels LEFT JOIN facts (keeps labels with no facts).  The facts
    side is derived (not a stored dimension), so its size is not pre-counted
    (that would run its whole lineage twice); AQE broadcasts it at runtime
    when the shuffle statistics show it is small."""
    return labels.join(facts, list(keys), "left")


def semi(df: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key appears in keys_df (IN (SELECT ...))."""
    return df.join(keys_df.select(*keys), list(keys), "left_semi")


def anti(df: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not appear in keys_df."""
    return df.join(keys_df.select(*keys), list(keys), "left_anti")


def rows_of_groups(df: DataFrame, groups: DataFrame, keys: Sequence[str],
                   max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Rows of the selected groups; the group list is broadcast only
    when its size is proven small (a top-k always is)."""
    return df.join(small_side(groups, max_rows), list(keys))


def lookup_mean(test: DataFrame, train: DataFrame, key: str, value: str, name: str = "pred") -> DataFrame:
    """J8 / ML2: the train-set mean of ``value`` per ``key`` mapped onto the
    test rows; an unseen key gives NULL."""
    means = train.groupBy(key).agg(F.avg(value).alias(name))
    return test.join(means, key, "left")


def add_columns(df: DataFrame, exprs: dict) -> DataFrame:
    """Column-wise concatenation, by name, never by position."""
    return df.withColumns(exprs)
