"""Gap sessionisation ("islands") and what is built on it: C2, C2b, C2c, C6,
C7, W3, W4.

Semantics: within a key, rows ordered by start (then a tie-break); a row opens
a new island when it is the key's first row or when the minute-boundary gap
from the *previous row's* end (not the running maximum end) to its start is
above ``gap``.  Overlaps give negative gaps and merge.

Scale: partitioning the window by key alone puts a hot key (say a third of
all rows) into one task.  Rows are range-partitioned on ``(keys, start,
tie)`` into balanced blocks instead, so a hot key spans many blocks and a
block may hold many small keys.  One carry over one-row-per-block summaries
(broadcast) fixes the block edges: the previous row's end tells whether a
block's first row opens an island when its key goes on, and so how many
islands that key opened in earlier blocks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from islet.functions.scalars import minute_boundaries, plus_minutes
from islet.operators.ordered import BKT, BLK, POS, range_blocks, sort_keys


def _list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def with_islands(df: DataFrame, keys, start: str, end: str | None = None,
                 duration: str | None = None, gap: int = 15, tie=None,
                 island: str = "island_id", gap_col: str = "gap_from_prev_minutes",
                 end_col: str = "ts_end_computed", n_blocks: int | None = None) -> DataFrame:
    """Every row with its gap from the previous row of the same
    key and its 1-based island number within the key.

    Rows always go through balanced range blocks, however the keys are
    spread (``n_blocks`` as in ``ordered.resolve_blocks``)."""
    keys, tie = _list(keys), _list(tie)
    if end is None:
        if duration is None:
            raise ValueError("give end or duration")
        df = df.withColumn(end_col, plus_minutes(start, duration))
        end = end_col
    order = keys + [start] + tie
    b = range_blocks(df, order, n_blocks)
    kk = F.struct(*[F.col(k) for k in keys])

    # in a block: its rows are sorted by key, so islands of a key are counted
    # from the key's first row by running sums over one sort
    wb = Window.partitionBy(BKT, BLK).orderBy(POS)
    upto = wb.rowsBetween(Window.unboundedPreceding, 0)
    same = kk.eqNullSafe(F.lag(kk).over(wb))
    rows = b.withColumn("_same", same).withColumn(gap_col, minute_boundaries(F.when(same, F.lag(F.col(end)).over(wb)), F.col(start)))
    # whether a block's first row opens an island is left to the carry
    rows = rows.withColumn("_new", F.when(F.col(POS) == 0, 0).when(_opens(F.col(gap_col), gap), 1).otherwise(0))
    rows = rows.withColumn("_run", F.sum("_new").over(upto))
    rows = rows.withColumn("_local", F.col("_run") - F.max(F.when((F.col(POS) == 0) | ~F.col("_same"), F.col("_run") - F.col("_new"))).over(upto))

    # the carry: one row a block tells its first key and start, its last key
    # and end, and the islands its last key opened after the block's first row
    edges = rows.groupBy(BKT, BLK).agg(
        F.min_by(F.struct(kk.alias("k"), F.col(start).alias("s")), F.col(POS)).alias("_first"),
        F.max_by(F.struct(kk.alias("k"), F.col(end).alias("e"), F.col("_local").alias("n")), F.col(POS)).alias("_last")).drop(BKT)
    wt = Window.orderBy(BLK)
    goes_on = F.col("_first.k").eqNullSafe(F.col("_prev.k"))
    edges = edges.withColumn("_prev", F.lag("_last").over(wt)).withColumn("_on", F.coalesce(goes_on, F.lit(False)))
    edges = edges.withColumn("_gap", minute_boundaries(F.when(F.col("_on"), F.col("_prev.e")), F.col("_first.s")))
    edges = edges.withColumn("_opens", F.when(_opens(F.col("_gap"), gap), 1).otherwise(0))
    # islands of the last key up to the block's end; blocks with the same last
    # key are neighbours, so the count restarts where that key changes
    edges = edges.withColumn("_n", F.col("_last.n") + F.when(F.col("_first.k").eqNullSafe(F.col("_last.k")), F.col("_opens")).otherwise(0))
    edges = edges.withColumn("_sum", F.sum("_n").over(wt.rowsBetween(Window.unboundedPreceding, 0)))
    restart = F.when(~F.col("_last.k").eqNullSafe(F.col("_prev.k")), F.col("_sum") - F.col("_n"))
    edges = edges.withColumn("_cum", F.col("_sum") - F.max(restart).over(wt.rowsBetween(Window.unboundedPreceding, 0)))
    carry = edges.select(BLK, F.col("_first.k").alias("_k"), F.col("_gap").alias("_first_gap"),
                         (F.col("_opens") + F.when(F.col("_on"), F.lag("_cum").over(wt)).otherwise(0)).alias("_before"))

    rows = rows.join(F.broadcast(carry), BLK, "left")
    rows = rows.withColumn(gap_col, F.when(F.col(POS) == 0, F.col("_first_gap")).otherwise(F.col(gap_col)))
    rows = rows.withColumn(island, (F.col("_local") + F.when(kk.eqNullSafe(F.col("_k")), F.col("_before")).otherwise(0)).cast("long"))
    return rows.drop(BLK, POS, BKT, "_same", "_new", "_run", "_local", "_k", "_first_gap", "_before")


def _opens(gap_col, gap: int):
    """Whether a row opens an island: without a gap from the same key's row
    before, or with a larger one."""
    return gap_col.isNull() | (gap_col > F.lit(gap))


def collapse(islands: DataFrame, keys, island: str = "island_id",
             count_name: str = "sessions_combined",
             mins: Sequence[str] = (), maxs: Sequence[str] = (), sums: Sequence[str] = (),
             renames: Mapping[str, str] | None = None) -> DataFrame:
    """One row per island.  ``min`` serves as the deterministic
    "any value" for columns that are constant within the group."""
    keys = _list(keys)
    renames = dict(renames or {})
    aggs = [F.count(F.lit(1)).alias(count_name)]
    aggs += [F.min(c).alias(renames.get(c, c)) for c in mins]
    aggs += [F.max(c).alias(renames.get("max:" + c, renames.get(c, c))) for c in maxs]
    aggs += [F.sum(c).alias(renames.get("sum:" + c, renames.get(c, c))) for c in sums]
    return islands.groupBy(*keys, island).agg(*aggs)


def sessionize(df: DataFrame, keys, start: str, duration: str, gap: int = 15, tie=None,
               date: str | None = None, time_start: str | None = None, time_end: str | None = None,
               carry: Sequence[str] = (), end: str = "max_end", island: str = "session_id",
               n_blocks: int | None = None) -> DataFrame:
    """The log's combined sessions.

    ``end="max_end"`` keeps MAX(time_end) (the view); ``"last_start"`` keeps
    MAX(time_start) (the exploratory variant).  Text times are aggregated as
    text, exactly like the source (SURVEY H9); ``ts_start``/``ts_end`` are
    given alongside.
    """
    isl = with_islands(df, keys, start, duration=duration, gap=gap, tie=tie, island=island,
                       n_blocks=n_blocks)
    aggs = [F.count(F.lit(1)).alias("sessions_combined")]
    if date:
        aggs.append(F.min(date).alias(date))
    aggs += [F.min(c).alias(c) for c in carry]
    if time_start:
        aggs.append(F.min(time_start).alias(time_start))
    if time_end:
        src = time_start if end == "last_start" else time_end
        aggs.append(F.max(src).alias(time_end))
    aggs += [F.sum(duration).alias(duration),
             F.min(start).alias("ts_start"), F.max("ts_end_computed").alias("ts_end")]
    return isl.groupBy(*_list(keys), island).agg(*aggs)


def island_size_hist(islands: DataFrame, keys, island: str = "island_id") -> DataFrame:
    """How many islands have n rows, and their share of rows.

    The denominator is the sum of the histogram itself (= all rows), taken
    over the tiny histogram, so no scalar subquery or cross join is needed."""
    sizes = islands.groupBy(*_list(keys), island).agg(F.count(F.lit(1)).alias("sessions_combined"))
    hist = sizes.groupBy("sessions_combined").agg(
        F.count(F.lit(1)).alias("num_groups"),
        F.sum("sessions_combined").alias("total_raw_sessions"))
    total = F.sum("total_raw_sessions").over(Window.partitionBy(F.lit(0)))
    return hist.withColumn("pct_of_total_sessions",
                           F.round(F.col("total_raw_sessions") * F.lit(100.0) / total, 2))


def topk_islands_rows(islands: DataFrame, keys, k: int = 10, island: str = "island_id",
                      min_size: int = 2) -> DataFrame:
    """The k largest islands (size >= min_size, ties broken
    by key then island number) with all their member rows."""
    keys = _list(keys)
    sizes = (islands.groupBy(*keys, island).agg(F.count(F.lit(1)).alias("sessions_combined"))
             .filter(F.col("sessions_combined") >= min_size))
    top = sizes.orderBy(F.col("sessions_combined").desc(), *[F.col(c).asc() for c in keys],
                        F.col(island).asc()).limit(k)
    return islands.join(F.broadcast(top), keys + [island])
