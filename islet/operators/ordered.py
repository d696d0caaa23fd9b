"""Operators over one global row order.

A window with no PARTITION BY moves every row into one task.  Every operator
here instead cuts the order into contiguous *blocks*:

1. ``repartitionByRange(n, *order)`` + ``sortWithinPartitions`` — Spark
   samples the keys, range-partitions them (binary search per row) and sorts
   each partition.  The explicit partition count means AQE never coalesces
   this exchange, so ``spark_partition_id()`` is the block number and
   ``monotonically_increasing_id()`` gives the row's position inside it.
   The blocked rows are checkpointed once (see ``range_blocks``) so every
   later reader sees the same cut.
2. A per-block summary (one row per block: count, last value, ...) is built
   with a partial aggregate, so it is tiny and its size is bounded by the
   block count.  Prefix sums / carries over it run on that tiny table.
3. The summary is broadcast back (one row per block of about
   BLOCK_TARGET_ROWS rows) and combined
   with a window partitioned by block.  The block table is bucketed by
   block, so that window needs no shuffle of its own.

The result equals the single-partition window exactly; tests compare both.
The order columns must identify rows uniquely (add a tie-break key) so the
result is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from islet.operators.joins import BROADCAST_MAX_ROWS, small_side
from islet.session import scratch_table

BLK = "_blk"
POS = "_pos"
BKT = "_bkt"  # bucket key of a block: hashes to that block's bucket


def _cols(order) -> list:
    return [order] if isinstance(order, (str, Column)) else list(order)


def sort_keys(order) -> list:
    """Column names -> ascending NULLS LAST (the order DuckDB and pandas use,
    and so the source's); Column sort expressions are kept as given."""
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in _cols(order)]


BLOCK_TARGET_ROWS = 2_000_000


def default_blocks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def resolve_blocks(df: DataFrame, n_blocks) -> int:
    """``None`` or ``"auto"`` -> one count of the input, about BLOCK_TARGET_ROWS rows per
    block (a block is windowed by one task, so this bounds the work and
    buffer of a task) and at least spark.sql.shuffle.partitions blocks; an
    int is used as given."""
    if n_blocks in (None, "auto"):
        return max(default_blocks(df), -(-df.count() // BLOCK_TARGET_ROWS))
    return int(n_blocks)


def range_blocks(df: DataFrame, order, n_blocks: int | None = None) -> DataFrame:
    """Add ``_blk`` (block number, increasing with the order) and ``_pos``
    (0-based position inside the block)."""
    order = sort_keys(order)
    n = resolve_blocks(df, n_blocks)
    if n < 1:
        raise ValueError("n_blocks must be at least 1")
    spark = df.sparkSession
    buckets = min(n, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000")))
    b = (df.repartitionByRange(n, *order)
         .sortWithinPartitions(*order)
         .withColumn(BLK, F.spark_partition_id())
         .withColumn(POS, F.monotonically_increasing_id() - F.shiftleft(F.col(BLK).cast("long"), 33)))
    b = (b.withColumn("_slot", F.col(BLK) % F.lit(buckets))
         .join(F.broadcast(bucket_keys(spark, buckets).withColumnRenamed(BLK, "_slot")), "_slot", "left")
         .withColumn(BKT, F.coalesce(F.col(BKT), F.col("_slot").cast("long"))).drop("_slot"))
    # Every operator reads the blocks twice (per-block summary + rows).  Spark
    # samples range bounds per exchange instance, so two exchanges could cut
    # different blocks.  The blocked rows are written once as a table in the
    # shared checkpoint folder (spark.checkpoint.dir): every reader sees the
    # same cut, the lineage is cut (survives executor loss), and readers get
    # parquet column pruning.  The table is bucketed on the blocks' bucket
    # keys, one block per bucket, so a scan of it is already partitioned by
    # block: the per-block windows that follow need no further shuffle.
    # Beyond Spark's bucket limit the blocks go round the buckets.
    name, path = scratch_table(spark, "blocks")
    b.write.mode("overwrite").format("parquet").bucketBy(buckets, BKT).option("path", path).saveAsTable(name)
    return spark.table(name)


_BUCKET_KEYS: dict[int, list] = {}


def bucket_keys(spark, n: int) -> DataFrame:
    """(_blk, _bkt) for blocks 0..n-1: the smallest integer whose bucket under
    n-way hash bucketing is exactly that block.  Found once per n by one
    small job over n * (ln n + 20) candidates (a bucket is then missed with
    probability below e^-20; a missed one falls back to the block number),
    kept as an n-row list (at most Spark's bucket limit) and reused as a
    local relation."""
    if n not in _BUCKET_KEYS:
        import math
        c = int(n * (math.log(n + 1) + 20)) + 64
        found = (spark.range(0, c)
                 .select(F.pmod(F.hash(F.col("id")), F.lit(n)).cast("int").alias(BLK), F.col("id").alias(BKT))
                 .groupBy(BLK).agg(F.min(BKT).alias(BKT)).collect())
        _BUCKET_KEYS[n] = sorted((int(r[0]), int(r[1])) for r in found)
    return spark.createDataFrame(_BUCKET_KEYS[n], f"{BLK} int, {BKT} long")


def _block_offsets(blocked: DataFrame) -> DataFrame:
    """(blk, cnt, offset): rows before each non-empty block."""
    counts = blocked.groupBy(BKT, BLK).agg(F.count(F.lit(1)).alias("_cnt")).drop(BKT)
    w = Window.orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).cast("long"))


def with_global_index(df: DataFrame, order, name: str = "idx", start: int = 0,
                      n_blocks: int | None = None) -> DataFrame:
    """0-based (or ``start``-based) position in the global order."""
    blocked = range_blocks(df, order, n_blocks)
    offs = F.broadcast(_block_offsets(blocked).select(BLK, "_off"))
    return (blocked.join(offs, BLK, "left")
            .withColumn(name, F.col("_off") + F.col(POS) + F.lit(start))
            .drop(BLK, POS, BKT, "_off"))


def forward_fill(df: DataFrame, order, cols, n_blocks: int | None = None,
                 suffix: str | None = None) -> DataFrame:
    """LAST_VALUE(x IGNORE NULLS) over rows unbounded preceding, per column.

    Leading NULLs stay NULL.  ``suffix`` writes ``x + suffix`` instead of
    replacing ``x``.
    """
    order = _cols(order)
    cols = _cols(cols)
    blocked = range_blocks(df, order, n_blocks)
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(POS))).alias(f"_last_{c}") for c in cols]
    summ = blocked.groupBy(BKT, BLK).agg(*aggs).drop(BKT)
    wt = Window.orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    carry = summ.select(BLK, *[F.last(f"_last_{c}", ignorenulls=True).over(wt).alias(f"_carry_{c}")
                              for c in cols])
    out = blocked.join(F.broadcast(carry), BLK, "left")
    wb = Window.partitionBy(BKT, BLK).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    for c in cols:
        target = c + suffix if suffix else c
        out = out.withColumn(target, F.coalesce(F.last(F.col(c), ignorenulls=True).over(wb),
                                                F.col(f"_carry_{c}")))
    return out.drop(BLK, POS, BKT, *[f"_carry_{c}" for c in cols])


def lag_in_order(df: DataFrame, order, col: str, name: str | None = None,
                 n_blocks: int | None = None) -> DataFrame:
    """LAG(col) over the global order (NULL for the first row)."""
    order = _cols(order)
    name = name or f"prev_{col}"
    blocked = range_blocks(df, order, n_blocks)
    summ = blocked.groupBy(BKT, BLK).agg(F.max_by(F.col(col), F.col(POS)).alias("_lastv")).drop(BKT)
    carry = summ.select(BLK, F.lag("_lastv").over(Window.orderBy(BLK)).alias("_carry"))
    wb = Window.partitionBy(BKT, BLK).orderBy(POS)
    return (blocked.join(F.broadcast(carry), BLK, "left")
            .withColumn(name, F.when(F.col(POS) == 0, F.col("_carry")).otherwise(F.lag(col).over(wb)))
            .drop(BLK, POS, BKT, "_carry"))


def rolling(df: DataFrame, order, col: str, k: int, min_periods: int | None = None,
            aggs: Sequence[str] = ("mean",), prefix: str = "rolling_",
            n_blocks: int | None = None, index: str | None = None) -> DataFrame:
    """Rolling aggregate over the last ``k`` rows with pandas'
    ``min_periods`` (NULL until that many non-NULL values are in the frame).

    ``aggs`` takes ``mean``, ``rmse`` (sqrt of mean square), ``sum``, ``count``.
    All are built from three decomposable sums (sum, non-NULL count, sum of
    squares): a window inside each block (reading the bucketed block table,
    no shuffle) plus, for the first k-1 rows of a block, the part of the
    frame that lies in earlier blocks.  Each of the k-1 rows before a block
    is sent there once; running sums over them, the nearest first, are what
    the block's first rows lack.  These are at most n_blocks * (k - 1) rows,
    broadcast back while that is below ``BROADCAST_MAX_ROWS`` and joined
    by Spark's choice beyond it.
    """
    m = k if min_periods is None else min_periods
    n = resolve_blocks(df, n_blocks)
    blocked = range_blocks(df, order, n)
    offs = _block_offsets(blocked)
    x = F.col(col).cast("double")
    w = Window.partitionBy(BKT, BLK).orderBy(POS).rowsBetween(-(k - 1), 0)
    out = blocked.select("*", F.sum(x).over(w).alias("_s"), F.count(x).over(w).alias("_c"),
                         F.sum(x * x).over(w).alias("_q"))
    if k > 1:
        # blocks whose start lies at most k-1 rows after a row of this one:
        # the next, and those after it if the ones between are short
        by_end = Window.orderBy("_end")
        ends = offs.withColumn("_end", F.col("_off") + F.col("_cnt")).withColumn("_next", F.lead(BLK).over(by_end))
        to = F.collect_list(F.struct(F.col("_next").alias("_tb"), F.col("_end").alias("_toff")))
        ends = ends.withColumn("_to", to.over(by_end.rangeBetween(0, k - 2)))
        tail = (blocked.join(F.broadcast(ends), BLK)
                .filter(F.col(POS) >= F.col("_cnt") - F.lit(k - 1))
                .select((F.col("_off") + F.col(POS)).alias("_hi"), x.alias("_hx"), F.explode("_to").alias("_t"))
                .select("_hi", "_hx", "_t.*").withColumn("_d", F.col("_toff") - F.col("_hi"))
                .filter((F.col("_d") < k) & F.col("_tb").isNotNull()))
        near = Window.partitionBy("_tb").orderBy("_d").rowsBetween(Window.unboundedPreceding, 0)
        # the frame at position p reaches k-1-p rows before the block, or up
        # to the first row of all
        last = F.lit(k - 1) - F.col("_d")
        extra = tail.select("_tb", F.sum("_hx").over(near).alias("_es"), F.count("_hx").over(near).alias("_ec"),
                            F.sum(F.col("_hx") * F.col("_hx")).over(near).alias("_eq"),
                            F.explode(F.sequence(F.when(F.col("_hi") == 0, F.lit(0).cast("long")).otherwise(last), last)).alias("_p"))
        if n * (k - 1) <= BROADCAST_MAX_ROWS:
            extra = F.broadcast(extra)
        out = (out.join(extra, (F.col(BLK) == F.col("_tb")) & (F.col(POS) == F.col("_p")), "left")
               .withColumn("_s", F.when(F.col("_ec") > 0, F.coalesce(F.col("_s"), F.lit(0.0)) + F.col("_es"))
                           .otherwise(F.col("_s")))
               .withColumn("_c", F.col("_c") + F.coalesce(F.col("_ec"), F.lit(0)))
               .withColumn("_q", F.when(F.col("_ec") > 0, F.coalesce(F.col("_q"), F.lit(0.0)) + F.col("_eq"))
                           .otherwise(F.col("_q")))
               .drop("_tb", "_p", "_es", "_ec", "_eq"))
    enough = F.col("_c") >= F.lit(m)
    exprs = {"mean": F.col("_s") / F.col("_c"), "rmse": F.sqrt(F.col("_q") / F.col("_c")),
             "sum": F.col("_s"), "count": F.col("_c")}
    for a in aggs:
        if a not in exprs:
            raise ValueError(a)
        out = out.withColumn(prefix + a, F.when(enough, exprs[a]))
    if index:
        out = (out.join(F.broadcast(offs.select(BLK, "_off")), BLK, "left")
               .withColumn(index, F.col("_off") + F.col(POS)).drop("_off"))
    return out.drop(BLK, POS, BKT, "_s", "_c", "_q")


def order_violations(df: DataFrame, order, col: str, n_blocks: int | None = None,
                     index: str = "rn") -> DataFrame:
    """Rows whose ``col`` is smaller than the previous row's, in the
    given (arrival) order, NULLs of ``col`` removed first.  One block table
    gives both the 1-based row number and the previous value."""
    order = _cols(order)
    names = [c for c in order if isinstance(c, str)]
    base = df.select(*names, col).filter(F.col(col).isNotNull())
    b = range_blocks(base, order, n_blocks)
    offs = _block_offsets(b).select(BLK, "_off")
    last = b.groupBy(BKT, BLK).agg(F.max_by(F.col(col), F.col(POS)).alias("_lastv")).drop(BKT)
    carry = last.select(BLK, F.lag("_lastv").over(Window.orderBy(BLK)).alias("_carry"))
    wb = Window.partitionBy(BKT, BLK).orderBy(POS)
    prev = f"prev_{col}"
    out = (b.join(F.broadcast(offs), BLK).join(F.broadcast(carry), BLK, "left")
           .withColumn(index, F.col("_off") + F.col(POS) + F.lit(1))
           .withColumn(prev, F.when(F.col(POS) == 0, F.col("_carry")).otherwise(F.lag(col).over(wb))))
    return out.filter(F.col(col) < F.col(prev)).select(index, prev, col)


def context_rows(df: DataFrame, order, hit: Column, before: int = 1, after: int = 1,
                 index: str = "rn", n_blocks: int | None = None) -> DataFrame:
    """Every row within ``before``/``after`` positions of a
    row matching ``hit``, in the given order, each row once.

    The offsets are exploded from the (small) hit set and semi-joined back; no
    cross join is planned."""
    idx = with_global_index(df, order, index, start=1, n_blocks=n_blocks)
    offsets = F.array(*[F.lit(d) for d in range(-before, after + 1)])
    wanted = (idx.filter(hit).select(F.col(index), F.explode(offsets).alias("_d"))
              .select((F.col(index) + F.col("_d")).alias(index)).distinct())
    # the wanted positions are (before + after + 1) x hits: broadcast when
    # proven small, so the rows are only streamed past them
    return idx.join(small_side(wanted), index, "left_semi")


def head_tail(df: DataFrame, order, n: int, tail: bool = False) -> DataFrame:
    """O3: first / last n rows in the order.  Planned as
    TakeOrderedAndProject: every task keeps only its own n best rows, so
    nothing but n rows per task reaches the final merge."""
    keys = sort_keys(order)
    if tail:
        keys = [F.col(c).desc_nulls_first() if isinstance(c, str) else c for c in _cols(order)]
    return df.orderBy(*keys).limit(n)
