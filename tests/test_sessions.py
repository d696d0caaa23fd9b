"""Blocked gap-islands equal the plain per-key window; FIXTURES edge cases."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from islet.functions.scalars import minute_boundaries, plus_minutes
from islet.operators import sessions as S
from islet.operators.ordered import range_blocks
from tests.conftest import SF


def _plain(df, keys, start, dur, gap, tie):
    w = Window.partitionBy(*keys).orderBy(start, *tie)
    x = df.withColumn("_e", plus_minutes(start, dur))
    x = x.withColumn("g", minute_boundaries(F.lag("_e").over(w), F.col(start)))
    x = x.withColumn("n", F.when(F.col("g").isNull() | (F.col("g") > gap), 1).otherwise(0))
    return x.withColumn("isl", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)))


@pytest.fixture(scope="module")
def events(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("dur", F.floor("value").cast("long"))
    # make user 0 hot: a third of all rows
    hot = ev.filter("user_id % 3 = 0").withColumn("user_id", F.lit(0).cast("long"))
    return ev.filter("user_id % 3 != 0").unionByName(hot)


@pytest.mark.parametrize("nb", [1, 7, 64, 500])
@pytest.mark.parametrize("keys,gap", [(["user_id"], 360), (["user_id", "event_type"], 720), (["event_type"], 0)])
def test_islands_equal_plain_window(spark, events, nb, keys, gap):
    want = _plain(events, keys, "ts", "dur", gap, ["event_id"])
    got = S.with_islands(events, keys, "ts", duration="dur", gap=gap, tie="event_id", n_blocks=nb)
    a = sorted((r.event_id, r.isl, r.g) for r in want.collect())
    b = sorted((r.event_id, r.island_id, r.gap_from_prev_minutes) for r in got.collect())
    assert a == b


def test_fixture_gap_rules(spark):
    t = dt.datetime
    rows = [
        ("a", 1, t(2024, 1, 1, 9, 0), 30),    # 9:00-9:30
        ("a", 2, t(2024, 1, 1, 9, 45), 15),   # gap 15 merges
        ("a", 3, t(2024, 1, 1, 10, 16), 10),  # gap 16 splits
        ("b", 4, t(2024, 1, 1, 8, 0), 120),   # long row 8:00-10:00
        ("b", 5, t(2024, 1, 1, 8, 30), 5),    # inside it: gap negative -> merges
        ("b", 6, t(2024, 1, 1, 9, 0), 5),     # previous row's end is 8:35 -> gap 25 splits
        ("c", 7, t(2024, 1, 1, 23, 50), 20),  # crosses midnight
        ("c", 8, t(2024, 1, 2, 0, 20), 20),   # gap 10 merges
    ]
    df = spark.createDataFrame(rows, "k string, id long, ts timestamp_ntz, dur long")
    for nb in (1, 3, 8):
        got = {r.id: r.island_id for r in S.with_islands(df, "k", "ts", duration="dur", gap=15,
                                                         tie="id", n_blocks=nb).collect()}
        assert got == {1: 1, 2: 1, 3: 2, 4: 1, 5: 1, 6: 2, 7: 1, 8: 1}


def test_minute_boundary_diff(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 0, 59), dt.datetime(2024, 1, 1, 10, 1, 0))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(minute_boundaries("a", "b").alias("d")).first().d == 1


def test_hist_and_topk(spark, events):
    isl = S.with_islands(events, ["user_id"], "ts", duration="dur", gap=360, tie="event_id", n_blocks=16)
    hist = S.island_size_hist(isl, ["user_id"]).collect()
    assert sum(r.total_raw_sessions for r in hist) == events.count()
    assert abs(sum(r.pct_of_total_sessions for r in hist) - 100) < 0.1
    top = S.topk_islands_rows(isl, ["user_id"], k=3)
    sizes = top.groupBy("user_id", "island_id").agg(F.count("*").alias("n"), F.first("sessions_combined").alias("s"))
    assert sizes.count() == 3 and all(r.n == r.s for r in sizes.collect())


def test_hot_key_is_split(spark, events):
    # 95% of the rows on one key: no block holds over twice its share, and
    # the result still equals the plain window
    hot = events.withColumn("user_id", F.when(F.col("event_id") % 20 != 0, F.lit(0)).otherwise(F.col("user_id")))
    rows, n = hot.count(), 16
    blocks = range_blocks(hot, ["user_id", "ts", "event_id"], n).groupBy("_blk").count().collect()
    assert max(r["count"] for r in blocks) <= 2 * rows / n
    want = _plain(hot, ["user_id"], "ts", "dur", 360, ["event_id"])
    for blocks in (None, n):
        got = S.with_islands(hot, ["user_id"], "ts", duration="dur", gap=360, tie="event_id", n_blocks=blocks)
        a = sorted((r.event_id, r.isl) for r in want.collect())
        b = sorted((r.event_id, r.island_id) for r in got.collect())
        assert a == b


def test_null_starts_sort_last(spark):
    t = dt.datetime
    rows = [("a", 1, t(2024, 1, 1, 9, 0), 10), ("a", 2, None, 10), ("a", 3, t(2024, 1, 1, 9, 15), 10),
            ("a", 4, None, 5), ("b", 5, None, 5), ("b", 6, t(2024, 1, 2, 8, 0), 5)]
    df = spark.createDataFrame(rows, "k string, id long, ts timestamp_ntz, dur long")
    plain = {r.id: r.island_id for r in S.with_islands(df, "k", "ts", duration="dur", gap=15, tie="id").collect()}
    for nb in (2, 5):
        blocked = {r.id: r.island_id for r in S.with_islands(df, "k", "ts", duration="dur", gap=15, tie="id",
                                                             n_blocks=nb).collect()}
        assert blocked == plain
    # non-NULL starts first (1 and 3 merge), then each NULL start opens an island
    assert plain == {1: 1, 3: 1, 2: 2, 4: 3, 6: 1, 5: 2}


def test_null_keys_group_together(spark):
    t = dt.datetime
    rows = [(None, 1, t(2024, 1, 1, 9, 0), 10), (None, 2, t(2024, 1, 1, 9, 20), 10), ("a", 3, t(2024, 1, 1, 9, 5), 5),
            (None, 4, t(2024, 1, 1, 12, 0), 10), ("a", 5, t(2024, 1, 1, 9, 12), 5)]
    df = spark.createDataFrame(rows, "k string, id long, ts timestamp_ntz, dur long")
    plain = {r.id: r.island_id for r in S.with_islands(df, "k", "ts", duration="dur", gap=15, tie="id").collect()}
    assert plain == {1: 1, 2: 1, 4: 2, 3: 1, 5: 1}
    for nb in (2, 4):
        blocked = {r.id: r.island_id for r in S.with_islands(df, "k", "ts", duration="dur", gap=15, tie="id",
                                                             n_blocks=nb).collect()}
        assert blocked == plain
