"""Property tests on random small logs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from islet.operators import rollup, sessions

BASE = dt.datetime(2024, 1, 1)
row = st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 3 * 24 * 60), st.integers(0, 90))
logs = st.lists(row, min_size=1, max_size=40)
SLOW = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _frame(spark, rows):
    data = [(k, i, BASE + dt.timedelta(minutes=m), d) for i, (k, m, d) in enumerate(rows)]
    return spark.createDataFrame(data, "k string, id long, ts timestamp_ntz, dur long")


@SLOW
@given(rows=logs, nb=st.integers(1, 12), gap=st.integers(0, 60))
def test_blocked_islands_equal_plain(spark, rows, nb, gap):
    df = _frame(spark, rows)
    plain = {r.id: r.island_id for r in sessions.with_islands(df, "k", "ts", duration="dur", gap=gap, tie="id").collect()}
    blocked = {r.id: r.island_id for r in sessions.with_islands(df, "k", "ts", duration="dur", gap=gap, tie="id",
                                                                n_blocks=nb).collect()}
    assert blocked == plain


@SLOW
@given(rows=logs)
def test_island_ids_consecutive_and_duration_preserved(spark, rows):
    df = _frame(spark, rows)
    isl = sessions.with_islands(df, "k", "ts", duration="dur", gap=15, tie="id", n_blocks=3)
    per_key = {}
    for r in isl.orderBy("k", "ts", "id").collect():
        per_key.setdefault(r.k, []).append(r.island_id)
    for ids in per_key.values():
        assert ids[0] == 1
        assert all(b - a in (0, 1) for a, b in zip(ids, ids[1:]))  # monotone, no holes
    coll = sessions.collapse(isl, "k", sums=["dur"])
    assert coll.agg(F.sum("dur")).first()[0] == sum(d for _, _, d in rows)
    assert coll.agg(F.sum("sessions_combined")).first()[0] == len(rows)


@SLOW
@given(rows=st.lists(st.tuples(st.sampled_from(["Script", "Editing", "Thumbnail", "Stats"]),
                               st.integers(0, 20), st.integers(0, 300)), min_size=1, max_size=30))
def test_phase_hours_add_up(spark, rows):
    data = [("v", c, dt.date(2024, 1, 1) + dt.timedelta(days=day), dur) for c, day, dur in rows]
    df = spark.createDataFrame(data, "video_id string, creation_category string, date_workflow date, duration long")
    r = rollup.entity_rollup(df, descriptive=()).first()
    phases = r.hours_pre_processing + r.hours_processing + r.hours_post_processing + r.hours_uncategorised
    assert abs(phases - r.total_hours) <= 0.02 + 1e-9
    assert r.total_day_span >= r.active_days_worked >= 1
