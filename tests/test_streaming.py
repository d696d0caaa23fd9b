"""Incremental ingest: each file loaded once, arrival order kept."""

import os
import tempfile

from islet.streaming.ingest import ingest_new_logs, read_raw

HEADER = "media_type,media_series,media_title,video_type,video_subtype,creation_category,date,time_start,time_end,duration\n"


def _file(d, name, rows):
    with open(os.path.join(d, name), "w") as f:
        f.write(HEADER)
        for i in rows:
            f.write(f"Movies,S,T{i},Review,A,Editing,2024-01-{i:02d},9:00:00 AM,9:10:00 AM,{i}\n")


def test_ingest_twice(spark):
    src = tempfile.mkdtemp(prefix="islet-src-")
    out = tempfile.mkdtemp(prefix="islet-raw-")
    ck = tempfile.mkdtemp(prefix="islet-ck-")
    _file(src, "a.csv", [1, 2, 3])
    ingest_new_logs(spark, src, out, ck)
    _file(src, "b.csv", [4, 5])
    ingest_new_logs(spark, src, out, ck)
    ingest_new_logs(spark, src, out, ck)  # nothing new: no duplicates
    got = [(r._seq, r.duration) for r in read_raw(spark, out, n_blocks=3).orderBy("_seq").collect()]
    assert got == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5)]


def test_ingested_log_feeds_the_views(spark):
    import csv
    from islet.plans.views import build_views
    from islet.sources.io import read_log
    from tests.test_views_fixture import BASE, COLS, ROWS
    src = tempfile.mkdtemp(prefix="islet-src-")
    with open(os.path.join(src, "workload.csv"), "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(COLS)
        for cat, date, ts, te, dur, over in ROWS:
            r = {**BASE, **over, "creation_category": cat, "date": date, "time_start": ts, "time_end": te,
                 "duration": dur}
            w.writerow([r[c] for c in COLS])
    out, ck = tempfile.mkdtemp(prefix="islet-raw-"), tempfile.mkdtemp(prefix="islet-ck-")
    ingest_new_logs(spark, src, out, ck)
    via_stream = build_views(read_raw(spark, out, n_blocks=2), None, only=["combined_sessions"], n_blocks=2)
    direct = build_views(read_log(spark, os.path.join(src, "workload.csv")), None, only=["combined_sessions"],
                         n_blocks=2)
    cols = ["creation_category", "session_id", "date_workflow", "time_start", "time_end", "duration"]
    a = sorted(tuple(r[c] for c in cols) for r in via_stream["combined_sessions"].collect())
    b = sorted(tuple(r[c] for c in cols) for r in direct["combined_sessions"].collect())
    assert a == b and len(a) == 6
