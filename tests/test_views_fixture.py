"""FIXTURES §3.1: clean -> sessionise -> roll up, on a hand-made log."""

import csv
import datetime as dt
import os
import tempfile

import pytest

from islet.plans.views import build_views
from islet.sources.io import read_log, read_seed

BASE = dict(media_type="Movies", media_series="S", media_title="T1", video_type="Review", video_subtype="A")
ROWS = [  # creation_category, date, start, end, duration, overrides
    ("Writing Scriot", "2024-01-01", "9:00:00 AM", "9:30:00 AM", 30, {"media_type": " Movies "}),
    ("Outline", "", "9:45:00 AM", "10:00:00 AM", 15, {}),
    ("Writing Script", "2024-01-01", "10:16:00 AM", "10:26:00 AM", 10, {}),
    ("Editing Video", "2024-01-01", "11:50:00 PM", "12:10:00 AM", -1420, {}),
    ("Editing", "2024-01-02", "12:20:00 AM", "12:40:00 AM", 20, {}),
    ("Editing", "2024-01-02", "12:20:00 AM", "12:40:00 AM", 20, {}),
    ("Stats", "2024-01-02", "1:00:00 PM", "1:05:00 PM", 5, {}),
    (" Stats", "2024-01-03", "1:00:00 PM", "1:05:00 PM", 5, {}),
    ("Editing", "2024-02-01", "1:00:00 PM", "1:05:00 PM", 5, {"media_type": "Channel"}),
    ("Picture", "", "2:00:00 PM", "2:10:00 PM", 10, {}),
    ("Editing", "2024-01-03", "2:30:00 PM", "2:35:00 PM", 5, {"video_subtype": ""}),
    ("Recording Audip ", "2024-01-03", "3:00:00 PM", "3:07:00 PM", 7, {}),
]
COLS = ["media_type", "media_series", "media_title", "video_type", "video_subtype", "creation_category",
        "date", "time_start", "time_end", "duration"]


@pytest.fixture(scope="module")
def views(spark):
    d = tempfile.mkdtemp(prefix="islet-fixture-")
    path = os.path.join(d, "workload.csv")
    with open(path, "w", newline="") as f:
        w = csv.writer(f, quoting=csv.QUOTE_MINIMAL)
        w.writerow(COLS)
        for cat, date, ts, te, dur, over in ROWS:
            r = {**BASE, **over, "creation_category": cat, "date": date, "time_start": ts, "time_end": te,
                 "duration": dur}
            w.writerow([r[c] for c in COLS])
    seed_path = os.path.join(d, "labels.csv")
    with open(seed_path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["media_title", "video_type", "video_subtype", "expected_length_mins", "complexity_new",
                    "complexity_media_depth", "complexity_delivery_style", "complexity_logistics",
                    "complexity_worklife", "is_complete"])
        w.writerow(["T1", "Review", "A", 15, 1, 0, 1, 0, 0, 1])
        w.writerow(["T2", "Review", "B", 12, 1, 1, 1, 0, 0, 0])
    raw = read_log(spark, path, n_blocks=3)
    seed = read_seed(spark, seed_path)
    v = build_views(raw, seed, n_blocks=4)
    v["_inputs"] = (raw, seed)
    return v


def test_clean_log(views):
    stg = views["stg_workload"]
    rows = stg.collect()
    assert len(rows) == 8  # 12 - Stats - Channel - NULL subtype - duplicate
    cats = sorted(r.creation_category for r in rows)
    assert cats == ["Editing", "Editing", "Recording Audip", "Script", "Script", "Script", "Stats", "Thumbnail"]
    assert {r.media_type for r in rows} == {"Movies"}
    thumb = [r for r in rows if r.creation_category == "Thumbnail"][0]
    assert thumb.date_workflow == dt.date(2024, 1, 3)  # not the dropped Channel row's date
    outline = [r for r in rows if r.time_start == "09:45:00"][0]
    assert outline.date_workflow == dt.date(2024, 1, 1)
    assert [r.duration for r in rows if r.time_start == "23:50:00"] == [20]
    assert rows[0].video_id == __import__("hashlib").md5(b"T1|Review|A").hexdigest()


def test_sessions(views):
    got = sorted((r.creation_category, r.session_id, str(r.date_workflow), r.time_start, r.time_end,
                  r.sessions_combined, r.duration) for r in views["combined_sessions"].collect())
    assert got == sorted([
        ("Script", 1, "2024-01-01", "09:00:00", "10:00:00", 2, 45),
        ("Script", 2, "2024-01-01", "10:16:00", "10:26:00", 1, 10),
        ("Editing", 1, "2024-01-01", "00:20:00", "00:40:00", 2, 40),
        ("Stats", 1, "2024-01-03", "13:00:00", "13:05:00", 1, 5),
        ("Thumbnail", 1, "2024-01-03", "14:00:00", "14:10:00", 1, 10),
        ("Recording Audip", 1, "2024-01-03", "15:00:00", "15:07:00", 1, 7),
    ])


def test_rollup(views):
    r = views["dim_videos"].first()
    assert (r.total_hours, str(r.date_first), str(r.date_last), r.total_day_span, r.active_days_worked) == \
        (1.95, "2024-01-01", "2024-01-03", 3, 2)
    assert (r.hours_creation, r.creation_day_span) == (1.58, 1)
    assert (r.hours_script, r.hours_editing, r.hours_thumbnail) == (0.92, 0.67, 0.17)
    assert (r.hours_pre_processing, r.hours_processing, r.hours_post_processing, r.hours_uncategorised) == \
        (0.92, 0.67, 0.17, 0.2)
    for p in ("pre_processing", "processing", "post_processing"):
        assert (r[f"{p}_total_day_span"], r[f"{p}_active_days"]) == (1, 1)


def test_feature_and_pending(views):
    ml = views["dim_videos_ml"].first()
    assert (ml.expected_length_mins, ml.length_tier, ml.length_tier_ord) == (15, "Average", 1)
    pend = views["fct_videos_pending"].collect()
    assert len(pend) == 1
    p = pend[0]
    # planned item with no sessions: kept, facts NULL; length 12 is unmapped
    assert (p.media_title, p.media_type, p.date_first, p.length_tier, p.length_tier_ord) == ("T2", None, None, None, None)


def test_partial_refresh(views):
    raw, seed = views["_inputs"]
    only = build_views(raw, seed, only=["fct_videos_pending"], n_blocks=2)
    assert list(only) == ["fct_videos_pending"]
    assert only["fct_videos_pending"].count() == 1
