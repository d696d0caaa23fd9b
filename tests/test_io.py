"""Sinks and small projections: S10-S13, Q6, P9, P14, P15."""

import os
import tempfile

from pyspark.sql import functions as F

from islet.operators import clean, profile
from islet.sources import io
from tests.conftest import SF

MODEL = {"model_id": "m1", "intercept": 1.5, "coefficients": {"x": 2.0}, "features": ["x"],
         "train_cutoff": "2025-01-20", "alpha": 0.5}


def test_meta_round_trip(spark):
    d = tempfile.mkdtemp(prefix="islet-meta-")
    io.write_meta(spark, MODEL, os.path.join(d, "m1"))
    back = io.read_meta(spark, os.path.join(d, "m1"))
    assert back["coefficients"] == {"x": 2.0} and back["features"] == ["x"]
    assert back["train_cutoff"] == "2025-01-20" and back["intercept"] == 1.5


def test_model_round_trip_check(spark):
    d = tempfile.mkdtemp(prefix="islet-model-")
    df = spark.range(100).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2.1).alias("y"))
    assert io.check_round_trip(spark, MODEL, os.path.join(d, "m"), df, "y")


def test_missing_artifact_skipped(spark):
    d = tempfile.mkdtemp(prefix="islet-models-")
    io.save_linear_model(spark, MODEL, os.path.join(d, "m1"))
    df = spark.range(3).select(F.col("id").cast("double").alias("x"), F.lit(1.0).alias("y"))
    scored, skipped = io.score_models(spark, df, {"m1": os.path.join(d, "m1"), "m2": os.path.join(d, "absent")}, "y")
    assert skipped == ["m2"]
    assert [r.pred_m1 for r in scored.orderBy("x").collect()] == [1.5, 3.5, 5.5]


def test_run_table_appends(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="islet-runs-"), "runs")
    steps = spark.createDataFrame([("rolling_rmse", 1, 3.2), ("rolling_rmse", 2, 3.6)], "key string, step int, value double")
    io.append_run(spark, d, "monitoring", "r1", "monitor_1", params={"n_total": 98}, metrics={"drift_flag": 1},
                  step_metrics=steps)
    io.append_run(spark, d, "monitoring", "r2", "monitor_2", metrics={"drift_flag": 0})
    runs = spark.read.parquet(d)
    assert runs.count() == 5
    assert {r.kind for r in runs.collect()} == {"param", "metric"}
    assert runs.filter("experiment = 'monitoring' AND key = 'rolling_rmse'").count() == 2


def test_write_table_and_count(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="islet-tab-"), "t")
    df = spark.read.parquet(f"{SF}/region.parquet")
    io.write_table(df, d)
    io.write_table(df, d)  # drop and recreate
    assert io.row_count(spark.read.parquet(d)) == df.count()


def test_projections(spark):
    df = spark.createDataFrame([("Playthrough A", 1), ("Review", 2)], "t string, n int")
    assert [r.t for r in clean.replace_values(df, {"Playthrough A": "Other"}, ["t"]).orderBy("n").collect()] == \
        ["Other", "Review"]
    assert clean.ensure_columns(df, ["n", "d1"]).columns == ["t", "n", "d1"]
    long = profile.transpose(df, "t")
    assert {(r.t, r.column, r.value) for r in long.collect()} == {("Playthrough A", "n", "1"), ("Review", "n", "2")}


def test_arrival_order_across_splits(spark):
    d = tempfile.mkdtemp(prefix="islet-arrival-")
    path = os.path.join(d, "log.csv")
    n = 3000
    with open(path, "w") as f:
        f.write("media_type,media_series,media_title,video_type,video_subtype,creation_category,date,time_start,time_end,duration\n")
        for i in range(n):
            f.write(f"Movies,S,T,Review,A,Editing,2024-01-01,9:00:00 AM,9:10:00 AM,{i}\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")  # several splits of one file
    try:
        dense = io.read_log(spark, path, dense_seq=True, n_blocks=4)
        assert [r.duration for r in dense.orderBy("_seq").collect()] == list(range(n))
        assert dense.agg(F.min("_seq"), F.max("_seq")).first() == (1, n)
        cols = io.read_log(spark, path)
        ordered = cols.orderBy(*io.ARRIVAL).collect()
        assert [r.duration for r in ordered] == list(range(n))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_to_client_bounded(spark):
    import pytest
    small = spark.range(5)
    assert len(io.to_client(small, max_rows=10)) == 5
    with pytest.raises(ValueError):
        io.to_client(spark.range(50), max_rows=10)


def test_tree_models_round_trip(spark, tmp_path):
    from islet.operators import models, monitor
    df = spark.range(200).select((F.col("id") % 7).alias("a"), F.when(F.col("id") != 5, F.col("id") % 3).alias("b"),
                                 ((F.col("id") % 7) * 2.0 + F.col("id") % 3).alias("y"))
    forest = {"model": models.fit_forest(df, ["a", "b"], "y", n_trees=5), "features": ["a", "b"]}
    gbt = {"model": models.fit_gbt(df, ["a", "b"], "y", rounds=3), "features": ["a", "b"]}
    linear = {"intercept": 0.5, "coefficients": {"a": 2.0, "b": 1.0}, "log_target": False}
    for name, m in (("forest", forest), ("gbt", gbt), ("linear", linear)):
        assert io.check_round_trip(spark, m, str(tmp_path / name), df, "y")
    paths = {n: str(tmp_path / n) for n in ("forest", "gbt", "linear", "gone")}
    scored, skipped = io.score_models(spark, df, paths, "y")
    assert skipped == ["gone"]
    # a NULL feature gives no prediction, for trees as for linear models
    row = scored.filter("b IS NULL").first()
    assert row.pred_forest is None and row.pred_gbt is None and row.pred_linear is None
    assert scored.filter("pred_forest IS NULL").count() == 1
    assert set(df.columns) | {f"{k}_{n}" for k in ("pred", "resid") for n in ("forest", "gbt", "linear")} == set(scored.columns)
    assert [r.model_id for r in monitor.rmse_report(scored.withColumn("era", F.lit("post")), ["forest", "gbt"]).collect()] \
        == ["forest", "gbt"]


LOG_LINES = ["media_type,media_series,media_title,video_type,video_subtype,creation_category,date,time_start,time_end,duration",
             "Video,S,t,Essay,A,Editing,2024-01-01,9:05:00 PM,9:15:00 PM,10",
             "Video,S,t,Essay,A,Editing,,9:05:00 PM,,10",            # empty fields are NULL, not wrong
             "Video,S,t,Essay,A,Editing,2024-01-02,21:05:00,9:15:00 PM,10",   # no 12-hour time
             "Video,S,t,Essay,A,Editing,2024-01-02,9:05:00 PM,13:00:00 PM,10",
             "Video,S,t,Essay",                                       # too few fields
             "Video,S,t,Essay,A,Editing,2024-01-02,9:05:00 PM,9:15:00 PM,ten",  # no number
             "Video,S,t,Essay,A,Editing,not a day,9:05:00 PM,9:15:00 PM,10",
             "Video,S,t,Essay,A,Editing,2024-01-03,9:05:00 PM,9:15:00 PM,10,more"]


def _log(tmp_path, lines):
    (tmp_path / "log.csv").write_text("\n".join(lines) + "\n")
    return str(tmp_path / "log.csv")


def test_load_counts_and_sets_rejects_apart(spark, tmp_path):
    load = io.load_log(spark, _log(tmp_path, LOG_LINES), str(tmp_path / "table"))
    assert load.counts == {"rows": 8, "accepted": 2, "line": 4, "time": 2}
    assert [(str(r.date), r.time_end) for r in load.rows.orderBy(*io.ARRIVAL).collect()] == [("2024-01-01", "9:15:00 PM"), ("None", None)]
    assert load.rows.columns == [*io.RAW_LOG_SCHEMA.names, *io.ARRIVAL]
    bad = [(r.reason, r.line) for r in load.rejects.orderBy(*io.ARRIVAL).collect()]
    assert bad == [("time", LOG_LINES[3]), ("time", LOG_LINES[4]), *[("line", x) for x in LOG_LINES[5:]]]


def test_strict_load_stops_and_leaves_no_table(spark, tmp_path):
    import pytest

    path = _log(tmp_path, LOG_LINES)
    with pytest.raises(io.RejectedRows, match="4 malformed lines and 2 rows"):
        io.load_log(spark, path, str(tmp_path / "table"), strict=True)
    assert not (tmp_path / "table").exists()
    load = io.load_log(spark, _log(tmp_path, LOG_LINES[:3]), str(tmp_path / "table"), strict=True)
    assert load.rows.count() == 2 == load.counts["accepted"] and load.rejects.count() == 0


def test_load_of_an_empty_log(spark, tmp_path):
    load = io.load_log(spark, _log(tmp_path, LOG_LINES[:1]), str(tmp_path / "table"))
    assert load.counts == {"rows": 0, "accepted": 0, "line": 0, "time": 0}
    assert load.rows.count() == 0 == load.rejects.count()
