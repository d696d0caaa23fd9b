"""The life of materialised stages (S5, S8): reuse, replacement, deletion."""

import os

import pytest
from pyspark.sql import functions as F

from islet.operators.ordered import forward_fill
from islet.plans.views import build_views
from islet.session import SCRATCH_DB, scratch_since, shared_path
from islet.sources.stages import Stages, fingerprint


def _source(spark, path, values):
    spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, x long").coalesce(1).write.mode("overwrite").parquet(str(path))
    return spark.read.parquet(str(path))


def test_unchanged_inputs_are_reused_and_changed_ones_rebuilt(spark, tmp_path):
    src, built = tmp_path / "src", []

    def build(df):
        built.append(1)
        return forward_fill(df, "id", "x", n_blocks=3)

    with Stages(spark) as stages:
        df = _source(spark, src, [1, None, 3])
        for _ in range(2):
            out = stages.put("filled", lambda: build(df), [df], [3])
            assert sorted((r.id, r.x) for r in out.collect()) == [(0, 1), (1, 1), (2, 3)]
        assert (stages.written, stages.reused, len(built)) == (["filled"], ["filled"], 1)
        stages.put("filled", lambda: build(df), [df], [4])  # another parameter
        old = stages.read("filled")
        df = _source(spark, src, [7, None])  # the same path, other files
        new = stages.put("filled", lambda: build(df), [df], [4])
        assert len(built) == 3 and sorted(r.x for r in new.collect()) == [7, 7]
        # a reader of the version before still sees that one, whole
        assert sorted(r.x for r in old.collect()) == [1, 1, 3]
        assert sorted(r.x for r in stages.read("filled").collect()) == [7, 7]
    assert not os.path.exists(stages.root)


def test_block_tables_go_with_the_build(spark, tmp_path):
    df = _source(spark, tmp_path / "src", [1, None, 3])
    before = len(scratch_since())
    with Stages(spark) as stages:
        stages.put("filled", lambda: forward_fill(df, "id", "x", n_blocks=2), [df])
        made = scratch_since(before)
        assert not made
    names = {t.name for t in spark.catalog.listTables(SCRATCH_DB)}
    assert all(n.split(".")[1] in names for n, _ in scratch_since())


def test_failed_builds_leave_the_current_version(spark, tmp_path):
    df = _source(spark, tmp_path / "src", [1, 2])
    with Stages(spark) as stages:
        stages.put("s", lambda: df, [df])

        def fails():
            return df.withColumn("y", F.raise_error(F.lit("stop")))

        with pytest.raises(Exception, match="stop"):
            stages.put("s", fails, [df], ["other"])
        assert stages.read("s").count() == 2
        with pytest.raises(KeyError):
            stages.read("none")


def test_a_kept_folder_serves_later_handles(spark, tmp_path):
    df = _source(spark, tmp_path / "src", [1, 2])
    keep = f"kept-{os.getpid()}"
    with Stages(spark, keep) as first:
        first.put("s", lambda: df, [df])
        first.put("s", lambda: df, [df], ["b"])
    with Stages(spark, keep) as second:
        second.put("s", lambda: pytest.fail("built again"), [df], ["b"])
        versions = [d for d in os.listdir(os.path.join(second.root, "s")) if d.startswith("v-")]
        assert len(versions) == 1  # the version before went with its handle
    Stages(spark).close()


def test_local_rows_are_never_taken_for_others(spark):
    a, b = (spark.createDataFrame([(x,)], "x long") for x in (1, 2))
    assert fingerprint([a]) != fingerprint([b])
    # computed columns and parameters count
    r = spark.range(3)
    assert fingerprint([r]) == fingerprint([spark.range(3)]) != fingerprint([r.withColumn("y", F.lit(1))])
    assert fingerprint([r], [1]) != fingerprint([r], [2])


def test_views_reuse_the_chain(spark, tmp_path):
    from islet.plans.catalogue import _raw_log, _seed
    from tests.conftest import SF

    raw, seed = _raw_log(spark, SF), _seed(spark, SF)
    with Stages(spark) as stages:
        plain = build_views(raw, seed)
        got = build_views(raw, seed, stages=stages)
        assert set(got) == set(plain)
        assert sorted(stages.written) == ["combined_sessions", "dim_videos", "stg_workload"]
        for name in plain:
            assert sorted(map(str, got[name].select(*plain[name].columns).collect())) == sorted(map(str, plain[name].collect()))
        n = len(stages.written)
        # a fresh last stage needs none of those before it
        build_views(raw, seed, only=["dim_videos_ml"], stages=stages)
        assert len(stages.written) == n and stages.reused[-1] == "dim_videos"
        build_views(raw, seed, only=["combined_sessions"], gap=30, stages=stages)
        assert len(stages.written) == n + 2
    assert not os.path.exists(stages.root) and stages.root.startswith(shared_path(spark, ""))
