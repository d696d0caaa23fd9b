"""The log's view DAG (S7 / S8), as composed DataFrame functions.

raw -> stg_workload -> combined_sessions -> dim_videos -> dim_videos_ml
seed ------------------------------------------------^  \\-> fct_videos_pending

Every view is a lazy DataFrame; asking for a subset (``only``) builds only
what those views need.  ``register`` exposes them as temp views for SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from islet.functions.scalars import date_plus_time
from islet.operators.clean import clean_log
from islet.operators.features import feature_table, pending_table
from islet.operators.rollup import entity_rollup
from islet.operators.sessions import sessionize
from islet.sources.io import materialize
from islet.sources.stages import Stages

VIEWS = ["stg_workload", "combined_sessions", "dim_videos", "dim_videos_ml", "fct_videos_pending"]
DEPENDS = {"stg_workload": [], "combined_sessions": ["stg_workload"], "dim_videos": ["combined_sessions"],
           "dim_videos_ml": ["dim_videos"], "fct_videos_pending": ["dim_videos"]}


def combined_sessions(stg: DataFrame, gap: int = 15, end: str = "max_end", n_blocks: int | None = None) -> DataFrame:
    """C2 on the cleaned log: key (video_id, creation_category), start =
    date + time_start, gap to the previous row's end in minute boundaries."""
    x = stg.withColumn("_ts", date_plus_time("date_workflow", "time_start"))
    # rows are DISTINCT in stg, so the full row breaks ties (the date and
    # start text too: both are NULL-able, which makes the start NULL)
    tie = ["date_workflow", "time_start", "time_end", "duration", "media_title", "video_type", "video_subtype",
           "media_type", "media_series"]
    s = sessionize(x, ["video_id", "creation_category"], "_ts", "duration", gap=gap, tie=tie,
                   date="date_workflow", time_start="time_start", time_end="time_end",
                   carry=["media_title", "video_type", "video_subtype", "media_type", "media_series"],
                   end=end, island="session_id", n_blocks=n_blocks)
    return s.withColumn("date_workflow", F.to_date("date_workflow"))


def build_views(raw: DataFrame, seed: DataFrame, only: Sequence[str] | None = None, gap: int = 15,
                n_blocks: int | None = None, materialize_stages: bool = True, stages: Stages | None = None) -> dict[str, DataFrame]:
    """The five views; ``only`` limits which are built.

    ``stages`` holds ``stg_workload``, ``combined_sessions`` and ``dim_videos``
    as its tables: those whose raw log is unchanged are read again, the others
    replaced, and its owner deletes them.

    Else, with ``materialize_stages``, the cleaned log (counted and read by the
    sessions) and ``dim_videos`` when both its readers are built are written
    once as tables in the shared checkpoint folder instead of being
    recomputed per reader (the source recomputes its view chain for every
    reader)."""
    want = set(only or VIEWS)
    need = set()

    def add(v):
        if v not in need:
            need.add(v)
            for d in DEPENDS[v]:
                add(d)

    for v in want:
        add(v)
    out: dict[str, DataFrame] = {}
    if stages is not None:
        steps = {"stg_workload": lambda: clean_log(raw, n_blocks=n_blocks),
                 "combined_sessions": lambda: combined_sessions(out["stg_workload"], gap, n_blocks=n_blocks),
                 "dim_videos": lambda: entity_rollup(out["combined_sessions"])}
        for name in need & set(steps):  # a fresh stage needs none before it
            if (name in want or {"dim_videos_ml", "fct_videos_pending"} & want and name == "dim_videos"):
                _staged(name, steps, out, raw, (gap, n_blocks), stages)
    elif "stg_workload" in need:
        out["stg_workload"] = clean_log(raw, n_blocks=n_blocks)
        if materialize_stages and "combined_sessions" in need:
            out["stg_workload"] = materialize(out["stg_workload"], "stg_workload")
    if stages is None and "combined_sessions" in need:
        out["combined_sessions"] = combined_sessions(out["stg_workload"], gap, n_blocks=n_blocks)
    if stages is None and "dim_videos" in need:
        out["dim_videos"] = entity_rollup(out["combined_sessions"])
        if materialize_stages and {"dim_videos_ml", "fct_videos_pending"} <= need:
            out["dim_videos"] = materialize(out["dim_videos"], "dim_videos")
    if "dim_videos_ml" in need:
        out["dim_videos_ml"] = feature_table(out["dim_videos"], seed)
    if "fct_videos_pending" in need:
        out["fct_videos_pending"] = pending_table(seed, out["dim_videos"])
    return {k: v for k, v in out.items() if k in want}


def _staged(name: str, steps: dict, out: dict[str, DataFrame], raw: DataFrame, params: tuple, stages: Stages) -> DataFrame:
    """A stage of the chain and, if it has to be built, those before it."""
    def build():
        for before in DEPENDS[name]:
            _staged(before, steps, out, raw, params, stages)
        return steps[name]()

    if name not in out:
        out[name] = stages.put(name, build, [raw], (name, *params))
    return out[name]


def register(views: dict[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)
