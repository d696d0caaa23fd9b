"""Sources and sinks.

The raw log is a CSV with an explicit schema; its arrival order (the source
relies on CSV row order) is captured at scan time from the file path, the
split offset and the row's position in the split, then turned into a dense
``_seq`` by the block-decomposed global index.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from islet.functions.scalars import time_12h_to_24h
from islet.operators.ordered import with_global_index
from islet.session import delete_path, shared_path

RAW_LOG_SCHEMA = T.StructType([
    T.StructField("media_type", T.StringType()),
    T.StructField("media_series", T.StringType()),
    T.StructField("media_title", T.StringType()),
    T.StructField("video_type", T.StringType()),
    T.StructField("video_subtype", T.StringType()),
    T.StructField("creation_category", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("time_start", T.StringType()),
    T.StructField("time_end", T.StringType()),
    T.StructField("duration", T.LongType()),
])

SEED_SCHEMA = T.StructType([
    T.StructField("media_title", T.StringType()),
    T.StructField("video_type", T.StringType()),
    T.StructField("video_subtype", T.StringType()),
    T.StructField("expected_length_mins", T.IntegerType()),
    T.StructField("complexity_new", T.IntegerType()),
    T.StructField("complexity_media_depth", T.IntegerType()),
    T.StructField("complexity_delivery_style", T.IntegerType()),
    T.StructField("complexity_logistics", T.IntegerType()),
    T.StructField("complexity_worklife", T.IntegerType()),
    T.StructField("is_complete", T.IntegerType()),
])


# arrival order of file rows: file, split offset, row position in the split
ARRIVAL = ["_src_file", "_src_block", "_src_row"]


def with_arrival_columns(df: DataFrame) -> DataFrame:
    """H1: the arrival order of rows read from files, captured at scan time
    with no shuffle (within a split, monotonically_increasing_id grows with
    the position in the file)."""
    return df.select("*", F.col("_metadata.file_path").alias(ARRIVAL[0]),
                     F.col("_metadata.file_block_start").alias(ARRIVAL[1]),
                     F.monotonically_increasing_id().alias(ARRIVAL[2]))


def with_arrival_order(df: DataFrame, seq: str = "_seq", n_blocks: int | None = None) -> DataFrame:
    """Dense 1-based ROW_NUMBER() OVER () in arrival order (one range
    shuffle; only needed when the number itself is reported)."""
    return with_global_index(with_arrival_columns(df), ARRIVAL, seq, start=1, n_blocks=n_blocks).drop(*ARRIVAL)


def read_log(spark: SparkSession, path, schema: T.StructType = RAW_LOG_SCHEMA, date_format: str = "yyyy-MM-dd",
             dense_seq: bool = False, n_blocks: int | None = None) -> DataFrame:
    """CSV with header, explicit schema, empty -> NULL; a missing
    path raises (``PATH_NOT_FOUND``) before anything is built.  Rows carry
    their arrival order as the ARRIVAL columns (free), or as a dense
    ``_seq`` with ``dense_seq=True``."""
    df = (spark.read.schema(schema).option("header", True).option("dateFormat", date_format)
          .option("mode", "PERMISSIVE").csv(path))
    return with_arrival_order(df, "_seq", n_blocks) if dense_seq else with_arrival_columns(df)


BAD_LINE, BAD_TIME = "line", "time"
_RAW_LINE = "_raw_line"


@dataclass(frozen=True)
class Load:
    """What ``load_log`` loaded: the accepted rows, the rejected ones with
    ``reason`` and the line as it stands in the file, and counts of both."""

    rows: DataFrame
    rejects: DataFrame
    counts: dict[str, int]


class RejectedRows(ValueError):
    """A strict load met rows that it can't accept."""


def load_log(spark: SparkSession, path, to: str, schema: T.StructType = RAW_LOG_SCHEMA, date_format: str = "yyyy-MM-dd",
             times: Sequence[str] = ("time_start", "time_end"), strict: bool = False, header: bool = True) -> Load:
    """Load a CSV log into the table ``to`` in one pass that also
    counts and sets apart what it can't accept.

    A line is rejected as ``line`` if it has too few or too many fields or a
    value that is none of its column's type, else as ``time`` if one of
    ``times`` is present but no 12-hour clock time.  Empty fields are NULL and
    accepted.  ``counts`` (rows, accepted, line, time) are observed while the
    rows are written, so no other pass counts them.  ``strict`` stops at any
    rejected row: the table is not there then, as the source loads nothing."""
    text = T.StructType([*schema.fields, T.StructField(_RAW_LINE, T.StringType())])
    df = (spark.read.schema(text).option("header", header).option("dateFormat", date_format)
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RAW_LINE).csv(path))
    wrong = [F.col(c).isNotNull() & time_12h_to_24h(c).isNull() for c in times]
    bad_time = reduce(lambda a, b: a | b, wrong, F.lit(False))
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in schema.names])
    reason = F.when(F.col(_RAW_LINE).isNotNull(), BAD_LINE).when(bad_time, BAD_TIME)
    df = with_arrival_columns(df).withColumn("reason", reason)
    df = df.withColumn(_RAW_LINE, F.when(F.col("reason").isNotNull(), F.coalesce(_RAW_LINE, line)))
    seen = Observation(f"load-{uuid.uuid4().hex}")
    df = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("reason").isNull()).alias("accepted"),
                    F.count_if(F.col("reason") == BAD_LINE).alias(BAD_LINE), F.count_if(F.col("reason") == BAD_TIME).alias(BAD_TIME))
    df.withColumn("rejected", F.col("reason").isNotNull()).write.mode("overwrite").partitionBy("rejected").parquet(to)
    counts = {k: int(v) for k, v in seen.get.items()}
    if strict and counts["accepted"] < counts["rows"]:
        delete_path(spark, to)
        raise RejectedRows(f"{path}: {counts[BAD_LINE]} malformed lines and {counts[BAD_TIME]} rows with unreadable times of {counts['rows']}")
    table = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("rejected", T.BooleanType())])).parquet(to)
    return Load(table.filter("not rejected").drop("rejected", "reason", _RAW_LINE),
                table.filter("rejected").select("reason", F.col(_RAW_LINE).alias("line"), *ARRIVAL), counts)


def read_seed(spark: SparkSession, path, schema: T.StructType = SEED_SCHEMA) -> DataFrame:
    """The small label dimension."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                partition_by: Sequence[str] | None = None) -> None:
    """Drop-and-recreate (or append) a materialised table."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """CREATE TABLE AS for an intermediate stage: written once to the
    shared checkpoint folder and read back, so several readers (or a skew
    check and the real work) do not each recompute its lineage."""
    path = shared_path(df.sparkSession, f"islet-stage-{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def to_client(df: DataFrame, max_rows: int = 100_000):
    """Hand a small result (a report, a coefficient table) to the
    caller as pandas.  Refuses anything over ``max_rows`` (checked by
    reading at most max_rows + 1 rows), so row-level data is never pulled
    onto the driver."""
    top = df.limit(max_rows + 1).toPandas()
    if len(top) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; aggregate it first")
    return top


def row_count(df: DataFrame) -> int:
    """S4."""
    return df.count()


def path_exists(spark: SparkSession, path: str) -> bool:
    """S13 helper: probe a path through the reader (no file-system client)."""
    try:
        spark.read.format("binaryFile").load(path).limit(1).count()
        return True
    except AnalysisException:
        return False


def write_meta(spark: SparkSession, meta: Mapping, path: str) -> None:
    """Model metadata as one JSON document (nested values as JSON text
    so the sidecar keeps any shape)."""
    row = {k: (json.dumps(v) if isinstance(v, (dict, list)) else v) for k, v in meta.items()}
    row["train_cutoff"] = str(meta.get("train_cutoff")) if meta.get("train_cutoff") is not None else None
    fields = [T.StructField(k, T.StringType() if isinstance(v, str) or v is None else
                            T.BooleanType() if isinstance(v, bool) else
                            T.DoubleType() if isinstance(v, float) else T.LongType()) for k, v in row.items()]
    spark.createDataFrame([tuple(row.values())], T.StructType(fields)).coalesce(1).write.mode("overwrite").json(path)


def read_meta(spark: SparkSession, path: str) -> dict:
    """Read back what ``write_meta`` wrote."""
    r = spark.read.json(path).first().asDict()
    out = {}
    for k, v in r.items():
        if isinstance(v, str) and v[:1] in "[{":
            try:
                v = json.loads(v)
            except ValueError:
                pass
        out[k] = v
    return out


def save_linear_model(spark: SparkSession, model: Mapping, path: str, extra: Mapping | None = None) -> None:
    """S11 for linear models: the coefficients are the model."""
    write_meta(spark, {**model, **(extra or {})}, path)


def load_linear_model(spark: SparkSession, path: str) -> dict:
    return read_meta(spark, path)


def save_model(spark: SparkSession, model: Mapping, path: str) -> None:
    """A linear model, or a tree model (``model`` fitted by MLlib,
    ``features``) as MLlib's own files beside its metadata."""
    if "model" not in model:
        return save_linear_model(spark, model, path)
    model["model"].write().overwrite().save(f"{path}/model")
    kept = {k: v for k, v in model.items() if k not in ("model", "features")}
    write_meta(spark, {**kept, "features": list(model["features"]), "kind": type(model["model"]).__name__}, f"{path}/meta")


def load_model(spark: SparkSession, path: str) -> dict:
    """What ``save_model`` saved."""
    if not path_exists(spark, f"{path}/meta"):
        return load_linear_model(spark, path)
    from pyspark.ml import regression
    meta = read_meta(spark, f"{path}/meta")
    return {**meta, "model": getattr(regression, meta["kind"]).load(f"{path}/model")}


def check_round_trip(spark: SparkSession, model: Mapping, path: str, df: DataFrame, label: str,
                     tol: float = 1e-6) -> bool:
    """Q6: save, load, re-score; RMSE must agree within tol."""
    from islet.operators.models import predict_expr, predict_tree
    save_model(spark, model, path)
    back = load_model(spark, path)
    if "model" in model:
        df = predict_tree(df, model["model"], model["features"], "_p1")
        df = predict_tree(df, back["model"], back["features"], "_p2")
        p1, p2 = F.col("_p1"), F.col("_p2")
    else:
        p1, p2 = predict_expr(model), predict_expr(back)
    d1, d2 = p1 - F.col(label), p2 - F.col(label)
    r = df.agg(F.sqrt(F.avg(d1 * d1)).alias("a"), F.sqrt(F.avg(d2 * d2)).alias("b")).first()
    return abs(r["a"] - r["b"]) < tol


def append_run(spark: SparkSession, path: str, experiment: str, run_id: str, run_name: str,
               params: Mapping | None = None, metrics: Mapping | None = None,
               step_metrics: DataFrame | None = None) -> None:
    """Params, scalar metrics and step metrics (a DataFrame with ``key,
    step, value``) of a run, in a long run table partitioned by experiment and
    run.  The run id is its identity: a repeated run replaces itself, other
    runs stay."""
    ts = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = [(experiment, run_id, run_name, "param", k, 0, str(v), ts) for k, v in (params or {}).items()]
    rows += [(experiment, run_id, run_name, "metric", k, 0, str(v), ts) for k, v in (metrics or {}).items()]
    schema = "experiment string, run_id string, run_name string, kind string, key string, step int, value string, ts timestamp_ntz"
    out = spark.createDataFrame(rows, schema)
    if step_metrics is not None:
        out = out.unionByName(step_metrics.select(
            F.lit(experiment).alias("experiment"), F.lit(run_id).alias("run_id"), F.lit(run_name).alias("run_name"),
            F.lit("metric").alias("kind"), F.col("key"), F.col("step").cast("int"), F.col("value").cast("string"),
            F.lit(ts).cast("timestamp_ntz").alias("ts")))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("experiment", "run_id").parquet(path)


RUN_SCHEMA = "run_name string, kind string, key string, step int, value string, ts timestamp_ntz, experiment string, run_id string"


def read_runs(spark: SparkSession, path: str, params: Sequence[str] = (), metrics: Sequence[str] = ()) -> DataFrame:
    """S12, read side: a row for each run with its named params (text) and the
    last value, by step, of its named metrics (double)."""
    rows = spark.read.schema(RUN_SCHEMA).parquet(path)
    value = lambda kind, key: F.when((F.col("kind") == kind) & (F.col("key") == key), F.col("value"))
    cols = [F.max(value("param", k)).alias(k) for k in params]
    cols += [F.max_by(value("metric", k).cast("double"), F.when(value("metric", k).isNotNull(), F.struct("step", "ts"))).alias(k) for k in metrics]
    return rows.groupBy("experiment", "run_id").agg(F.max("run_name").alias("run_name"), *cols)


def metric_series(spark: SparkSession, path: str, key: str) -> DataFrame:
    """S12, read side: (experiment, run_id, step, value) of one metric."""
    rows = spark.read.schema(RUN_SCHEMA).parquet(path)
    return rows.filter((F.col("kind") == "metric") & (F.col("key") == key)).select("experiment", "run_id", "step", F.col("value").cast("double").alias("value"))


def score_models(spark: SparkSession, df: DataFrame, model_paths: Mapping[str, str], label: str) -> tuple[DataFrame, list[str]]:
    """S13 + ML16: score every model whose artifact exists; missing ones are
    skipped and reported, the rest continue."""
    from islet.operators.monitor import score_many
    found, skipped = [], []
    for mid, p in model_paths.items():
        if path_exists(spark, p):
            found.append({**load_model(spark, p), "id": mid})
        else:
            skipped.append(mid)
    return (score_many(df, found, label) if found else df), skipped
