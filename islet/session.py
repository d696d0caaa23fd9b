"""SparkSession construction and shared-folder helpers."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

_local: str | None = None  # the folder of a local session without a shared one

# Settings every session gets; a cluster's own spark-defaults win for the rest.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "islet", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Without that setting a session on this machine alone (``local[n]``) gets
    one folder per process; on a cluster it is an error, as executors do not
    see one another's folders.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        global _local
        d = _local = _local or tempfile.mkdtemp(prefix="islet-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def shared_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


SCRATCH_DB = "islet_scratch"
_scratch: list[tuple[str, str]] = []


def scratch_table(spark: SparkSession, prefix: str) -> tuple[str, str]:
    """(table name, location) for a scratch table: a database of its own,
    located in the shared checkpoint folder, so bucketed intermediate tables
    carry their bucketing to readers and can be dropped in one go."""
    import uuid
    db_path = shared_path(spark, SCRATCH_DB)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {SCRATCH_DB} LOCATION '{db_path}'")
    name = f"{prefix}_{uuid.uuid4().hex}"
    _scratch.append((f"{SCRATCH_DB}.{name}", os.path.join(db_path, name)))
    return _scratch[-1]


def scratch_since(mark: int = 0) -> list[tuple[str, str]]:
    """(table name, location) of the scratch tables made after ``mark`` others."""
    return _scratch[mark:]


def drop_tables(spark: SparkSession, tables: list[tuple[str, str]]) -> None:
    """Drop scratch tables and their files; their readers must be done."""
    for name, path in tables:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete_path(spark, path)
        if (name, path) in _scratch:
            _scratch.remove((name, path))


def delete_path(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def drop_scratch(spark: SparkSession) -> None:
    """Forget every scratch table (their files stay in the shared folder,
    which the cluster's own retention clears)."""
    spark.sql(f"DROP DATABASE IF EXISTS {SCRATCH_DB} CASCADE")
