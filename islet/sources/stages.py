"""The life of materialised stages.

A ``Stages`` handle owns the tables it writes.  A stage is written beside its
earlier version and then switched to by one atomic rename of a small file, so
a reader by name sees the old table or the new one, never half of one.  A
stage whose inputs are unchanged is read again instead of being rebuilt, and
closing the handle deletes what nothing names any more.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from islet.session import delete_path, drop_tables, scratch_since, shared_path


def fingerprint(inputs: Sequence[DataFrame], params: Sequence = ()) -> str:
    """Of the inputs' plans and schemas, their files (path, length, time of
    change) and the parameters.  Inputs that are no files (local rows) are
    equal to themselves alone, so stages on them are built anew."""
    parts = [repr(list(params))]
    for df in inputs:
        parts += [str(df.semanticHash()), df.schema.json()]
        conf = df.sparkSession._jsc.hadoopConfiguration()
        for f in sorted(df.inputFiles()):
            at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(f)
            status = at.getFileSystem(conf).getFileStatus(at)
            parts.append(f"{f} {status.getLen()} {status.getModificationTime()}")
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


class Stages:
    """Named tables under one folder of the shared one.

    ``with Stages(spark) as stages`` has a folder of its own and deletes it at
    the end.  With ``keep`` (a name) the folder outlives the handle: each
    stage's current version stays for later handles, earlier ones go at the
    end."""

    def __init__(self, spark: SparkSession, keep: str | None = None):
        self.spark, self.kept = spark, keep is not None
        self.root = shared_path(spark, f"islet-stages-{keep or uuid.uuid4().hex}")
        self.written: list[str] = []
        self.reused: list[str] = []
        self._old: list[str] = []

    def __enter__(self) -> Stages:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def put(self, name: str, build: Callable[[], DataFrame], inputs: Sequence[DataFrame], params: Sequence = ()) -> DataFrame:
        """The stage ``name``: its current version if that has the fingerprint
        of ``inputs`` and ``params``, else what ``build`` returns, written and
        switched to.  Block tables that ``build`` made are dropped after it."""
        mark = fingerprint(inputs, params)
        now = self._current(name)
        if now and now["fingerprint"] == mark:
            self.reused.append(name)
            return self._read(now)
        tables = len(scratch_since())
        df = build()
        path = os.path.join(self.root, name, f"v-{uuid.uuid4().hex}")
        df.write.parquet(path)
        self._switch(name, {"path": path, "fingerprint": mark, "schema": df.schema.json()})
        self.written.append(name)
        if now:
            self._old.append(now["path"])
        drop_tables(self.spark, scratch_since(tables))
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        """The stage's current version."""
        now = self._current(name)
        if not now:
            raise KeyError(name)
        return self._read(now)

    def close(self) -> None:
        """Delete earlier versions, or the whole folder if it is not kept;
        readers of these must be done."""
        for path in self._old if self.kept else [self.root]:
            delete_path(self.spark, path)
        self._old.clear()

    def _read(self, now: dict) -> DataFrame:
        return self.spark.read.schema(T.StructType.fromJson(json.loads(now["schema"]))).parquet(now["path"])

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _current(self, name: str) -> dict | None:
        at, fs = self._fs(os.path.join(self.root, name, "current"))
        if not fs.exists(at):
            return None
        source = fs.open(at)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()
        return json.loads(text)

    def _switch(self, name: str, value: dict) -> None:
        jvm = self.spark._jvm
        new, fs = self._fs(os.path.join(self.root, name, f"next-{uuid.uuid4().hex}"))
        out = fs.create(new)
        try:
            out.write(bytearray(json.dumps(value).encode()))
        finally:
            out.close()
        at, _ = self._fs(os.path.join(self.root, name, "current"))
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), self.spark._jsc.hadoopConfiguration()).rename(new, at, how)
