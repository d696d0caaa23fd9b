"""Helpers shared by the operators: staged tables, renamed inputs, text chunks."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from islet.session import shared_path

CHUNK_BYTES = 2 << 20  # text bytes that the numpy passes hold at a time

_staged: list[str] = []


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage at a table that every executor can read, so a lost
    executor never repeats the work before it.  ``drop_staged`` deletes it.
    """
    spark = df.sparkSession
    path = staged_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted like staged tables."""
    path = shared_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    _staged.append(path)
    return path


def staged_count() -> int:
    """How many staged tables there are."""
    return len(_staged)


def drop_staged(spark: SparkSession, first: int = 0, end: int | None = None) -> None:
    """Delete the staged tables of earlier calls, or those between two counts
    of them; their readers must be done."""
    gone = _staged[first:end]
    del _staged[first:end]
    for name in gone:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    free_shuffles(spark)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing holds any more,
    such as those of a table just staged.  It learns of them only when the
    driver's JVM collects garbage, which with few tasks can take as long as
    ``spark.cleaner.periodicGC.interval``."""
    gc.collect()
    spark._jvm.System.gc()


def share(spark: SparkSession, value) -> Callable[[], object]:
    """Broadcasts ``value``; the returned function gives it inside tasks.  A
    plain broadcast names the classes of this package, so executors would need
    a copy of it; here they travel with the value."""
    held = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(held.value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, **cols) -> DataFrame:
    """The named columns alone (``new="old"`` or a Column), so that further
    columns of the input can't clash with those an operator adds."""
    return df.select(*[(df[c] if isinstance(c, str) else c).alias(k) for k, c in cols.items()])


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser over uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def random_words(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random uint64 (the same in every Python process)."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def text_chunks(texts: pa.Array, chunk: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, UTF-8 bytes, byte offsets) of runs of
    rows with about ``chunk`` bytes; a longer text is a run of its own.  Null
    texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offs, data = texts.buffers()
    offs = np.frombuffer(offs, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + chunk, "right")) - 1)
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A") : ord("Z") + 1] += 32

_TABLE = random_words(256, 11)[FOLD]
_R = 0x9E3779B97F4A7C55  # odd, so it has an inverse modulo 2**64
_RI = pow(_R, -1, 1 << 64)


class _Powers(dict):
    """A process's own table of powers.  Functions travel with their globals;
    this one goes empty, as it would add up to 67 MB to each job."""

    def __reduce__(self):
        return _Powers, ()


_powers: dict[int, np.ndarray] = _Powers()


def _power(base: int, n: int) -> np.ndarray:
    if len(_powers.get(base, ())) < n:
        out = np.ones(max(n, CHUNK_BYTES * 2), np.uint64)
        out[1:] = base
        _powers[base] = np.multiply.accumulate(out)
    return _powers[base][:n]


def words(data: np.ndarray, offs: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, 64-bit hashes) of the words of the texts between
    ``offs``.  ``apart`` marks separator bytes; ASCII case is folded in the
    hash.  Long runs are taken in pieces that end at separators."""
    starts, ends, hashes = [], [], []
    lo, n = 0, len(data)
    while lo < n:
        hi = min(n, lo + CHUNK_BYTES)
        while hi < n:
            gaps = np.flatnonzero(apart[data[lo:hi]])
            if len(gaps):
                hi = lo + int(gaps[-1]) + 1
                break
            hi = min(n, hi + CHUNK_BYTES)
        part = data[lo:hi]
        inside = ~apart[part]
        cuts = offs[(offs > lo) & (offs < hi)] - lo
        before = np.concatenate(([False], inside[:-1]))
        before[cuts] = False
        after = np.concatenate((inside[1:], [False]))
        after[cuts - 1] = False
        s, e = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_TABLE[part] * _power(_R, len(part)), out=sums[1:])
        hashes.append(mix64((sums[e] - sums[s]) * _power(_RI, len(part))[s] + (e - s).astype(np.uint64)))
        starts.append(s + lo)
        ends.append(e + lo)
        lo = hi
    if not starts:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)


def scalar(df: DataFrame, column) -> object:
    """One aggregate value of a table."""
    return df.agg(column.alias("v")).first()["v"]


def crc_mod(doc_id, n: int):
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))
