"""Exact URL lists by a cascade of Bloom filters.

Keys are a host and a path prefix.  Level 1 encodes the listed keys; level 2
those unlisted keys of the corpus that level 1 lets through by mistake; level
3 the listed keys that level 2 lets through; and so on, until no mistake is
left among the corpus's keys.  The first level that lacks a key decides: an
odd one says unlisted, an even one listed.  So every key of the corpus is told
apart exactly, without a join.

The first level's rate is so low that the mistakes are about as many as the
listed keys, so all levels together stay in proportion to the list, whatever
the corpus.  Each level is checked to be below ``MAX_BITS``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from islet.llm.common import mix64, share, stage

MAX_BITS = 1 << 33  # 1 GB a level: a list of some 10**9 keys


@dataclass
class Level:
    bits: np.ndarray  # uint8, eight bits each
    size: int
    hashes: int
    seed: int

    def has(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Membership of keys given as two 64-bit hashes."""
        a, b = mix64(a ^ np.uint64(self.seed)), mix64(b ^ np.uint64(self.seed)) | np.uint64(1)
        out = np.ones(len(a), bool)
        for i in range(self.hashes):
            at = (a + np.uint64(i) * b) % np.uint64(self.size)
            out &= (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out

    def positions(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        a, b = mix64(a ^ np.uint64(self.seed)), mix64(b ^ np.uint64(self.seed)) | np.uint64(1)
        return np.concatenate([(a + np.uint64(i) * b) % np.uint64(self.size) for i in range(self.hashes)])


@dataclass
class Cascade:
    levels: list[Level] = field(default_factory=list)

    def has(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out, open_ = np.zeros(len(a), bool), np.ones(len(a), bool)
        for i, level in enumerate(self.levels):
            passed = level.has(a, b)
            out[open_ & ~passed] = i % 2 == 1
            open_ &= passed
        out[open_] = len(self.levels) % 2 == 1
        return out


def hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("a"), F.xxhash64(key, F.lit(1)).alias("b")]


def _uint(batch, name: str) -> np.ndarray:
    return batch[name].to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _level(keys: DataFrame, n: int, rate: float, seed: int) -> Level:
    """A filter of the n keys(a, b), its bits set on the executors."""
    k = max(1, round(-np.log2(rate)))
    size = int(max(64, np.ceil(n * k / np.log(2))))
    if size > MAX_BITS:
        raise ValueError(f"a level of {size} bits passes MAX_BITS")
    shape = Level(np.zeros(0, np.uint8), size, k, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(shape.positions(_uint(batch, "a"), _uint(batch, "b")))
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(3)).astype(np.int64)), pa.array((1 << (at & np.uint64(7)).astype(np.int64)))], names=["byte", "bit"])

    got = keys.select("a", "b").mapInArrow(run, "byte long, bit long").groupBy("byte").agg(F.bit_or("bit").cast("int").alias("bits")).toPandas()
    bits = np.zeros(size // 8 + 1, np.uint8)
    bits[got["byte"].to_numpy(np.int64)] = got["bits"].to_numpy(np.uint8)
    return Level(bits, size, k, seed)


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    shared = share(keys.sparkSession, level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared()
        for batch in batches:
            yield batch.filter(pa.array(own.has(_uint(batch, "a"), _uint(batch, "b"))))

    return keys.mapInArrow(run, keys.schema)


def build(listed: DataFrame, universe: DataFrame) -> Cascade:
    """The cascade that tells listed(key) from all other keys of
    universe(key).  Null keys and repeats count as nothing; no listed key
    gives a cascade without levels, which holds nothing."""
    listed = stage(listed.select(F.col("key").cast("string").alias("key")).filter("key is not null").distinct().select(*hashes(F.col("key"))), "listed")
    rest = universe.select(F.col("key").cast("string").alias("key")).filter("key is not null").distinct().select(*hashes(F.col("key")))
    n, out = listed.count(), Cascade()
    if not n:
        return out
    rest = stage(rest.join(listed, ["a", "b"], "left_anti"), "universe")  # the list's keys, as the filter sees them
    m = rest.count()
    sides, counts = [listed, rest], [n, m]
    while counts[0]:
        i = len(out.levels)
        rate = min(0.5, max(1e-9, counts[0] / max(counts[1], 1) * 0.7)) if i == 0 else 0.5
        level = _level(sides[0], counts[0], rate, 0x5EED + 7919 * i)
        out.levels.append(level)
        wrong = stage(_passing(sides[1], level), "wrong")
        sides, counts = [wrong, sides[0]], [wrong.count(), counts[0]]
    return out


# ------------------------------------------------------------------ URLs

def host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end; A-Z lower-cased.  Empty
    for a null url and one without ://."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), upper, lower)


def path(url: Column) -> Column:
    """What follows the host, up to ? or #."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def candidates(host_: Column, path_: Column, lengths: list[int]) -> Column:
    """All (host or domain above) + (path prefix of one of the lengths)."""
    labels = F.split(host_, r"\.")
    n = F.size(labels)
    domains = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n - i + 1), "."))
    prefixes = F.filter(F.array(*[F.when(F.length(path_) >= k, F.substring(path_, 1, k)) for k in lengths]), lambda p: p.isNotNull())
    both = F.flatten(F.transform(domains, lambda d: F.transform(prefixes, lambda p: F.struct(F.concat(d, p).alias("key"), F.lit(0).alias("x")))))
    return F.when(host_ == "", F.array()).otherwise(F.transform(both, lambda s: s["key"]))


def judge(urls: DataFrame, rules: list[tuple[str, str, str]], url: str = "url") -> DataFrame:
    """urls -> (row, host, path, rule, verdict) by rules (verdict, host, path).

    A rule fits its host and all subdomains where the url's path starts with
    the rule's; the longest (host and path together) wins, a later one among
    equals.  ``rule`` is host + path, null if none fits; such urls are allowed,
    as they are on no list.  ``row`` is a struct of all columns of urls.

    Each verdict's rules are one list with a cascade of its own, over every
    host and path prefix that occurs in the urls.
    """
    lengths = sorted({len(p) for _, _, p in rules})
    spark = urls.sparkSession
    rows = urls.select(F.struct("*").alias("row"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    rows = rows.withColumn("keys", candidates(F.col("host"), F.col("path"), lengths) if lengths else F.expr("cast(array() as array<string>)"))
    universe = rows.select("host", "path").distinct().select(F.explode(candidates(F.col("host"), F.col("path"), lengths)).alias("key")) if lengths else rows.select(F.lit(None).cast("string").alias("key")).limit(0)
    universe = stage(universe.distinct(), "keys")
    chosen = {h.lower() + p: verdict for verdict, h, p in rules}
    built = [(v, build(spark.createDataFrame([(k,) for k, x in chosen.items() if x == v], "key string"), universe)) for v in sorted(set(chosen.values()))]
    shared = share(spark, built)
    rows = rows.withColumn("a", F.transform("keys", lambda k: F.xxhash64(k))).withColumn("b", F.transform("keys", lambda k: F.xxhash64(k, F.lit(1))))
    out = rows.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit("")).select("row", "host", "path", "rule", "verdict")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = shared()
        for batch in batches:
            keys = batch["keys"].flatten()
            n = batch["keys"].value_lengths().to_numpy(zero_copy_only=False)
            of = np.repeat(np.arange(batch.num_rows), n)
            a, b = (batch[c].flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for c in "ab")
            rule, verdict, best = [None] * batch.num_rows, ["allow"] * batch.num_rows, np.zeros(batch.num_rows, np.int64) - 1
            for v, cascade in lists:
                for i in np.flatnonzero(cascade.has(a, b)):
                    key = keys[i].as_py()
                    if len(key) > best[of[i]]:
                        best[of[i]], rule[of[i]], verdict[of[i]] = len(key), key, v
            yield pa.RecordBatch.from_arrays([batch["row"], batch["host"], batch["path"], pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names=["row", "host", "path", "rule", "verdict"])

    return rows.select("row", "host", "path", "keys", "a", "b").mapInArrow(run, out.schema)
