"""MinHash near-dedup by SetSketch registers.

A document's set holds its distinct five-word shingles as 64-bit hashes.
Register i keeps the smallest of the set's exponential variates under hash
function i, on an exponential scale: floor(1 - log_b(min)), truncated to
[0, q + 1].  Registers of a union are the larger of the two, so sketches
merge; equal registers make them locality-sensitive.

1. ``sketch``: one pass over the texts.  Equal sets become one class.
2. Bands of register values deal classes into buckets.  In each bucket every
   class is paired with the bucket's smallest one (its pivot).
3. A joint likelihood over the registers, given both set sizes, drops hopeless
   pairs; the others are confirmed on their full sets.
4. Classes that share a bucket but are not yet in one component are compared
   there, block against block, by the same likelihood and then by full sets.
   So a link that no pivot shows is still found.

No step emits all pairs of a bucket: step 2 has a pair per row and band, and
step 4 only confirms pairs that would join two components.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from islet.llm.common import WHITE, free_shuffles, mix64, random_words, stage, text_chunks, words
from islet.llm.components import components

SHINGLE = 5
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 2  # SetSketch's b, a and q
ROWS, BANDS = 4, 40
REGISTERS = ROWS * BANDS
#: A pair at the threshold differs from its estimate by this much with a
#: probability under 1e-6 (REGISTERS Bernoulli trials).
MARGIN = 0.17
#: Classes, and bytes of their full sets, of a block in step 4.
BLOCK, BLOCK_BYTES = 4096, 32 << 20

_C = random_words(SHINGLE, 5) | np.uint64(1)
_A = (random_words(REGISTERS, 101) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_B = (random_words(REGISTERS, 202) >> np.uint64(32)).astype(np.uint32)


def shingles(data: np.ndarray, offs: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of consecutive texts, repeats included, and the bounds
    of each text's.  A text of fewer than k words has its whole sequence."""
    starts, _, h = words(data, offs, WHITE)
    n = np.diff(np.searchsorted(starts, offs))
    first = np.concatenate(([0], np.cumsum(n)))
    count = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    bounds = np.concatenate(([0], np.cumsum(count)))
    padded = np.concatenate((h, np.zeros(k, np.uint64)))
    at = np.arange(bounds[-1]) + np.repeat(first[:-1] - bounds[:-1], count)
    left = np.minimum(np.repeat(first[1:], count) - at, k)
    out = left.astype(np.uint64)
    for i in range(k):
        out += np.where(left > i, padded[at + i] * _C[i], np.uint64(0)) if (n < k).any() else padded[at + i] * _C[i]
    return mix64(out), bounds


def registers(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """uint16 registers, a row for each non-empty set."""
    full = np.flatnonzero(np.diff(bounds))
    out = np.empty((len(full), REGISTERS), np.uint16)
    if not len(full):
        return out
    x, at = (hashes >> np.uint64(32)).astype(np.uint32), bounds[full]
    low = np.empty((REGISTERS, len(full)), np.uint32)
    step = 1 << 16
    v = np.empty(len(x), np.uint32)
    for i in range(REGISTERS):
        for lo in range(0, len(x), step):
            np.multiply(x[lo : lo + step], _A[i], out=v[lo : lo + step])
            v[lo : lo + step] += _B[i]
        low[i] = np.minimum.reduceat(v, at)
    exponential = -np.log1p(-(low.T.astype(np.float64) + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP + 1).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def joint_estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Likeliest Jaccard similarity of pairs of register rows (uint16), given
    the set sizes: registers above, below and equal are a trinomial."""
    above, below = (a > b).sum(-1), (a < b).sum(-1)
    equal = a.shape[-1] - above - below
    u, v = na / (na + nb), nb / (na + nb)

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j):
        up, down = p(u - v * j), p(v - u * j)
        tiny = 1e-12
        return above * np.log(up + tiny) + below * np.log(down + tiny) + equal * np.log(np.maximum(1 - up - down, tiny))

    lo, hi = np.zeros(u.shape), np.minimum(u / v, v / u)
    for _ in range(24):  # the likelihood has one peak
        left, right = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        better = likelihood(left) < likelihood(right)
        lo, hi = np.where(better, left, lo), np.where(better, hi, right)
    return (lo + hi) / 2


def sketch(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, text_key, n_shingles, node, registers).

    ``node`` names the class of equal sets (64 bits of a digest of the sorted
    hashes; null for an empty set), ``text_key`` hashes the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in text_chunks(batch["text"]):
                h, bounds = shingles(data, offs)
                rows = iter(registers(h, bounds))
                n, node, regs = [], [], []
                for s, e in zip(bounds[:-1], bounds[1:]):
                    own = np.unique(h[s:e])
                    n.append(len(own))
                    node.append(int.from_bytes(blake2b(own.tobytes(), digest_size=8).digest(), "big", signed=True) if e > s else None)
                    regs.append(next(rows).tobytes() if e > s else None)
                yield pa.RecordBatch.from_arrays([batch["doc_id"][lo:hi], batch["text_key"][lo:hi], pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(regs, pa.binary())], names=["doc_id", "text_key", "n_shingles", "node", "registers"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(run, f"doc_id {kind}, text_key long, n_shingles long, node long, registers binary")


def band_rows(classes: DataFrame) -> DataFrame:
    """classes(node, registers, ..) -> (key, node): a row for each band."""
    width = 2 * ROWS
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(F.col("registers").substr(b * width + 1, F.lit(width)), b))
    return classes.select("node", F.explode(keys).alias("key"))


def linked(a: np.ndarray, b: np.ndarray, threshold: int = 75) -> bool:
    """100 * intersection >= threshold * union of two sorted sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= threshold * (len(a) + len(b) - both)


def _hopeful(ra, rb, na, nb, threshold: int) -> np.ndarray:
    """Pairs (rows of both) that full sets may confirm."""
    fits = (100 * na >= threshold * nb) & (100 * nb >= threshold * na)
    fits[fits] = joint_estimate(ra[fits], rb[fits], na[fits], nb[fits]) >= threshold / 100 - MARGIN
    return fits


def _sets(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(node, n, registers, shingles) of members(doc_id, text_key, ..): their
    texts, found by id and hash, as sorted sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in text_chunks(batch["text"]):
                h, bounds = shingles(data, offs)
                own = [np.unique(h[s:e]).tobytes() for s, e in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays([batch[c][lo:hi] for c in ("node", "n", "registers")] + [pa.array(own, pa.binary())], names=["node", "n", "registers", "shingles"])

    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    m = members.select(F.col("doc_id").alias("m_id"), F.col("text_key").alias("m_key"), "node", "n", "registers")
    found = texts.join(m, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("text_key") == F.col("m_key")))
    return found.select("node", "n", "registers", "text").mapInArrow(run, "node long, n long, registers binary, shingles binary").dropDuplicates(["node"])


def _confirm(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs(a, b) of classes that are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            get = {c: batch[c].to_numpy(zero_copy_only=False) for c in batch.schema.names}
            ra, rb = (np.frombuffer(b"".join(get[c]), np.uint16).reshape(-1, REGISTERS) for c in ("a_registers", "b_registers"))
            keep = [i for i in np.flatnonzero(_hopeful(ra, rb, get["a_n"], get["b_n"], threshold)) if linked(np.frombuffer(get["a_shingles"][i], np.uint64), np.frombuffer(get["b_shingles"][i], np.uint64), threshold)]
            yield pa.RecordBatch.from_arrays([pa.array(get[c][keep], pa.int64()) for c in "ab"], names=["a", "b"])

    for side in "ab":
        own = sets.select(F.col("node").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in ("n", "registers", "shingles")])
        pairs = pairs.join(own, side)
    return pairs.mapInArrow(run, "a long, b long")


def _rest(rows: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Links between the components of a bucket.

    rows(key, node, component, blocks) of buckets that hold several
    components.  A bucket is cut into ``blocks`` by hash, as many as its classes
    and the bytes of their sets ask for; each pair of blocks is one group, so
    no task holds more than two blocks.
    """

    def run(_, frame):
        import pandas as pd

        frame = frame.sort_values("n", kind="stable", ignore_index=True)
        regs = np.frombuffer(b"".join(frame.registers), np.uint16).reshape(-1, REGISTERS)
        n, comp, block = frame.n.to_numpy(), frame.component.to_numpy().copy(), frame.block.to_numpy()
        i, j = frame.i[0], frame.j[0]
        own = [np.frombuffer(x, np.uint64) for x in frame.shingles]
        found = []
        for x in range(len(frame)):
            if i != j and block[x] != i:
                continue
            lo = x + 1 if i == j else np.searchsorted(n, -(-threshold * n[x] // 100))
            hi = np.searchsorted(n, 100 * n[x] // threshold, "right")
            others = np.arange(lo, hi)
            others = others[(comp[others] != comp[x]) & ((block[others] == j) | (i == j))]
            others = others[(regs[others] == regs[x]).mean(1) >= threshold / 100 - MARGIN]
            for y in others:
                if comp[y] != comp[x] and linked(own[x], own[y], threshold):
                    found.append((frame.node[x], frame.node[y]))
                    comp[comp == comp[y]] = comp[x]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    rows = rows.join(sets, "node").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    pairs = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other", "blocks")
    return pairs.groupBy("key", "i", "j").applyInPandas(run, "a long, b long")


def near_dedup(docs: DataFrame, threshold: int = 75) -> DataFrame:
    """docs(doc_id, text, ..) -> (doc_id, text_key, n_shingles, component_id,
    kept), a row for each row; text_key is a hash of the text.

    Documents whose sets share at least ``threshold`` percent of their union
    are linked; component_id is the smallest doc_id that links reach.  Null
    and empty texts, and texts without words, have an empty set and stand
    alone.  Rows that repeat a doc_id stay apart; of a group without any
    doc_id the component_id is null, and a null doc_id is never kept unless
    it stands in such a group.  Other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    sk = stage(sketch(docs), "sketches")
    classes = stage(sk.filter("node is not null").groupBy("node").agg(F.min(F.struct("doc_id", "text_key")).alias("first"), F.min("doc_id").alias("low_id"), F.first("n_shingles").alias("n"), F.first("registers").alias("registers")).select("node", "first.*", "low_id", "n", "registers"), "classes")
    bands = band_rows(classes)
    shared = bands.groupBy("key").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("size")).filter("size > 1").hint("rebalance")  # the join's sides are plain shuffles, which AQE splits
    rows = stage(bands.join(shared, "key"), "buckets")
    members = classes.join(rows.select("node").distinct(), "node", "left_semi")
    sets = stage(_sets(docs, members), "sets")
    free_shuffles(docs.sparkSession)
    links = stage(_confirm(rows.filter("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct(), sets, threshold), "confirmed")
    free_shuffles(docs.sparkSession)
    first = stage(components(links), "components")

    placed = rows.filter("size > 2").join(first, rows["node"] == first["id"], "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("size"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("mark")).filter("lo <> hi")
    mixed = mixed.groupBy("size", "mark").agg(F.min("key").alias("key"))  # equal buckets once
    mixed = stage(placed.join(mixed.select("key"), "key"), "mixed")
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") * 8 / BLOCK_BYTES)).cast("int")
    cut = mixed.join(classes.select("node", "n"), "node").groupBy("key").agg(blocks.alias("blocks"))
    more = stage(_rest(mixed.join(cut, "key"), sets, threshold), "rest")
    free_shuffles(docs.sparkSession)
    final = components(links.union(more)) if more.head(1) else first

    at = classes.select("node", "low_id").join(final, F.col("node") == F.col("id"), "left").select("node", "low_id", F.coalesce("component", "node").alias("component"))
    low = at.groupBy("component").agg(F.min("low_id").alias("component_id"))
    at = at.join(low, "component").select("node", "component_id")
    out = sk.select("doc_id", "text_key", "n_shingles", "node").join(at, "node", "left")
    group = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_key", "n_shingles", group.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(docs: DataFrame, threshold: int = 75) -> DataFrame:
    """The rows of docs, all their columns, that near_dedup keeps; of rows that
    repeat an id and its text, one."""
    kept = near_dedup(docs, threshold).filter("kept").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("k_id"), F.col("text_key").alias("k_key")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("k_id"), F.xxhash64("text").alias("k_key"))
    return rows.join(kept, ["k_id", "k_key"]).dropDuplicates(["k_id", "k_key"]).select("row.*")
