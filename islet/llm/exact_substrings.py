"""Suffix-array dedup of long byte strings, exact over the whole corpus.

1. ``segments``: the smallest hash among a window's ``GRAM``-byte grams is its
   label.  Equal windows have equal labels wherever they stand, so all places
   of a repeated string meet under one label.  Runs of windows with one gram
   for label are segments: a few hundred bytes, at every hundred bytes or so.
   No string of ``WINDOW`` bytes stands in one segment twice.
2. Only labels that occur again can hold repeats.  Of their segments, equal
   ones become a class with a count; texts leave for the shards once a class.
3. All windows of a class with a count of two are repeated.  The labels that
   also have a class with a count of one go to shards, sets of whole labels of
   about ``SHARD_BYTES``.  A shard's suffix array (``induced``) and permuted
   common prefixes show which windows stand in it twice.
4. A label with more bytes than ``HOT_BYTES`` would outgrow a shard; the digests
   of its single windows are counted instead, which tells the same.
5. The windows found go back to all places of their class, and their union is
   cut from the texts.

``summary`` does this twice: in all documents for strings of ``PASSAGE`` bytes,
then for strings of ``WINDOW`` bytes in the runs that the first ones cover.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from islet.llm.common import WHITE, drop_staged, mix64, random_words, stage, staged_count, text_chunks
from islet.llm.induced import permuted_prefixes, suffix_array

WINDOW, GRAM = 400, 64
#: A passage is a run of bytes, all of it in strings of so many bytes that stand
#: anywhere else, that holds so many words.
PASSAGE, PASSAGE_WORDS = 200, 51
SHARD_BYTES, HOT_BYTES = 2 << 20, 4 << 20
CHUNK = 1 << 19

_T = random_words(256, 77)
_MULTIPLY = random_words(8, 78) | np.uint64(1)


def labels(data: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of the gram with the smallest hash, the first of several, for
    each start of ``window`` bytes; hashes of all grams).  The order is by the
    hash's high bits, so that the place fits below them."""
    def stretch(x, to, join):
        size = 1
        while size * 2 <= to:
            x = join(x[:-size], x[size:], size)
            size *= 2
        return join(x[: len(x) - (to - size)], x[to - size :], to - size) if to > size else x

    h = _T[data]
    size, i = 1, 0
    while size < gram:  # gram is a power of two
        h = h[:-size] * _MULTIPLY[i] + h[size:]
        size, i = size * 2, i + 1
    h = mix64(h)
    bits = np.uint64(len(h).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    return (stretch(key, window - gram + 1, lambda a, b, _: np.minimum(a, b)) & low).astype(np.int64), h


def segments(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """docs(doc_id, text_key, text) -> (doc_id, text_key, parts): parts are
    arrays (label, digest, start, n) of the text's segments of n windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in text_chunks(batch["text"], CHUNK):
                size = np.diff(offs)
                cols = {c: [None] * (hi - lo) for c in ("label", "digest", "start", "n")}
                if (size >= window).any():
                    v, h = labels(data, window, gram)
                    ok = np.zeros(len(data), bool)
                    for s, e in zip(offs[:-1][size >= window], offs[1:][size >= window]):
                        ok[s : e - window + 1] = True
                    at = np.flatnonzero(ok[: len(v)])
                    new = np.ones(len(at), bool)
                    new[1:] = (at[1:] != at[:-1] + 1) | (v[at[1:]] != v[at[:-1]])
                    first = np.flatnonzero(new)
                    count = np.diff(np.concatenate((first, [len(at)])))
                    start, lab = at[first], h[v[at[first]]]
                    raw = memoryview(data)
                    digest = np.array([xxhash.xxh3_64_intdigest(raw[s : s + n + window - 1]) for s, n in zip(start.tolist(), count.tolist())], np.uint64).view(np.int64)
                    own = np.searchsorted(start, offs)
                    for d in np.flatnonzero(size >= window):
                        s = slice(own[d], own[d + 1])
                        for c, x in (("label", lab.view(np.int64)), ("digest", digest), ("start", start - offs[d]), ("n", count)):
                            cols[c][d] = x[s]
                yield pa.RecordBatch.from_arrays([batch["doc_id"][lo:hi], batch["text_key"][lo:hi]] + [pa.array(cols[c], pa.list_(pa.int64())) for c in cols], names=["doc_id", "text_key", *cols])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text_key", "text").mapInArrow(run, f"doc_id {kind}, text_key long, label array<long>, digest array<long>, start array<long>, n array<long>")


def _spans(flags: np.ndarray, window: int) -> list[int]:
    """Covered bytes, [start, end) flat, of the flagged window starts."""
    at = np.flatnonzero(flags)
    if not len(at):
        return []
    new = np.concatenate(([True], at[1:] > at[:-1] + window))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(at)])) - 1
    return np.stack((at[first], at[last] + window), 1).ravel().tolist()


def repeated(texts: list[bytes], counts: list[int], window: int) -> list[np.ndarray]:
    """For each segment of a shard, which of its windows stand in the shard
    twice (or in a segment with a count of two)."""
    size = np.array([len(t) for t in texts])
    starts = np.concatenate(([0], np.cumsum(size + 1)))
    s = np.zeros(starts[-1] + 1, np.uint16)
    for a, t in zip(starts, texts):
        s[a : a + len(t)] = np.frombuffer(t, np.uint8)
        s[a : a + len(t)] += 2
        s[a + len(t)] = 1
    sa = suffix_array(s)
    prefix = permuted_prefixes(s, sa)
    owner = np.repeat(np.arange(len(texts) + 1), np.concatenate((size + 1, [1])))
    left = np.zeros(len(s), np.int64)  # bytes up to the end of the segment
    left[: starts[-1]] = np.repeat(starts[1:] - 1, size + 1) - np.arange(starts[-1])
    group = np.cumsum(prefix[sa] < window)
    whole = left[sa] >= window
    place, group = sa[whole], group[whole]
    weight = np.concatenate((np.minimum(counts, 2), [0]))[owner[place]]
    twice = np.bincount(group, weight) >= 2 if len(group) else np.zeros(0, bool)
    flags = np.zeros(len(s), bool)
    flags[place] = twice[group] if len(group) else False
    return [flags[a : a + max(n - window + 1, 0)] for a, n in zip(starts, size)]


def _settled(gone: np.ndarray, data: np.ndarray, min_words: int) -> np.ndarray:
    """Removed bytes, less code points cut in half and runs of fewer words."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
    out = np.zeros_like(gone)
    for a, b in edge.reshape(-1, 2).tolist():
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while a < b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        inside = ~WHITE[data[a:b]]
        if int(inside[:1].sum()) + int((inside[1:] & ~inside[:-1]).sum()) >= min_words:
            out[a:b] = True
    return out


def repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_bytes: int = SHARD_BYTES, hot_bytes: int = HOT_BYTES) -> tuple[DataFrame, DataFrame]:
    """docs(doc_id, text, ..) -> texts(doc_id, text_key, text) that can hold
    repeated strings, and spans(c_id, c_key, spans) of those that do: the bytes
    that the strings cover, [start, end) flat, in any order and overlapping.
    ``text`` may be bytes.

    A byte is covered if a string of ``window`` bytes with it also starts
    elsewhere, in any row.  Null, empty and shorter texts have none.  Rows that
    repeat id and text have one row of spans.
    """
    docs = docs.select("doc_id", F.col("text"), F.xxhash64("text").alias("text_key"))
    cut = stage(segments(docs, window, gram), "segments")
    each = cut.select("doc_id", "text_key", F.explode(F.arrays_zip("label", "digest", "start", "n")).alias("p")).select("doc_id", "text_key", "p.*")
    again = each.groupBy("label").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("label").hint("rebalance")  # so the join's sides are plain shuffles, which AQE splits
    places = stage(each.join(again, "label"), "places")
    classes = places.groupBy("label", "digest").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("doc_id", "text_key", "start")).alias("first"), F.first("n").alias("n"))
    classes = stage(classes, "classes")
    length = F.sum(F.col("n") + F.lit(window - 1))
    # labels whose classes all have copies, or that have one class, are settled by the counts
    open_ = (F.count(F.lit(1)) > 1) & (F.min("times") == 1)
    load = classes.groupBy("label").agg(length.alias("bytes"), open_.alias("open")).filter("open").drop("open")
    load = stage(load, "load")
    total = load.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    shards = int(total // shard_bytes) + 1
    mine = classes.join(load, "label").select(
        F.col("first.doc_id").alias("c_id"), F.col("first.text_key").alias("c_key"),
        F.struct(F.col("first.start").alias("start"), "n", "label", "digest", "times", (F.col("bytes") > hot_bytes).alias("hot")).alias("c"),
    ).groupBy("c_id", "c_key").agg(F.collect_list("c").alias("classes"))  # a text's own segments

    # the texts that hold candidates: all that may lose bytes
    held = places.select(F.col("doc_id").alias("c_id"), F.col("text_key").alias("c_key")).distinct()
    texts = stage(docs.join(held, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("text_key") == F.col("c_key")), "left_semi"), "texts")
    sent = texts.join(mine, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("text_key") == F.col("c_key"))).select("text", "classes")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in text_chunks(batch["text"], 4 * CHUNK):
                raw, rows = memoryview(data), []
                for o, own in zip(offs.tolist(), batch["classes"][lo:hi].to_pylist()):
                    for c in own:
                        s, n = o + c["start"], c["n"]
                        windows = [xxhash.xxh3_64_intdigest(raw[i : i + window]) - (1 << 63) for i in range(s, s + n)] if c["hot"] else None
                        rows.append((c["label"], c["digest"], c["times"], None if c["hot"] else bytes(raw[s : s + n + window - 1]), windows))
                names = ["label", "digest", "times", "bytes", "windows"]
                types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    out = stage(sent.mapInArrow(send, "label long, digest long, times long, bytes binary, windows array<long>").dropDuplicates(["label", "digest"]), "sent")

    def in_shard(_, frame):
        import pandas as pd

        flags = repeated(frame["bytes"].tolist(), frame["times"].to_numpy(), window)
        spans = [_spans(f, window) for f in flags]
        return pd.DataFrame({"label": frame["label"], "digest": frame["digest"], "spans": spans})[[bool(x) and n == 1 for x, n in zip(spans, frame["times"])]]

    kind = "label long, digest long, spans array<long>"
    found = out.filter("bytes is not null").withColumn("shard", F.pmod(F.xxhash64("label"), F.lit(shards))).groupBy("shard").applyInPandas(in_shard, kind)
    if load.filter(F.col("bytes") > hot_bytes).head(1):
        found = found.union(_by_windows(out.filter("windows is not null"), window))
    copied = classes.filter("times > 1").select("label", "digest", F.array(F.lit(0).cast("long"), F.col("n") + F.lit(window - 1).cast("long")).alias("spans"))
    found = stage(found.union(copied), "found")

    at = places.select("label", "digest", F.col("doc_id").alias("c_id"), F.col("text_key").alias("c_key"), "start")
    spans = at.join(found, ["label", "digest"]).select("c_id", "c_key", F.transform("spans", lambda x: x + F.col("start")).alias("spans")).groupBy("c_id", "c_key").agg(F.flatten(F.collect_list("spans")).alias("spans"))

    return texts, spans


def _with_spans(texts: DataFrame, spans: DataFrame) -> DataFrame:
    return texts.join(spans, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("text_key") == F.col("c_key"))).drop("c_id", "c_key")


def _covered(texts: pa.Array, spans: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, which of them the spans cover) of each text."""
    for lo, hi, data, offs in text_chunks(texts, 4 * CHUNK):
        for s, e, x in zip(offs[:-1], offs[1:], spans[lo:hi].to_pylist()):
            keep = np.zeros(e - s + 1, np.int64)
            np.add.at(keep, x[0::2], 1)
            np.add.at(keep, x[1::2], -1)
            yield data[s:e], np.cumsum(keep[:-1]) > 0


def _runs(gone: np.ndarray) -> np.ndarray:
    """[start, end) of each run of flagged bytes."""
    return np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8))).reshape(-1, 2)


def _cut(losing: DataFrame, min_words: int | None = None) -> DataFrame:
    """(doc_id, text_key, text, spans, ..) -> (doc_id, text_key, kept,
    n_removed, n_spans)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, gone, runs = [], [], []
            for own, out in _covered(batch["text"], batch["spans"]):
                if min_words is not None:
                    out = _settled(out, own, min_words)
                kept.append(own[~out].tobytes())
                gone.append(int(out.sum()))
                runs.append(len(_runs(out)))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text_key"], pa.array(kept, pa.binary()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64())], names=["doc_id", "text_key", "kept", "n_removed", "n_spans"])

    id_kind = losing.schema["doc_id"].dataType.simpleString()
    return losing.select("doc_id", "text_key", "text", "spans").mapInArrow(run, f"doc_id {id_kind}, text_key long, kept binary, n_removed long, n_spans long")


def removals(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_bytes: int = SHARD_BYTES, hot_bytes: int = HOT_BYTES, min_words: int | None = None) -> DataFrame:
    """docs(doc_id, text, ..) -> (doc_id, text_key, kept, n_removed, n_spans)
    of the texts that lose bytes: ``kept`` is what stays, as bytes.  With
    ``min_words`` runs of fewer words stay, and runs end at whole code points.

    A byte goes if a string of ``window`` bytes that covers it also starts
    elsewhere, in any row; strings are judged on the input.  Null, empty and
    shorter texts lose nothing.  Rows that repeat id and text are one row here.
    """
    return _cut(_with_spans(*repeats(docs, window, gram, shard_bytes, hot_bytes)), min_words)


def passages(docs: DataFrame, window: int = PASSAGE, min_words: int = PASSAGE_WORDS, long: int = WINDOW) -> DataFrame:
    """docs(doc_id, text, ..) -> (doc_id, text_key, n_passages,
    n_passage_bytes, runs, text) of the texts with repeated strings of
    ``window`` bytes: passages are what ``removals`` with ``min_words`` cuts.
    ``runs`` are the covered runs, of however few words, of ``long`` bytes or
    more, [start, end) flat; without any the text is null."""
    found = _with_spans(*repeats(docs, window))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, size, wide = [], [], []
            for own, out in _covered(batch["text"], batch["spans"]):
                runs = _runs(out)
                wide.append(runs[np.diff(runs).ravel() >= long].ravel())
                runs = _runs(_settled(out, own, min_words))
                n.append(len(runs))
                size.append(int(np.diff(runs).sum()))
            text = pc.if_else(pa.array([len(x) > 0 for x in wide], pa.bool_()), batch["text"], pa.scalar(None, batch["text"].type))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text_key"], pa.array(n, pa.int64()), pa.array(size, pa.int64()), pa.array(wide, pa.list_(pa.int64())), text], names=["doc_id", "text_key", "n_passages", "n_passage_bytes", "runs", "text"])

    id_kind = found.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(count, f"doc_id {id_kind}, text_key long, n_passages long, n_passage_bytes long, runs array<long>, text string")


def _pieces(found: DataFrame) -> DataFrame:
    """(doc_id, text_key, text, runs, ..) -> the runs as texts of their own:
    doc_id(doc_id, text_key, start), text (bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in text_chunks(batch["text"], 4 * CHUNK):
                row, start, own = [], [], []
                for i, o, x in zip(range(lo, hi), offs.tolist(), batch["runs"][lo:hi].to_pylist()):
                    for a, b in zip(x[0::2], x[1::2]):
                        row.append(i)
                        start.append(a)
                        own.append(data[o + a : o + b].tobytes())
                at = pa.array(row, pa.int64())
                key = pa.StructArray.from_arrays([batch["doc_id"].take(at), batch["text_key"].take(at), pa.array(start, pa.int64())], names=["doc_id", "text_key", "start"])
                yield pa.RecordBatch.from_arrays([key, pa.array(own, pa.binary())], names=["doc_id", "text"])

    id_kind = found.schema["doc_id"].dataType.simpleString()
    return found.select("doc_id", "text_key", "text", "runs").mapInArrow(run, f"doc_id struct<doc_id: {id_kind}, text_key: long, start: long>, text binary")


def _by_windows(hot: DataFrame, window: int) -> DataFrame:
    """found rows of hot labels, by counting their windows' digests."""
    each = hot.select("label", "digest", "times", F.posexplode("windows").alias("i", "w"))
    twice = each.groupBy("label", "w").agg(F.sum("times").alias("times")).filter("times > 1").select("label", "w")
    flagged = each.filter("times = 1").join(twice, ["label", "w"]).groupBy("label", "digest").agg(F.sort_array(F.collect_list("i")).alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for x in batch["at"]:
                flags = np.zeros(window, bool)  # a segment has at most window - GRAM + 1 windows
                flags[x.values.to_numpy()] = True
                spans.append(_spans(flags, window))
            yield pa.RecordBatch.from_arrays([batch["label"], batch["digest"], pa.array(spans, pa.list_(pa.int64()))], names=["label", "digest", "spans"])

    return flagged.mapInArrow(run, "label long, digest long, spans array<long>")


def summary(docs: DataFrame, window: int = WINDOW, passage: int = PASSAGE, passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """docs(doc_id, text, ..) -> (doc_id, n_bytes, n_removed, n_spans,
    kept_sha256, n_passages, n_passage_bytes), a row for each row.  What is
    removed, and kept, is by strings of ``window`` bytes; passages are counted
    alone, by strings of ``passage`` bytes, of which ``window`` must not have
    fewer."""
    text = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text.cast("binary"), 256).alias("own"))
    before = staged_count()
    found = stage(passages(docs, passage, passage_words, window), "passages")
    drop_staged(docs.sparkSession, before, staged_count() - 1)
    # all shorter strings in a repeated string of window bytes are repeated: it lies in one run, and so does each of its copies
    whole = found.filter("text is not null")
    _, spans = repeats(_pieces(whole), window)
    spans = spans.select("c_id.doc_id", "c_id.text_key", F.transform("spans", lambda x: x + F.col("c_id.start")).alias("spans"))
    spans = spans.groupBy(F.col("doc_id").alias("c_id"), F.col("text_key").alias("c_key")).agg(F.flatten(F.collect_list("spans")).alias("spans"))
    lost = _cut(_with_spans(whole, spans)).select("doc_id", "text_key", F.sha2("kept", 256).alias("kept_sha256"), "n_removed", "n_spans")
    # one row for each id and text, as either table has it or not
    none = F.lit(None).cast("long")
    each = lost.select(F.col("doc_id").alias("l_id"), F.col("text_key").alias("l_key"), "kept_sha256", "n_removed", "n_spans", none.alias("n_passages"), none.alias("n_passage_bytes"))
    each = each.unionByName(found.select(F.col("doc_id").alias("l_id"), F.col("text_key").alias("l_key"), F.lit(None).cast("string").alias("kept_sha256"), none.alias("n_removed"), none.alias("n_spans"), "n_passages", "n_passage_bytes"))
    counts = ["n_removed", "n_spans", "n_passages", "n_passage_bytes"]
    each = each.groupBy("l_id", "l_key").agg(*[F.max(c).alias(c) for c in ["kept_sha256", *counts]])
    both = base.join(each, F.col("doc_id").eqNullSafe(F.col("l_id")) & (F.col("text_key") == F.col("l_key")), "left")
    n = {c: F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts}
    return both.select("doc_id", "n_bytes", n["n_removed"], n["n_spans"], F.coalesce("kept_sha256", "own").alias("kept_sha256"), n["n_passages"], n["n_passage_bytes"])


def deduplicated(docs: DataFrame, window: int = WINDOW, min_words: int = 0) -> DataFrame:
    """docs with repeated strings cut from ``text``, at whole code points, in
    runs of ``min_words`` words or more; other columns stay as they are."""
    lost = removals(docs, window, min_words=min_words).select(F.col("doc_id").alias("l_id"), F.col("text_key").alias("l_key"), "kept").dropDuplicates(["l_id", "l_key"])
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("key"))
    both = rows.join(lost, F.col("row.doc_id").eqNullSafe(F.col("l_id")) & (F.col("key") == F.col("l_key")), "left")
    kept = F.when(F.col("kept").isNull(), F.col("row.text")).otherwise(F.make_valid_utf8(F.col("kept").cast("string")))
    return both.select(*[kept.alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])
