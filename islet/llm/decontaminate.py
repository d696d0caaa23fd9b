"""Benchmark decontamination by suffix arrays over the training texts.

Every run of documents (a shard of about ``CHUNK_BYTES``) becomes a word-level
suffix array, ordered by its suffixes' first ``window`` words.  Words that no
benchmark item holds end a suffix, as no match can cross them.  Each test
suffix is then binary-searched in every shard; equal ranges give all places
where it occurs, and places on one diagonal join to the longest verbatim
matches.  The texts are read once and never shuffled.

The benchmark is a stated query set: it is gathered in blocks of at most
``BLOCK_WORDS`` words, and a further block is a further pass over the rows
within the same tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from islet.llm.common import share, text_chunks, words

WINDOW = 10
BLOCK_WORDS = 2_000_000

#: Bytes that end a word; letters, digits and all of non-ASCII make words.
APART = np.ones(256, bool)
APART[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


class Suffixes:
    """The test suffixes of a benchmark block, as searchable keys."""

    def __init__(self, items: list[tuple], window: int):
        texts = pa.array([t or "" for _, t in items], pa.large_string())
        found = [(lo, *words(d, o, APART)[::2], o) for lo, _, d, o in text_chunks(texts, 1 << 60)]
        _, starts, h, offs = found[0] if found else (0, np.zeros(0, int), np.zeros(0, np.uint64), np.zeros(1, int))
        self.window, self.ids = window, [None if i is None else str(i) for i, _ in items]
        self.vocabulary = np.unique(h)
        self.width = max(1, int(62 // np.log2(len(self.vocabulary) + 2)))  # words in a key
        bounds = np.searchsorted(starts, offs)
        names = np.searchsorted(self.vocabulary, h).astype(np.int64) + 1
        rows, owners = [], []
        for i, (s, e) in enumerate(zip(bounds[:-1], bounds[1:])):
            for k in range(s, max(s + 1, e - window + 1) if e > s else s):
                row = np.zeros(window, np.int64)
                row[: min(window, e - k)] = names[k : min(k + window, e)]
                rows.append(row)
                owners.append((i, k - s))
        rows = np.array(rows, np.int64).reshape(-1, window)
        rows, which = np.unique(rows, axis=0, return_inverse=True)
        self.lengths = (rows > 0).sum(1)
        self.low = self.keys(rows)
        self.high = self.keys(np.where(rows > 0, rows, len(self.vocabulary) + 1))
        order = np.argsort(which.ravel(), kind="stable")
        self.owners = np.array(owners, np.int64).reshape(-1, 2)[order]
        self.bounds = np.searchsorted(which.ravel()[order], np.arange(len(rows) + 1))

    def keys(self, rows: np.ndarray) -> np.ndarray:
        """Columns that order rows of words like the words themselves."""
        base = len(self.vocabulary) + 2
        out = []
        for lo in range(0, self.window, self.width):
            key = np.zeros(len(rows), np.int64)
            for k in range(lo, lo + self.width):
                key = key * base + (rows[:, k] if k < self.window else 0)
            out.append(key)
        return np.array(out)

    def shard(self, h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix array (word places) of a shard's words, and its sorted keys."""
        at = np.minimum(np.searchsorted(self.vocabulary, h), max(len(self.vocabulary) - 1, 0))
        known = self.vocabulary[at] == h if len(self.vocabulary) else np.zeros(len(h), bool)
        names = np.where(known, at + 1, 0)
        place = np.flatnonzero(known)
        rows = np.zeros((len(place), self.window), np.int64)
        rows[:, 0] = names[place]
        padded, docs = np.concatenate((names, np.zeros(self.window, np.int64))), np.concatenate((doc, np.full(self.window, -1)))
        for k in range(1, self.window):
            rows[:, k] = np.where((rows[:, k - 1] > 0) & (docs[place + k] == doc[place]), padded[place + k], 0)
        reach = rows[:, : min(self.lengths, default=1)].all(1)  # a shorter suffix matches nothing
        place, keys = place[reach], self.keys(rows[reach])
        order = np.lexsort(keys[::-1])
        return place[order], keys[:, order]

    def search(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each test suffix, its range in the suffix array."""
        out = []
        for wanted, after in ((self.low, False), (self.high, True)):
            lo = np.zeros(wanted.shape[1], np.int64)
            hi = np.full(wanted.shape[1], keys.shape[1], np.int64)
            while (open_ := lo < hi).any():
                mid = (lo + hi) // 2
                at = np.minimum(mid, keys.shape[1] - 1)
                less, same = np.zeros(len(lo), bool), np.ones(len(lo), bool)
                for a, b in zip(keys[:, at], wanted):
                    less |= same & (a < b)
                    same &= a == b
                less = (less | same if after else less) & open_
                lo, hi = np.where(less, mid + 1, lo), np.where(open_ & ~less, mid, hi)
            out.append(lo)
        return out[0], out[1]


def _found(s: Suffixes, h: np.ndarray, doc: np.ndarray):
    """Places of all occurrences: (word place, index of the test suffix)."""
    if not len(s.lengths) or not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place, keys = s.shard(h, doc)
    if not len(place):
        return place, place
    lo, hi = s.search(keys)
    which = np.repeat(np.arange(len(lo)), hi - lo)
    at = np.repeat(lo - np.concatenate(([0], np.cumsum(hi - lo)[:-1])), hi - lo) + np.arange(len(which))
    return place[at], which


def _longest(s: Suffixes, at: np.ndarray, which: np.ndarray, doc: np.ndarray):
    """Occurrences on one diagonal of an item and a document, joined:
    (document, item, item's word, document's word, words)."""
    n = s.bounds[which + 1] - s.bounds[which]
    own = s.owners[np.repeat(s.bounds[which] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())]
    p, length = np.repeat(at, n), np.repeat(s.lengths[which], n)
    order = np.lexsort((p, p - own[:, 1], own[:, 0], doc[p]))
    p, k, item, length = p[order], own[order, 1], own[order, 0], length[order]
    new = np.ones(len(p), bool)
    new[1:] = (item[1:] != item[:-1]) | (p[1:] - k[1:] != p[:-1] - k[:-1]) | (doc[p[1:]] != doc[p[:-1]]) | (p[1:] != p[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(p)])) - 1 if len(first) else first
    return doc[p[first]], item[first], k[first], p[first], p[last] - p[first] + length[last]


MATCH = pa.list_(pa.struct([("item_id", pa.string()), ("item_word", pa.int64()), ("word", pa.int64()), ("n_words", pa.int64())]))


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """docs -> (row, n_words, n_hit, items, matches).

    ``row`` is a struct of all columns of docs.  A window is ``window``
    consecutive words of an item of benchmark(item_id, text); an item of
    fewer words, but not none, is one window.  n_hit counts the document's
    words inside any occurrence of a window, ``items`` lists the sorted ids of
    the items with occurring windows, ``matches`` the longest verbatim matches
    (item_id, item_word, word, n_words; words count from 0).  Null and empty
    texts have no words and match nothing; items without an id hit words but
    are in no list; an id given twice is listed once.
    """
    spark = docs.sparkSession
    items = benchmark.select("item_id", "text")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = int(total // (2 * BLOCK_WORDS)) + 1  # a word has two characters with its end at least
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    out = docs.select(F.struct("*").alias("row"), F.col(text).cast("string").alias("text"))
    out = out.withColumns({"n_words": F.lit(0).cast("long"), "hits": F.expr("cast(null as array<bigint>)"), "n_hit": F.lit(0).cast("long"), "items": F.expr("cast(array() as array<string>)"), "matches": F.expr("cast(array() as array<struct<item_id: string, item_word: bigint, word: bigint, n_words: bigint>>)")})
    for b in range(blocks):
        rows = [(r[0], r[1]) for r in items.filter(part == b).collect()]  # at most BLOCK_WORDS words
        suffixes = share(spark, Suffixes(rows, window))
        out = out.mapInArrow(_pass(suffixes, b == blocks - 1, b > 0), out.schema)
    return out.select("row", "n_words", "n_hit", F.array_sort("items").alias("items"), "matches")


def _pass(suffixes, last: bool, more: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = suffixes()
        for batch in batches:
            for lo, hi, data, offs in text_chunks(batch["text"]):
                starts, _, h = words(data, offs, APART)
                bounds = np.searchsorted(starts, offs)
                doc = np.repeat(np.arange(hi - lo), np.diff(bounds))
                at, which = _found(s, h, doc)
                cover = np.zeros(len(h) + 1, np.int64)
                np.add.at(cover, at, 1)
                np.add.at(cover, at + s.lengths[which], -1)
                names, matches = [[] for _ in range(hi - lo)], [[] for _ in range(hi - lo)]
                if len(at):
                    for d, item, k, p, n in zip(*(x.tolist() for x in _longest(s, at, which, doc))):
                        matches[d].append({"item_id": s.ids[item], "item_word": k, "word": p - int(bounds[d]), "n_words": n})
                    for d in range(hi - lo):
                        names[d] = sorted({m["item_id"] for m in matches[d] if m["item_id"] is not None})
                hit = np.cumsum(cover[:-1]) > 0
                if more:  # what earlier blocks of the benchmark hit
                    for d in range(hi - lo):
                        hit[bounds[d] + np.array(batch["hits"][lo + d].as_py(), np.int64)] = True
                        names[d] = sorted({*names[d], *batch["items"][lo + d].as_py()})
                        matches[d] = batch["matches"][lo + d].as_py() + matches[d]
                total = np.concatenate(([0], np.cumsum(hit)))
                n_hit = total[bounds[1:]] - total[bounds[:-1]]
                hits = None if last else [np.flatnonzero(hit[x:y]) for x, y in zip(bounds[:-1], bounds[1:])]
                own = batch.slice(lo, hi - lo)
                cols = {"row": own["row"], "text": pa.nulls(hi - lo, own["text"].type) if last else own["text"], "n_words": pa.array(np.diff(bounds), pa.int64()), "hits": pa.nulls(hi - lo, pa.list_(pa.int64())) if last else pa.array(hits, pa.list_(pa.int64())), "n_hit": pa.array(n_hit, pa.int64()), "items": pa.array(names, pa.list_(pa.string())), "matches": pa.array(matches, MATCH)}
                yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of docs, all their columns, that hold no window of the benchmark."""
    return find(docs, benchmark, text, window).filter("n_hit = 0").select("row.*")
