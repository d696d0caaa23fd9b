"""Small tables with every odd case, and brute force."""

import random
import re

from pyspark.sql import functions as F

#: Names that operators use for columns of their own.
CLASHES = ["row", "size", "key", "n", "node", "start", "words", "label", "host", "page", "spans", "items", "rank", "id", "component", "taken", "_block"]
VOCABULARY = ["".join(random.Random(i).choices("abcdefghij", k=5)) for i in range(400)]


def prose(seed: int, n: int) -> str:
    return " ".join(random.Random(seed).choices(VOCABULARY, k=n))


def edge_rows() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars)"""
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    texts = [
        (1, "", "en", "a"), (2, None, "en", "a"), (3, "...  \n\t 123", "de", "b"), (4, base, "en", "b"), (5, " ".join(near), "en", None),
        (6, base, "en", "b"), (6, base, "en", "b"), (7, prose(2, 8000), "de", None), (None, prose(3, 60), "fr", "c"), (8, prose(4, 3), None, "c"),
        (9, prose(5, 90) + " " + base[:450], "fr", "c"), (10, "word", "fr", "c"), (11, prose(6, 50), None, None), (-3, "x " * 400, "es", "d"),
        (12, base.upper(), "es", "d"), (13, "é" * 300 + " ü" * 200, "es", "d"),
    ]
    return [(i, t, lang, s, len(t) if t else 0) for i, t, lang, s in texts]


def documents(spark, rows=None):
    rows = edge_rows() if rows is None else rows
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def with_clashes(df):
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHES})


def fold(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingle_set(text: str) -> set:
    w = re.findall(r"[^\x20\x09-\x0D]+", fold(text))
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def near_components(rows: list[tuple]) -> list:
    """component_id of each (doc_id, text) by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append(doc if not sets[i] else min(ids, default=None))
    return out


def removed(texts: list, window: int) -> list[tuple]:
    """(bytes removed, runs, bytes kept) of each text by counting all windows."""
    return [x[:3] for x in _marked(texts, window)]


def _marked(texts: list, window: int) -> list[tuple]:
    raw = [(t or "").encode() for t in texts]
    seen: dict = {}
    for b in raw:
        for k in range(len(b) - window + 1):
            seen[b[k : k + window]] = seen.get(b[k : k + window], 0) + 1
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - window + 1):
            if seen[b[k : k + window]] > 1:
                gone[k : k + window] = b"\1" * window
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((sum(gone), runs, bytes(x for x, g in zip(b, gone) if not g), gone))
    return out


def long_runs_removed(texts: list, window: int, min_words: int) -> list[str]:
    """Texts without their runs of repeated bytes that hold ``min_words``
    words or more, in whole code points."""
    out = []
    for t, (_, _, _, gone) in zip(texts, _marked(texts, window)):
        raw, left, k = (t or "").encode(), bytearray(), 0
        while k < len(raw):
            if not gone[k]:
                left.append(raw[k])
                k += 1
                continue
            end = k
            while end < len(raw) and gone[end]:
                end += 1
            a, b = k, end
            while a < b and raw[a] & 0xC0 == 0x80:
                a += 1
            while a < b < len(raw) and raw[b] & 0xC0 == 0x80:
                b -= 1
            if len(re.findall(rb"[^\x20\x09-\x0D]+", raw[a:b])) >= min_words:
                left += raw[k:a] + raw[b:end]
            else:
                left += raw[k:end]
            k = end
        out.append(left.decode())
    return out
