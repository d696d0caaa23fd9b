"""Token ids of a public byte-level vocabulary, many texts at a time.

A text's pieces (the vocabulary's own splitting rule: contractions, words and
numbers with one blank before them, signs, white space) are found by numpy
over code points, told apart by 64-bit hashes, and each different piece is
encoded once; ids of a whole batch are then one gather.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd

from islet.llm.common import _R, _RI, _power, mix64, random_words

WINDOW = 1 << 21  # code points that are split at a time
CACHE = 1_000_000  # different pieces that are kept encoded

_SPACE, _LETTER, _DIGIT, _SIGN, _UNKNOWN = range(5)


def load(path: str) -> tuple[dict[bytes, int], dict[str, int], str]:
    """(token bytes -> id, special tokens, splitting rule) of a vocabulary file
    of the ``tokenizers`` library: byte-level, its merges in id order."""
    with open(path, encoding="utf-8") as f:
        held = json.load(f)
    # The byte-level alphabet writes printable bytes as themselves, the others as U+0100 on.
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown)))}
    ranks = {bytes(byte[c] for c in token): i for token, i in held["model"]["vocab"].items()}
    merged = [ranks[bytes(byte[c] for c in "".join(m if isinstance(m, list) else m.split(" ")))] for m in held["model"]["merges"]]
    if merged != sorted(merged):
        raise ValueError(f"the merges of {path} are not in id order")
    special = {t["content"]: t["id"] for t in held["added_tokens"]}
    # Fixed value: the byte-level pre-tokenizer's pattern.
    return ranks, special, r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Lives in one Python worker."""

    def __init__(self, ranks: dict[bytes, int], special: dict[str, int], rule: str):
        import tiktoken
        from tokenizers.pre_tokenizers import ByteLevel

        self.rule = ByteLevel(add_prefix_space=False, use_regex=True)
        self.one = tiktoken.Encoding("pieces", pat_str=rule, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.special = special
        self.marks = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.table = np.full(0x110000, _UNKNOWN, np.uint8)
        self.random = random_words(0x110000, 31)
        self.code = "H" if max([*ranks.values(), *special.values()]) < 1 << 16 else "I"
        self.dtype = np.dtype(self.code)
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.begin, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, self.dtype)

    def kinds(self, codes: np.ndarray) -> np.ndarray:
        """Space, letter, number or sign of each code point, as the library's
        own splitting has it: code points not met before are put to it."""
        out = self.table[codes]
        if (out == _UNKNOWN).any():
            for c in np.unique(codes[out == _UNKNOWN]).tolist():
                joins = lambda before, c=chr(c): len(self.rule.pre_tokenize_str(before + c)) == 1
                self.table[c] = _LETTER if joins("a") else _DIGIT if joins("1") else _SIGN if joins("!") else _SPACE
            out = self.table[codes]
        return out

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, how many each has).  Special
        tokens in a text are their ids, as the library has it."""
        units, owner = [], []  # code point runs or special ids, and their text
        for i, t in enumerate(texts):
            for part in self.marks.split(t) if self.marks and any(m in t for m in self.special) else (t,):
                if part:
                    units.append(part)
                    owner.append(i)
        ids, counts = [], np.zeros(len(texts), np.int64)
        for lo, hi in _runs(units):
            if lo + 1 == hi and units[lo] in self.special:
                got, lens = np.array([self.special[units[lo]]], self.dtype), np.ones(1, np.int64)
            elif lo + 1 == hi and len(units[lo]) > WINDOW:
                got = np.concatenate([self._ids(w, np.array([len(w)]))[0] for w in self._windows(units[lo])])
                lens = np.array([len(got)])
            else:
                plain = [u if u not in self.special else "" for u in units[lo:hi]]
                got, lens = self._ids("".join(plain), np.cumsum([len(u) for u in plain]))
                marked = [k for k in range(lo, hi) if units[k] in self.special]
                if marked:
                    at = np.array(marked) - lo
                    got = np.insert(got, np.cumsum(lens)[at], [self.special[units[k]] for k in marked])
                    lens[at] = 1
            ids.append(got)
            np.add.at(counts, np.array(owner[lo:hi]), lens)
        return np.concatenate(ids) if ids else np.zeros(0, self.dtype), counts

    def _windows(self, text: str) -> Iterator[str]:
        """Cuts behind a letter or digit that a different kind follows: no
        piece goes across.  A longer run without one is a window."""
        lo = 0
        while lo < len(text):
            hi = lo + WINDOW
            while hi < len(text):
                k = self.kinds(np.frombuffer(text[lo : hi + 1].encode("utf-32-le"), np.uint32))
                cut = np.flatnonzero((k[1:] != k[:-1]) & ((k[:-1] == _LETTER) | (k[:-1] == _DIGIT)))
                if len(cut):
                    hi = lo + int(cut[-1]) + 1
                    break
                hi += WINDOW
            yield text[lo:hi]
            lo = hi

    def _ids(self, text: str, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per unit) of the units of a text that end at ``ends``."""
        if not text:
            return np.zeros(0, self.dtype), np.zeros(len(ends), np.int64)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        starts = split(codes, self.kinds(codes), ends)
        stops = np.append(starts[1:], len(codes))
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(self.random[codes] * _power(_R, len(codes)), out=sums[1:])
        hashes = mix64((sums[stops] - sums[starts]) * _power(_RI, len(codes))[starts] + (stops - starts).astype(np.uint64))
        which, uniq = pd.factorize(hashes)
        place = self._places(uniq, lambda new: self._encoded(text, starts, stops, which, new))
        begin, sizes = self.begin[place], self.size[place]
        n = sizes[which]
        before = np.cumsum(n) - n
        ids = self.flat[np.arange(int(n.sum())) + np.repeat(begin[which] - before, n)]
        bound = np.append(before, len(ids))[np.searchsorted(starts, ends)]
        return ids, np.diff(bound, prepend=0)


    def _encoded(self, text: str, starts: np.ndarray, stops: np.ndarray, which: np.ndarray, new: np.ndarray) -> list[array]:
        """Ids of the different pieces numbered ``new``."""
        first = np.empty(int(which.max()) + 1, np.int64)
        first[which[::-1]] = np.arange(len(which))[::-1]
        at = first[new]
        return [array(self.code, self.one(text[i:j])) for i, j in zip(starts[at].tolist(), stops[at].tolist())]

    def _places(self, uniq: np.ndarray, encode) -> np.ndarray:
        """Where the kept pieces hold each hash; those not kept are encoded."""
        if len(self.hashes) + len(uniq) > CACHE:
            self._forget()
        at = np.searchsorted(self.hashes, uniq)
        kept = np.zeros(len(uniq), bool)
        inside = at < len(self.hashes)
        kept[inside] = self.hashes[at[inside]] == uniq[inside]
        new = np.flatnonzero(~kept)
        if len(new):
            got = encode(new)
            size = np.fromiter(map(len, got), np.int64, len(got))
            hashes = np.concatenate([self.hashes, uniq[new]])
            order = np.argsort(hashes, kind="stable")
            self.hashes = hashes[order]
            self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(size) - size])[order]
            self.size = np.concatenate([self.size, size])[order]
            self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(got), self.dtype)])
            at = np.searchsorted(self.hashes, uniq)
        return at


def _runs(units: list[str]) -> Iterator[tuple[int, int]]:
    """Runs of units with about WINDOW code points; a longer unit is alone."""
    lo = 0
    while lo < len(units):
        hi, n = lo + 1, len(units[lo])
        while hi < len(units) and n + len(units[hi]) <= WINDOW:
            n += len(units[hi])
            hi += 1
        yield lo, hi
        lo = hi


def split(codes: np.ndarray, kinds: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Starts of the pieces of the texts that end at ``ends``."""
    n = len(codes)
    new = np.ones(n + 1, bool)
    new[1:n] = kinds[1:] != kinds[:-1]
    new[ends] = True
    closes = np.zeros(n + 1, bool)  # a text ends here
    closes[ends] = True
    at = np.flatnonzero(new)
    a, b = at[:-1], at[1:]  # runs of one kind
    kind = kinds[a]
    mark = new  # piece starts; from here on without those that join
    # white space: its last character stands alone, or before what follows if it is a blank
    space = (kind == _SPACE) & ~closes[b]
    mark[b[space] - 1] = True
    joins = space & (codes[b - 1] == 0x20)
    mark[b[joins]] = False
    # contractions: a lone apostrophe at a piece's start takes letters after it
    lone = np.flatnonzero((kind == _SIGN) & (b - a == 1) & (codes[a] == 0x27) & mark[a] & ~closes[b])
    if len(lone):
        after = b[lone]
        own = kinds[np.minimum(after, n - 1)] == _LETTER
        c = codes[np.minimum(after, n - 1)]
        end = at[np.minimum(lone + 2, len(at) - 1)]
        d = np.where(after + 1 < end, codes[np.minimum(after + 1, n - 1)], 0)
        one = own & np.isin(c, [ord(x) for x in "stmd"])
        two = own & ~one & (((c == ord("r")) & (d == ord("e"))) | ((c == ord("v")) & (d == ord("e"))) | ((c == ord("l")) & (d == ord("l"))))
        mark[after[one | two]] = False
        mark[after[one] + 1] = True
        mark[after[two] + 2] = True
    return np.flatnonzero(mark[:n])
