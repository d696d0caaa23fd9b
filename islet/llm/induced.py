"""Suffix arrays by induced sorting, and permuted longest common prefixes.

Plain numpy over one shard.  Where the classic algorithm walks the array
element by element, a bucket (one character) is taken at a time here: all its
entries induce their left neighbours in one stable counting step, and runs of
the same character take a round for each repeat.
"""

from __future__ import annotations

import numpy as np


def classify(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is S-type, leftmost S-type places) of a text whose last character is
    its unique smallest."""
    n = len(s)
    first = np.concatenate(([0], np.flatnonzero(s[1:] != s[:-1]) + 1))
    chars = s[first]
    rising = np.ones(len(first), bool)  # the run is followed by a larger character
    rising[:-1] = chars[:-1] < chars[1:]
    small = np.repeat(rising, np.diff(np.concatenate((first, [n]))))
    left = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    return small, left


def _place(sa, heads, at, chars, back: bool):
    """Puts entries, in order, to the next places of their buckets."""
    order = np.argsort(chars, kind="stable")
    c = chars[order]
    new = np.concatenate(([0], np.flatnonzero(c[1:] != c[:-1]) + 1))
    size = np.diff(np.concatenate((new, [len(c)])))
    rank = np.arange(len(c)) - np.repeat(new, size)
    if back:
        sa[np.repeat(heads[c[new]], size) - rank] = at[order]
        heads[c[new]] -= size
    else:
        sa[np.repeat(heads[c[new]], size) + rank] = at[order]
        heads[c[new]] += size


def induce(s: np.ndarray, small: np.ndarray, left: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The suffix array that the leftmost S-type suffixes, in the order of
    ``left``, induce."""
    n = len(s)
    ends = np.cumsum(size)
    starts = ends - size
    sa = np.full(n, -1, np.int64)
    # leftmost S-type suffixes to the ends of their buckets, in order
    tails = ends.copy()
    order = np.argsort(s[left], kind="stable")
    c = s[left][order]
    count = np.bincount(c, minlength=len(size))
    where = np.arange(len(c)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(ends - count, count)
    sa[where] = left[order]
    tails = ends - count
    heads = starts.copy()
    for b in np.flatnonzero(size):
        done = starts[b]
        while done < heads[b]:  # L-type entries so far, then those that they add
            cur, done = sa[done : heads[b]], heads[b]
            p = cur[cur > 0] - 1
            p = p[~small[p]]
            if len(p):
                _place(sa, heads, p, s[p], False)
        cur = sa[tails[b] : ends[b]]
        p = cur[cur > 0] - 1
        p = p[~small[p]]
        if len(p):
            _place(sa, heads, p, s[p], False)
    last = ends - 1  # S-type entries anew, from the right
    large = heads  # each bucket's L-type entries stand in starts:large
    for b in np.flatnonzero(size)[::-1]:
        done = ends[b] - 1
        while done > last[b]:
            cur, done = sa[last[b] + 1 : done + 1][::-1], last[b]
            p = cur[cur > 0] - 1
            p = p[small[p]]
            if len(p):
                _place(sa, last, p, s[p], True)
        cur = sa[starts[b] : large[b]][::-1]
        p = cur[cur > 0] - 1
        p = p[small[p]]
        if len(p):
            _place(sa, last, p, s[p], True)
    sa[0] = n - 1
    return sa


def _ranks(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a text of names: those still tied are sorted
    by the ranks of twice as many names, until none is."""
    n = len(names)
    _, rank = np.unique(names, return_inverse=True)
    order = np.argsort(rank, kind="stable")
    rank = rank.astype(np.int64)
    # a rank is the place of the first of its ties
    sorted_rank = rank[order]
    new = np.concatenate(([True], sorted_rank[1:] != sorted_rank[:-1]))
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    k = 1
    while True:
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            return order
        own = order[at]
        key = rank[own] << 32  # a text has fewer than 2**31 names
        inside = own + k < n
        key[inside] += rank[own[inside] + k] + 1
        sub = np.argsort(key)
        own, key = own[sub], key[sub]
        order[at] = own
        fresh = np.concatenate(([True], key[1:] != key[:-1]))
        new[at] = fresh
        rank[own] = np.maximum.accumulate(np.where(fresh, at, 0))
        k *= 2


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array of small non-negative integers whose last is a unique 0."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int64)
    size = np.bincount(s)
    small, left = classify(s)
    sa = induce(s, small, left, size)
    is_left = np.zeros(n, bool)
    is_left[left] = True
    found = sa[is_left[sa]]  # leftmost S-type suffixes, by their substrings
    ends = np.empty(n, np.int64)
    ends[left] = np.concatenate((left[1:], [n - 1])) + 1
    base, inverse = 0x9E3779B97F4A7C55, pow(0x9E3779B97F4A7C55, -1, 1 << 64)
    up, down = np.full(n, base, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    sums = np.zeros(n + 1, np.uint64)
    mixed = (s.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    np.cumsum((mixed ^ (mixed >> np.uint64(29))) * np.multiply.accumulate(up), out=sums[1:])
    e = ends[found]
    content = (sums[np.minimum(e, n)] - sums[found]) * np.multiply.accumulate(down)[found]
    length = e - found
    name = np.cumsum(np.concatenate(([0], (content[1:] != content[:-1]) | (length[1:] != length[:-1]))))
    names = np.empty(n, np.int64)
    names[found] = name
    if name[-1] + 1 < len(found):
        left = left[_ranks(names[left])]
    else:
        left = found
    return induce(s, small, left, size)


def permuted_prefixes(s: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each place, its suffix's common prefix with the one before it in
    the suffix array.  Only places whose left neighbours differ are compared;
    from there it falls by one a place."""
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    at = np.arange(n)
    irreducible = (at == 0) | (before <= 0)
    inner = np.flatnonzero(~irreducible)
    irreducible[inner] = s[inner - 1] != s[before[inner] - 1]
    start = np.flatnonzero(irreducible & (before >= 0))
    length = np.zeros(n, np.int64)
    padded = np.concatenate((s, np.arange(8, dtype=s.dtype)))  # past the end nothing is equal: 0 is unique
    step = 4
    keys = np.zeros(n, np.uint64)
    for i in range(step):
        keys = (keys << np.uint64(16)) | padded[i : i + n].astype(np.uint64)
    a, b, own = start.copy(), before[start], start
    while len(own):
        same = (a < n - step) & (b < n - step)
        same[same] = keys[a[same]] == keys[b[same]]
        rest = ~same
        for x, y, o in ((a[rest], b[rest], own[rest]),):
            more = np.ones(len(o), bool)
            for i in range(step):
                more &= (x + i < n) & (y + i < n)
                more[more] = s[x[more] + i] == s[y[more] + i]
                length[o] += more
        length[own[same]] += step
        a, b, own = a[same] + step, b[same] + step, own[same]
    first = np.maximum.accumulate(np.where(irreducible, at, 0))
    out = length[first] - (at - first)
    out[before < 0] = 0
    return np.maximum(out, 0)
