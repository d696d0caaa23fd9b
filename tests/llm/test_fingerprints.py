"""Order MinHash, suffix-array dedup and SetSketch dedup against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from islet.llm import common, exact_substrings, induced, order_minhash, setsketch

from .helpers import documents, edge_rows, long_runs_removed, near_components, prose, removed, shingle_set, with_clashes


# ---------------------------------------------------------------- op 2

def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def chain(parts):
    seed = 42
    for p in parts:
        seed = xxhash.xxh64_intdigest(p if isinstance(p, bytes) else (p % (1 << 64)).to_bytes(8, "little"), seed=seed)
    return signed(seed)


def signature(text, k=3, m=32):
    """The two following k-mers of each rotation, by plain sorting."""
    w = (text or "").split()
    grams = [w[i : i + k] for i in range(max(1, len(w) - k + 1))] if w else []
    seen, items = {}, []
    for place, g in enumerate(grams):
        h = chain([x.encode() for x in g]) & ((1 << 40) - 1)
        n = seen.get(h, 0)
        seen[h] = n + 1
        items.append(signed((((chain([h, n]) if n else h) << 24) % (1 << 64)) | place))
    items.sort()
    out = []
    for r in order_minhash._rotations(m):
        if not items:
            out.append(0)
            continue
        at = sum(x < r for x in items)
        two = sorted((items[(at + t) % len(items)] for t in range(2)), key=lambda v: v & 0xFFFFFF)
        out.append(chain([(v % (1 << 64)) >> 24 for v in two]))
    return out


def test_signature_is_brute_force(spark):
    texts = [t for _, t, *_ in edge_rows()] + ["a b c a b c a b c a b c d", prose(9, 5000)]
    got = order_minhash.with_signature(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string"), "text", "s").collect()
    for r in got:
        assert r["s"] == signature(r["text"]), r["text"][:50]


def test_general_tuple_length(spark):
    df = spark.createDataFrame([(prose(1, 50),), (prose(1, 50),)], "text string")
    a, b = (r["s"] for r in order_minhash.with_signature(df, "text", "s", l=3).collect())
    assert a == b and len(set(a)) > 5


def test_likeness_falls_with_edits_and_moves(spark):
    w = prose(1, 400).split()
    moved = w[200:] + w[:200]
    rows = [(" ".join(w), " ".join(x)) for x in (w, w[:390] + ["x"] * 10, w[:200] + ["x"] * 200, prose(2, 400).split())] + [(" ".join(w), " ".join(w[::-1])), (" ".join(w), " ".join(moved))]
    df = order_minhash.with_signature(order_minhash.with_signature(spark.createDataFrame(rows, "a string, b string"), "a", "x"), "b", "y")
    near = [r[0] for r in df.select(order_minhash.likeness(F.col("x"), F.col("y"))).collect()]
    assert near[0] == 1 and near[0] > near[1] > near[2] > near[3] == near[4] == 0
    assert near[5] < near[1]


@pytest.mark.parametrize("block", [2, 4000])
def test_edits_follow_the_next_document(spark, monkeypatch, block):
    monkeypatch.setattr(order_minhash, "BLOCK_ROWS", block)
    got = order_minhash.edits(with_clashes(documents(spark))).collect()
    rows = sorted(edge_rows(), key=lambda r: (r[0] is None, -(r[0] or 0)))
    texts = [r[1] or "" for r in rows]
    want = sorted((r[0] is None, r[0] or 0, t[: len(t) - len(t) // 3] + n[: len(t) // 3]) for r, t, n in zip(rows, texts, texts[1:] + texts[:1]))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["edited"]) for r in got) == want


def test_fingerprints_of_few_rows(spark):
    assert order_minhash.edits(documents(spark, [])).count() == 0
    assert order_minhash.edits(documents(spark, edge_rows()[3:4])).collect()[0]["edited"]
    assert order_minhash.edits(documents(spark, [(None, "a b", None, None, 1)] * 2)).count() == 2


# ---------------------------------------------------------------- op 3

def test_suffix_arrays_of_random_texts():
    rng = np.random.default_rng(3)
    for _ in range(400):
        part = rng.integers(1, rng.integers(2, 6), rng.integers(1, 40))
        s = np.concatenate((np.tile(part, rng.integers(1, 4)), [0])).astype(np.uint16)
        text = s.tolist()
        want = sorted(range(len(text)), key=lambda i: text[i:])
        sa = induced.suffix_array(s)
        assert sa.tolist() == want
        prefix = induced.permuted_prefixes(s, sa)
        for a, b in zip(want, want[1:]):
            n = 0
            while max(a, b) + n < len(text) and text[a + n] == text[b + n]:
                n += 1
            assert prefix[b] == n


def shared_texts():
    rng = random.Random(5)
    passages = [prose(100 + i, 12) for i in range(4)]
    texts = [prose(i, rng.randrange(0, 40)) + rng.choice(passages) + prose(i + 50, rng.randrange(0, 20)) for i in range(40)]
    return texts + [None, "", "ab" * 100, "ab" * 100, "a" * 300, passages[0] * 3, "é" * 120, "xé" * 60, "short", "short"]


@pytest.mark.parametrize("shard, hot", [(4 << 20, 12 << 20), (1500, 12 << 20), (1500, 300)])
def test_removals_are_brute_force(spark, shard, hot):
    texts = shared_texts()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in exact_substrings.removals(df, 40, 8, shard, hot).collect()}
    for i, (t, want) in enumerate(zip(texts, removed(texts, 40))):
        assert got.get(i, (0, 0, (t or "").encode())) == want, i


def test_substrings_of_edge_rows(spark):
    from hashlib import sha256

    got = exact_substrings.summary(with_clashes(documents(spark))).collect()
    rows = edge_rows()
    want = sorted((r[0] is None, r[0] or 0, len((r[1] or "").encode()), n, k, sha256(b).hexdigest()) for r, (n, k, b) in zip(rows, removed([r[1] for r in rows], 400)))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == want
    assert exact_substrings.summary(documents(spark, [])).count() == 0
    whole = exact_substrings.deduplicated(with_clashes(documents(spark)))
    assert whole.columns == with_clashes(documents(spark)).columns and whole.count() == len(rows)


def passage_texts():
    """Passages of 51 to 60 words, under 400 bytes, in two texts each; near
    copies with longer and shorter common runs; and texts with neither."""
    shared = [prose(300 + i, 51 + i) for i in range(10)]
    near = prose(400, 300).split()
    for k in (20, 55, 130, 160, 290):
        near[k] = "changed"
    planted = [prose(500 + i, 40) + " " + shared[i // 2] + " " + prose(600 + i, 30) for i in range(20)]
    other = [prose(400, 300), " ".join(near), prose(700, 120) * 2, "é" * 500, "xé" * 300, prose(701, 40), prose(701, 40)]
    return planted, other, [prose(800 + i, 150) for i in range(10)]


@pytest.mark.parametrize("window, passage, words", [(400, 200, 51), (200, 100, 20), (150, 150, 30)])
def test_short_passages_are_counted_beside_the_windows(spark, window, passage, words):
    from hashlib import sha256

    planted, other, clean = passage_texts()
    texts = planted + other + clean + ["twice " + prose(900, 100), None, ""]
    rows = [(i, t) for i, t in enumerate(texts)] + [(len(texts) - 3, texts[-3]), (None, prose(901, 200)), (None, prose(901, 200) + "."), (0, prose(902, 90))]
    raw = [t for _, t in rows]
    earlier = common.stage(spark.range(5), "earlier")
    got = exact_substrings.summary(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), window, passage, words).collect()
    assert earlier.count() == 5, "staged tables of others stay"
    want = []
    for (i, t), (n, k, left), short in zip(rows, removed(raw, window), long_runs_removed(raw, passage, words)):
        size = len((t or "").encode())
        want.append((i is None, i or 0, size, n, k, sha256(left).hexdigest(), size - len(short.encode())))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], r["n_passage_bytes"]) for r in got) == sorted(want)
    assert all((r["n_passages"] > 0) == (r["n_passage_bytes"] > 0) for r in got)
    if window == 400:
        own = {r["doc_id"]: r for r in got if r["doc_id"]}
        assert all(own[i]["n_passages"] == 1 and own[i]["n_removed"] == 0 for i in range(1, len(planted)))
        first = len(planted) + len(other)
        assert all(own[i]["n_passages"] == 0 for i in range(first, first + len(clean)))


# ---------------------------------------------------------------- op 10

def near_rows():
    rng = random.Random(8)
    rows = []
    for g in range(6):
        base = prose(g, 150).split()
        for c in range(12):
            w = list(base)
            for _ in range(rng.randrange(0, 9)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(999)}"
            rows.append((len(rows), " ".join(w)))
    chain_ = prose(77, 200).split()  # each like the next, the ends unlike
    for c in range(8):
        rows.append((len(rows), " ".join(chain_[c * 12 : c * 12 + 110])))
    rng.shuffle(rows)
    return rows + [(i, t) for i, t, *_ in edge_rows()]


@pytest.mark.parametrize("block, size", [(4, 32 << 20), (4096, 32 << 20), (4096, 5000)])
def test_components_are_brute_force(spark, monkeypatch, block, size):
    monkeypatch.setattr(setsketch, "BLOCK", block)
    monkeypatch.setattr(setsketch, "BLOCK_BYTES", size)
    rows = [(1000 + i if k > 80 else i, t) for k, (i, t) in enumerate(near_rows()) if i is not None] + [(None, prose(3, 60))]
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in setsketch.near_dedup(df).collect())
    want = sorted((i is None, i or 0, len(shingle_set(t)), c or 0) for (i, t), c in zip(rows, near_components(rows)))
    assert got == want


def test_near_dedup_of_odd_tables(spark):
    assert setsketch.near_dedup(documents(spark, [])).count() == 0
    rows = [(None, "a b c d e f", None, None, 1), (None, "a b c d e f", None, None, 1)]
    assert [r["component_id"] for r in setsketch.near_dedup(documents(spark, rows)).collect()] == [None, None]
    kept = setsketch.deduplicated(with_clashes(documents(spark)))
    assert kept.columns == with_clashes(documents(spark)).columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [-3, 0, 1, 2, 3, 4, 7, 8, 9, 10, 11, 13]


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = x[:2000], x[500:2500]
    regs = [setsketch.registers(v, np.array([0, len(v)]))[0] for v in (a, b, np.union1d(a, b))]
    assert (setsketch.merge(regs[0], regs[1]) == regs[2]).all()
    est = setsketch.joint_estimate(regs[0][None], regs[1][None], np.array([2000.0]), np.array([2000.0]))[0]
    assert abs(est - 1500 / 2500) < setsketch.MARGIN
