"""Fill-in-middle texts, packed sequences and the conversation trie."""

import random
import re
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from islet.llm import byte_pairs, infill, packing, prefix_trie, queries

from .helpers import documents, edge_rows, prose, with_clashes

public_tokenizers = pytest.importorskip("public_tokenizers")


# --------------------------------------------------------------- op 11

def infilled(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    digest = sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def infill_rows():
    odd = ["<P>", "a<S", "P><", "<M", "<<P", "é\u0000\n\t z", "a" * 3000, "1" * 50, "\U0001f600x\U0001f600", "<S><P>", ">", "x<P"]
    return edge_rows() + [(100 + i, t, None, None, 0) for i, t in enumerate(odd * 8)]


@pytest.mark.parametrize("chunk", [64, 2 << 20])
def test_infill_is_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(infill, "text_chunks", lambda t: list(__import__("islet.llm.common", fromlist=["x"]).text_chunks(t, chunk)))
    found = infill.fill_in_middle(with_clashes(documents(spark, infill_rows())), ["doc_id", "text", "row", "n"])
    got = found.withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(infill_rows()) and {r["form"] for r in got} == {"plain", "psm", "spm"}
    for r in got:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == infilled(r["row"]["doc_id"], r["row"]["text"])
        assert r["back"] == (r["row"]["text"] or "") and r["row"]["n"] == "own n"


def test_infill_of_nothing(spark):
    assert infill.fill_in_middle(documents(spark, []), ["doc_id"]).count() == 0


# --------------------------------------------------------------- op 12

def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def odd_texts():
    rng = random.Random(5)
    signs = list("ab's tmdrevl'  \n\t1é2!?.世 　\u0085界") + ["<|endoftext|>", "Ɤ", "\U0001f600", "Ᲊ"]
    return ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(800)] + ["", " ", "'s", "it's  we'll 'sx ''s 'lll", "x" * 500, "<|endoftext|>", " \n a"]


@pytest.mark.parametrize("window, cache", [(7, 50), (1 << 21, 1_000_000)])
def test_ids_are_the_librarys(monkeypatch, window, cache):
    monkeypatch.setattr(byte_pairs, "WINDOW", window)
    monkeypatch.setattr(byte_pairs, "CACHE", cache)
    texts = odd_texts() + [r[1] or "" for r in edge_rows() if len(r[1] or "") < 5000]
    own = byte_pairs.Encoder(*byte_pairs.load(public_tokenizers.path("byte_bpe_50k.json")))
    ids, counts = own.texts(texts)
    parts = np.split(ids, np.cumsum(counts)[:-1])
    assert [p.tolist() for p in parts] == [e.ids for e in library().encode_batch(texts, add_special_tokens=False)]


def naive_first_fit(sizes, capacity):
    room, out = [], []
    for s in sizes:
        b = next((i for i, r in enumerate(room) if r >= s), len(room))
        if b == len(room):
            room.append(capacity)
        room[b] -= s
        out.append(b)
    return out


@pytest.mark.parametrize("capacity", [1, 2, 8, 16, 64])
def test_first_fit_and_groups(capacity):
    rng = random.Random(capacity)
    for _ in range(150):
        sizes = sorted((rng.randint(1, capacity) for _ in range(rng.randint(0, 60))), reverse=True)
        assert packing.first_fit(sizes, capacity) == naive_first_fit(sizes, capacity)
        held, seen = packing.pack_group(sizes, capacity), set()
        for b in held:
            n = sum(p[2] for p in b)
            assert n == capacity or n & (n - 1) == 0
            for i, start, k in b:
                own = {(i, x) for x in range(start, start + k)}
                assert k > 0 and not own & seen
                seen |= own
        assert seen == {(i, x) for i, n in enumerate(sizes) for x in range(n)}
        assert len(held) == sum(sizes) // capacity + bin(sum(sizes) % capacity).count("1")


def check_packed(rows, got, capacity):
    """Every row's ids, once each; sequences gapless and without padding."""
    ids = {(i, t): [*library().encode(t or "", add_special_tokens=False).ids, 0] for i, t in rows}
    by_doc, copies = defaultdict(list), defaultdict(int)
    for i, t in rows:
        copies[i, tuple(ids[i, t])] += 1
    for r in got:
        by_doc[r["doc_id"]].append(r)
    for i in {i for i, _ in rows}:
        want = defaultdict(int)  # each place's id, as often as there are rows with it
        for (j, held), c in copies.items():
            if j == i:
                for at, x in enumerate(held):
                    want[len(held), at, x] += c
        have = defaultdict(int)
        for r in by_doc[i]:
            own = np.frombuffer(r["ids"], "<u4")
            assert len(own) == r["length"] > 0 and zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
            for at, x in enumerate(own.tolist()):
                have[r["doc_tokens"], r["start"] + at, x] += 1
        assert have == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in sequences.values():
        end = 0
        for offset, n in sorted(held):
            assert offset == end
            end += n
        assert end == capacity or end < capacity and end & (end - 1) == 0


@pytest.mark.parametrize("group", [3, 40, 8192])
def test_packed_rows(spark, group):
    rows = [(i, t) for i, t, *_ in edge_rows() if len(t or "") < 9000] + [(50, "again and again")] * 30 + [(60 + i, prose(i, i % 70)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = packing.pack(with_clashes(docs), capacity=64, group_pieces=group, with_ids=True)
    check_packed(rows, found.collect(), 64)
    key = ["doc_id", "start", "length", "sequence_id", "offset"]
    again = packing.pack(docs.repartition(5), capacity=64, group_pieces=group).select(key)
    assert sorted(map(str, found.select(key).collect())) == sorted(map(str, again.collect())), "reruns agree"


def test_packing_query(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.op12_tournament_packing(spark, sf)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    rows, by_doc, used = got.collect(), defaultdict(list), defaultdict(int)
    for x in rows:
        by_doc[x["doc_id"]].append(x)
        used[x["sequence_id"]] += x["length"]
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = np.array([*library().encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        end = 0
        for x in sorted(by_doc[r["doc_id"]], key=lambda x: x["start"]):
            assert x["start"] == end and x["doc_tokens"] == len(ids) and zlib.crc32(ids[x["start"] : x["start"] + x["length"]].tobytes()) == x["ids_crc32"]
            end += x["length"]
        assert end == len(ids)
    assert all(n <= 1024 and n & (n - 1) == 0 for n in used.values())


def test_packing_of_nothing(spark):
    assert packing.pack(documents(spark, [])).count() == 0


# --------------------------------------------------------------- op 13

def trie_rows(turns):
    """By comparing all prefixes."""
    convs = defaultdict(list)
    for c, turn, role, text in turns:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    digest = lambda x: __import__("hashlib").md5(f"{len(x[2])}:{x[2]}{x[3]}".encode()).hexdigest()
    convs = {c: [x[2:] for x in sorted(t, key=lambda x: (x[0], x[1], digest(x)))] for c, t in convs.items()}
    whole = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(convs.get(c - int(np.fmod(c, 100)), [])[:h] + own[h:])
    nodes = defaultdict(list)
    for c, t in whole.items():
        for d in range(len(t) + 1):
            nodes[t[:d]].append(c)
    out = []
    for node, held in nodes.items():
        under = [x for x in nodes if x[: len(node)] == node]
        childless = [x for x in under if not any(len(y) == len(x) + 1 and y[:-1] == x for y in nodes)]
        ends = ",".join(str(c) for c in sorted(held) if len(whole[c]) == len(node))
        out.append((
            min(held), len(node), min(nodes[node[:-1]]) if node else None, len(held), sum(1 for x in nodes if x and x[:-1] == node), len(childless),
            sum((len(nodes[x]) - 1) * len(x[-1][1]) for x in under if x), sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def conversations(seed):
    rng = random.Random(seed)
    say = [("user", "hello"), ("assistant", "hi"), ("user", "é…"), (None, "x"), ("", "x"), ("user", None), ("user", "")]
    rows = [(c, k if rng.random() < 0.9 else None, *rng.choice(say[: rng.randint(1, len(say))])) for c in [*range(0, 24), 100, 101, 107, 205, 211, -3, -100] for k in range(rng.randint(0, 8))]
    rows += [(300 + i, 0, "user", "the same") for i in range(30)] + [(None, 0, "user", "x")] + [(7, 3, "user", "twice")] * 2
    rows += [(400, k, "user", str(k)) for k in range(60)]  # a long one
    return rows


@pytest.mark.parametrize("seed, local_rows, run", [(0, 1, 1 << 16), (1, 7, 4), (2, 40, 3), (3, 1 << 14, 1 << 16)])
def test_trie_is_brute_force(spark, monkeypatch, seed, local_rows, run):
    monkeypatch.setattr(prefix_trie, "RUN", run)
    rows = conversations(seed)
    turns = with_clashes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.numbered(turns)), local_rows)
    assert sorted((tuple(r) for r in got.collect()), key=str) == trie_rows(rows)


def test_trie_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.numbered(none))).count() == 0


def test_forest_totals_of_any_shape():
    rng = random.Random(9)
    shapes = [[-1] * 5, [-1, *range(40)], [-1] + [0] * 40, []] + [[-1 if i == 0 or rng.random() < 0.05 else rng.randrange(i) for i in range(rng.randint(1, 80))] for _ in range(60)]
    for parent in shapes:
        mixed = list(range(len(parent)))
        rng.shuffle(mixed)  # parents may come after their children
        at = {x: i for i, x in enumerate(mixed)}
        held = [-1 if parent[x] < 0 else at[parent[x]] for x in mixed]
        values = np.array([[rng.randint(0, 9), 1] for _ in held], np.int64).reshape(len(held), 2)
        want = values.copy()
        for i in range(len(held)):
            p = held[i]
            while p >= 0:
                want[p] += values[i]
                p = held[p]
        assert (prefix_trie.rollup_forest(held, values) == want).all()
