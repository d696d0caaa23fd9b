"""Mixing, decontamination, language spans and the pipeline."""

import itertools
import re
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from islet.llm import decontaminate, langid, mixing, queries

from .helpers import documents, edge_rows, fold, prose, with_clashes


# ---------------------------------------------------------------- op 4

def quotients(votes, seats):
    best = sorted(((-v / (2 * k + 1), i) for i, v in enumerate(votes) for k in range(seats)))[:seats]
    return [sum(1 for _, j in best if j == i) for i in range(len(votes))]


@pytest.mark.parametrize("votes, seats", [([5.0, 3.0, 1.0], 7), ([1.0] * 9, 4), ([1000.0, 1.0, 0.0], 50), ([7.5], 3), ([1.0, 2.0], 0), ([100.0, 99.0, 1e-9], 300)])
def test_sainte_lague_takes_the_highest_quotients(spark, votes, seats):
    cells = spark.createDataFrame([(i, v) for i, v in enumerate(votes)], "i long, votes double")
    got = {r["i"]: r["quota"] for r in mixing.sainte_lague(cells, seats, ["i"]).collect()}
    assert [got[i] for i in range(len(votes))] == quotients(votes, seats)


def test_sainte_lague_of_many_parties(spark):
    votes = [float(x) for x in np.random.default_rng(0).integers(1, 5000, 700)]
    cells = spark.createDataFrame([(i, v) for i, v in enumerate(votes)], "i long, votes double")
    got = {r["i"]: r["quota"] for r in mixing.sainte_lague(cells, 20_011, ["i"]).collect()}
    best = sorted((-v / (2 * k + 1), i) for i, v in enumerate(votes) for k in range(120))[:20_011]
    want = [0] * len(votes)
    for _, i in best:
        want[i] += 1
    assert [got[i] for i in range(len(votes))] == want


def filled(sizes, weights, budget=1.5, cap=2):
    """Targets by sharing the excess anew until none is above."""
    goal, full = budget * sum(sizes), set()
    while True:
        open_ = [i for i in range(len(sizes)) if i not in full]
        level = (goal - sum(cap * sizes[i] for i in full)) / sum(weights[i] for i in open_) if open_ else 0
        over = {i for i in open_ if weights[i] * level > cap * sizes[i]}
        if not over:
            return [cap * sizes[i] if i in full else weights[i] * level for i in range(len(sizes))]
        full |= over


@pytest.mark.parametrize("shard_docs", [3, 200_000])
def test_mix_of_edge_rows(spark, shard_docs):
    rows = edge_rows()
    plan = mixing.mix(with_clashes(documents(spark)), ["doc_id", "source", "row"], block_words=1, shard_docs=shard_docs)
    got = plan.select("row.doc_id", "row.source", "row.row", "size", "source_size", "target", "taken").collect()
    assert len(got) == len(rows) and all(r["row"] == "own row" and 0 <= r["taken"] <= 2 * r["size"] for r in got)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    names = sorted({r[3] for r in rows if r[3] is not None}) + [None]
    sizes = [sum(words(r[1]) for r in rows if r[3] == s) for s in names]
    targets = filled(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))])
    for s, size, target in zip(names, sizes, targets):
        own = [r for r in got if r["source"] == s]
        assert {r["source_size"] for r in own} == {size} and own[0]["target"] == pytest.approx(target)
        assert abs(sum(r["taken"] for r in own) - target) <= 4
    again = mixing.mix(documents(spark).repartition(3), ["doc_id"], block_words=1, shard_docs=shard_docs)
    key = lambda r: (r["doc_id"] or 0, r["size"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again.select("row.doc_id", "size", "taken").collect()))


@pytest.mark.parametrize("shard_docs", [2, 80, 200_000])
def test_a_small_source_gives_its_target_beside_a_huge_one(spark, shard_docs):
    rows = [(i, prose(i, 15), "en", "a" if i < 50 else "b", 0) for i in range(6000)]
    got = mixing.mix(documents(spark, rows), ["doc_id", "source"], shard_docs=shard_docs).select("row.doc_id", "row.source", "size", "target", "taken").collect()
    small = [r for r in got if r["source"] == "a"]
    assert small[0]["target"] == 1500 and sum(r["taken"] for r in small) == 1500 // 32 * 32
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    alone = mixing.mix(documents(spark, rows[:50] + rows[3000:]), ["doc_id", "source"], shard_docs=80).filter("row.source = 'a'")
    if shard_docs == 80:
        assert {(r["doc_id"], r["taken"]) for r in small} == {(r["row"]["doc_id"], r["taken"]) for r in alone.collect()}, "not by the other sources' rows"


def test_mix_of_nothing(spark):
    assert mixing.mix(documents(spark, []), ["doc_id"]).count() == 0
    assert [r["taken"] for r in mixing.mix(documents(spark, [(1, "", None, None, 0)]), ["doc_id"]).collect()] == [0]


# ---------------------------------------------------------------- op 5

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def hits(text, items, window=10):
    w = re.findall(WORD, fold(text))
    covered, found = set(), set()
    for item, t in items:
        b = re.findall(WORD, fold(t))
        n = min(window, len(b))
        for k in range(max(1, len(b) - window + 1) if b else 0):
            for p in range(len(w) - n + 1):
                if w[p : p + n] == b[k : k + n]:
                    covered |= set(range(p, p + n))
                    if item is not None:
                        found.add(str(item))
    return len(w), len(covered), sorted(found)


def bench_items():
    base = prose(1, 120).split()
    return [(1, " ".join(base[10:40])), (2, " ".join(base[30:42]).upper()), (3, "word"), (10, prose(5, 12)), (4, None), (5, "..."), (None, prose(6, 15)), (6, " ".join(base[50:58])), (6, prose(4, 3)), (7, "x x x"), (8, prose(99, 30))]


@pytest.mark.parametrize("block", [20, 2_000_000])
def test_hits_are_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    bench = spark.createDataFrame(bench_items(), "item_id long, text string")
    got = decontaminate.find(with_clashes(documents(spark)).select("*"), bench).select("row.doc_id", "row.text", "n_words", "n_hit", "items", "matches").collect()
    assert len(got) == len(edge_rows())
    for r in got:
        assert (r["n_words"], r["n_hit"], r["items"]) == hits(r["text"], bench_items()), r["doc_id"]
        w = re.findall(WORD, fold(r["text"]))
        for m in r["matches"]:
            own = [re.findall(WORD, fold(t)) for i, t in bench_items() if m["item_id"] == (None if i is None else str(i))]
            assert any(w[m["word"] : m["word"] + m["n_words"]] == b[m["item_word"] : m["item_word"] + m["n_words"]] for b in own)
    clean = decontaminate.decontaminate(with_clashes(documents(spark)), bench)
    assert clean.columns == with_clashes(documents(spark)).columns
    assert clean.count() == sum(not hits(r[1], bench_items())[1] for r in edge_rows())


def test_longest_match_joins_windows(spark):
    text = prose(1, 60)
    bench = spark.createDataFrame([(1, " ".join(text.split()[5:45]))], "item_id long, text string")
    got = decontaminate.find(documents(spark, [(1, text, None, None, 0)]), bench).collect()[0]
    assert [tuple(m) for m in got["matches"]] == [("1", 0, 5, 40)] and got["n_hit"] == 40


def test_decontaminate_empty_sides(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(documents(spark), none).count() == len(edge_rows())
    assert decontaminate.decontaminate(documents(spark, []), none).count() == 0


# ---------------------------------------------------------------- op 6

def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(2)
    for _ in range(40):
        scores = -rng.random((6, 3)) * 10
        value = lambda p: sum(scores[i, x] for i, x in enumerate(p)) - 4 * sum(a != b for a, b in zip(p, p[1:]))
        best = max(itertools.product(range(3), repeat=6), key=value)
        assert value(langid.viterbi(scores, 4.0).tolist()) == pytest.approx(value(best))


def test_many_texts_at_once_take_the_same_paths():
    rng = np.random.default_rng(4)
    bounds = np.array([0, 0, 5, 40, 41, 41, 300, 310])
    scores = -rng.random((310, 4)) * 6
    scores[100:160, 1] += 8
    labels = langid.paths(scores, bounds, 9.0)
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        if hi > lo:
            own = langid.viterbi(scores[lo:hi], 9.0)
            value = lambda p: scores[np.arange(lo, hi), p].sum() - 9 * (p[1:] != p[:-1]).sum()
            assert value(labels[lo:hi]) == pytest.approx(value(own))


def test_copies_count_once_in_the_sample(spark):
    few = [(prose(i, 30), f"few{j}") for j in range(8) for i in (j, 100 + j) for _ in range(300)]
    many = [(prose(1000 + i, 30), "many") for i in range(1000)] + [(prose(5, 30), "many")] * 2000
    docs = spark.createDataFrame(few + many, "text string, lang string").repartition(5)
    got = [(r["lang"], r["text"]) for r in langid.sample(docs, 50).collect()]
    assert len(set(got)) == len(got), "one row for each text"
    assert all(sum(x == f"few{j}" for x, _ in got) == 2 for j in range(8)) and 20 <= sum(x == "many" for x, _ in got) <= 100
    assert {x for x, _ in (tuple(r) for r in langid.sample(docs.select("lang", "text"), 0).collect())} == {"many", *(f"few{j}" for j in range(8))}
    assert set(langid.fit(docs, 1).langs) == {"many", *(f"few{j}" for j in range(8))}


def test_held_out_accuracy_and_mixed_text(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.op6_language_spans(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    r = out.join(docs.select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert r > 0.97
    model = langid.fit(docs.select("text", "lang"))
    en, de = (docs.filter(F.col("lang") == x).orderBy("doc_id").first()["text"][:400] for x in ("en", "de"))
    mixed = spark.createDataFrame([(en + ". " + de,)], "text string")
    got = langid.label(mixed, model).collect()[0]
    assert [s["lang"] for s in got["spans"]] == ["en", "de"] and abs(got["spans"][1]["start"] - len(en)) < 40 and 0.3 < got["score"] < 0.7


def test_script_narrows_the_candidates(spark):
    rows = [("ru", "привет мир как дела хорошо"), ("el", "καλημέρα κόσμε τι κάνεις"), ("en", "hello world how are you")]
    model = langid.fit(spark.createDataFrame([(t, x) for x, t in rows], "text string, lang string"))
    probes = [("мир", "ru"), ("κόσμε", "el"), ("zzz", "en"), ("— 12", "und"), ("", "und"), (None, "und")]
    letters = ["ⵣⵓⵍ", "ⲁⲛⲟⲕ", "ⰀⰁ", "ℵ", "ⴀⴁ"]  # of scripts and symbols that no range names
    odd = langid.label(spark.createDataFrame([(t,) for t in letters], "text string"), model).collect()
    assert all(r["lang_pred"] in model.langs for r in odd)
    got = langid.label(spark.createDataFrame(probes, "text string, want string"), model).collect()
    assert all(r["lang_pred"] == r["row"]["want"] for r in got)
    assert all(r["score"] == (0 if r["lang_pred"] == "und" else 1) for r in got)


def test_language_of_odd_tables(spark):
    docs = with_clashes(documents(spark))
    got = langid.label(docs, langid.fit(docs.select("text", "lang"))).collect()
    assert len(got) == len(edge_rows()) and all(r["row"]["size"] == "own size" for r in got)
    none = langid.fit(docs.select("text", "lang").limit(0))
    assert {r["lang_pred"] for r in langid.label(docs, none).collect()} == {"und"}
    assert langid.label(documents(spark, []), none).count() == 0


# ---------------------------------------------------------------- pipeline

def stages():
    import corpus_pipeline

    return corpus_pipeline.STAGES


@pytest.mark.parametrize("rows", [None, []])
def test_stages_on_edge_rows(spark, tmp_path, rows):
    spark.createDataFrame(bench_items(), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = with_clashes(documents(spark, rows))
    cols = docs.columns
    for i, (name, stage) in enumerate(stages()):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if i == 4:  # the plan's own columns have these names
            cols = [f"doc_{c}" if c in ("size", "source_size", "target", "taken") else c for c in cols]
        assert docs.columns[: len(cols)] == cols and (i == 4 or len(docs.columns) == len(cols))
    if rows is None:
        ids = {r["doc_id"] for r in docs.collect()}
        assert not ids & {1, 2, 3} and 7 in ids


def test_pipeline_decisions(spark):
    """On a table of the driver: each stage against brute force."""
    import tempfile

    from .helpers import long_runs_removed, near_components

    sf, to = "/root/testdata/sf0.001", tempfile.mkdtemp()
    docs, kept = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in stages():
        stage(spark, docs, sf).write.parquet(f"{to}/{name}")
        docs = spark.read.parquet(f"{to}/{name}")
        kept[name] = {r["doc_id"]: r for r in docs.collect()}
    before = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(kept["language"]) >= 0.99 * len(before)
    rows = [(i, r["text"]) for i, r in sorted(kept["language"].items())]
    assert set(kept["near_duplicates"]) == {i for (i, _), c in zip(rows, near_components(rows)) if i == c}
    rows = sorted(kept["near_duplicates"].items())
    for (i, _), left in zip(rows, long_runs_removed([r["text"] for _, r in rows], 200, 51)):
        assert kept["repeated_strings"][i]["text"] == left
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    grams = set()
    for _, t in items:
        w = re.findall(WORD, fold(t))
        grams |= {tuple(w[k : k + min(10, len(w))]) for k in range(max(1, len(w) - 9)) if w}
    clean = set()
    for i, r in kept["repeated_strings"].items():
        w = re.findall(WORD, fold(r["text"]))
        if not any(tuple(w[k : k + n]) in grams for n in {len(g) for g in grams} for k in range(len(w) - n + 1)):
            clean.add(i)
    assert set(kept["benchmark"]) == clean
    plan = mixing.mix(spark.read.parquet(f"{to}/benchmark"), ["doc_id"]).filter("taken > 0").collect()
    assert {i: (r["size"], r["target"], r["taken"], r["text"]) for i, r in kept["mixture"].items()} == {
        r["row"]["doc_id"]: (r["size"], r["target"], r["taken"], kept["benchmark"][r["row"]["doc_id"]]["text"]) for r in plan
    }
    assert set(kept["mixture"]) <= clean and all(0 < r["taken"] <= 2 * r["size"] for r in kept["mixture"].values())


def test_sha_of_no_items():
    assert sha256(b"").hexdigest().startswith("e3b0")
