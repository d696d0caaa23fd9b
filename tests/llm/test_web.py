"""WARC archives, site templates, preference pairs and URL lists."""

import random
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from islet.llm import cascade, chat, templates, warc

from .helpers import with_clashes

PAGES = "page_id long, url string, html string"


# ---------------------------------------------------------------- op 1

def archive(spark, tmp_path, rows, kind="long", **more):
    df = spark.createDataFrame(rows, f"key {kind}, uri string, payload binary").repartition(3)
    warc.write(df, str(tmp_path / "w"), **more)
    return warc.restore(warc.read(spark, str(tmp_path / "w"))).collect()


def test_archives_round_trip(spark, tmp_path):
    big, odd = b"payload " * 40, b"\x00\xff\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 9
    rows = [(5, "http://a/\r\nX: y", big), (2, None, big), (9, "http://b", big), (1, "u", b"tiny"), (3, "u", b"tiny"), (4, "u", None), (6, "u", odd), (7, "u", odd), (8, "u", b"z" * 100), (10, "u", b"z" * 100), (11, "u", b"y" * 99), (12, "u", b"y" * 99), (20, "u", bytes(range(256)) * 5000)]
    rows += [(2, None, big), (None, "n", big), (None, "n", b"only null " * 30)]
    got = archive(spark, tmp_path, rows, archive_bytes=500)
    assert len(got) == len(rows)
    first = {}
    for k, _, p in rows:
        if p and len(p) >= 100 and k is not None:
            first[p] = min(first.get(p, k), k)
    want = []
    for k, _, p in rows:
        p = p or b""
        again = first.get(p, k) != k
        want.append((str(k or ""), len(p), sha256(p).hexdigest(), "revisit" if again else "response", str(first[p]) if again else None))
    assert sorted((r["key"] or "", r["payload_bytes"], r["digest"], r["record_type"], r["refers_to"]) for r in got) == sorted(want, key=lambda x: x[:4])


def test_payloads_come_back(spark, tmp_path):
    odd = b"\xfe\r\n\r\nWARC/1.1\r\n" * 20
    df = spark.createDataFrame([(1, "u", odd), (2, "u", odd), (3, "u", b"")], "key long, uri string, payload binary")
    warc.write(with_clashes(df.withColumnRenamed("key", "k")).drop("key").withColumnRenamed("k", "key"), str(tmp_path / "w"))
    got = {r["key"]: r for r in warc.read(spark, str(tmp_path / "w")).collect()}
    assert bytes(got["1"]["payload"]) == odd and got["2"]["payload"] is None and got["2"]["record_type"] == "revisit" and bytes(got["3"]["payload"]) == b""
    assert got["2"]["refers_to_id"] == got["1"]["record_id"]


def test_no_records(spark, tmp_path):
    assert archive(spark, tmp_path, []) == []


# ---------------------------------------------------------------- op 7

def extracted(spark, rows, **more):
    got = templates.extract(with_clashes(spark.createDataFrame(rows, PAGES)), **more).select("row.page_id", "text").collect()
    return {r[0]: r[1] for r in got}


BODY = "<article><h1>T &amp; t</h1><p>One\n  <i>two</i>&nbsp;three<p>Four<br>five<div class='ad'>buy</div></article>"


def test_main_text(spark):
    rows = [
        (1, "http://a.com/1", f"<html><head><title>x</title><script>var a='</p><p>no';</script></head><body><nav><ul><li>menu</ul></nav>{BODY}<footer>f</footer></body></html>"),
        (2, "http://a.com/2", None), (3, None, ""), (4, "nonsense", "plain &lt;text&gt; only"),
        (5, "http://a.com/5", "<body><header>h</header><div id=sidebar><p>side</div><div class=content><p>a<b>b</b>c</p><ul><li>x<li>y</ul></div><section id='comments'><p>reader</section><form><p>f</form></body>"),
        (6, "http://a.com/6", "<p>unclosed <b>bold<p>next</i> end"), (7, "http://a.com/7", "<p a='x>y'>q</p><!-- <p>c</p> --><style>p{}</style><textarea><p>t</textarea>"),
        (8, "http://a.com/8", "<main><header><h2>Head</h2>by me</header><p>in</p><aside>a</aside></main><p>out</p>"), (9, "http://a.com/9", "<p>" * 3000 + "deep" + "<div>" * 3000), (10, "http://a.com/10", "<script>never closed <p>x"),
        (11, "http://a.com/11", "<p>x &#233;&#x41;&bogus; &copy;</p>" + "long " * 100000),
    ]
    got = extracted(spark, rows)
    assert got[1] == "T & t\nOne two three\nFour five" and got[2] == "" and got[3] == "" and got[4] == "plain <text> only"
    assert got[5] == "abc\nx\ny" and got[6] == "unclosed bold\nnext end" and got[7] == "q" and got[8] == "Head\nin" and got[9] == "deep" and got[10] == ""
    assert got[11].startswith("x éA&bogus; ©\nlong long") and len(got[11]) > 499_000


def test_template_goes_only_where_it_recurs(spark):
    page = lambda i, host="h.com": (i, f"http://{host}/{i}", f"<body><div><p>site words</p></div><div><p>own {i}</p><p>quoted</p></div></body>")
    got = extracted(spark, [page(i) for i in range(6)] + [page(i, "rare.com") for i in range(6, 9)])
    assert all(got[i] == f"own {i}" for i in range(6)) and got[7] == "site words\nown 7\nquoted"
    same = [(i, f"http://h.com/{i}", "<body><div><p>copy</p></div></body>") for i in range(20)]
    assert set(extracted(spark, same).values()) == {"copy"}, "equal pages count once"
    told = [(i, f"http://h.com/{i}", f"<article><p>{i}</p><p>passage</p></article>") for i in range(20)]
    assert extracted(spark, told)[3] == "3\npassage", "words of articles are no template"
    assert extracted(spark, []) == {}


def test_template_goes_inside_articles(spark):
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(20))
    page = lambda i: (i, f"http://h.com/{i}", f"<body><article><h1>title {i}</h1><p>{own(i)}</p>{'<p>a quote</p>' if i < 6 else ''}<div><p>read our notice</p><ul><li>share<li>print</ul></div></article></body>")
    got = extracted(spark, [page(i) for i in range(20)])
    assert all(got[i] == f"title {i}\n{own(i)}" + ("\na quote" if i < 6 else "") for i in range(20))


def test_template_is_a_share_of_the_hosts_bodies(spark):
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(20))
    page = lambda i: (i, f"http://h.com/{i}", f"<body><div><p>menu words here</p></div><p>{own(i)}</p>{'<blockquote>some quote</blockquote>' if i < 8 else ''}</body>")
    got = extracted(spark, [page(i) for i in range(40)])
    assert got[3] == own(3) + "\nsome quote" and got[9] == own(9)
    article = "".join(f"<p>{own(i)}</p>" for i in range(3))
    chrome = lambda i: f"<div>chrome {own(100 + i)}</div>"
    copies = [(i, f"http://h.com/{i}", f"<body>{chrome(i)}<article><div class=entry-content>{article}</div></article></body>") for i in range(8)]
    assert set(extracted(spark, copies).values()) == {"\n".join(own(i) for i in range(3))}, "a wrapper of the article's words"
    parts = [(i, f"http://h.com/{i}", f"<body>{chrome(i)}<article>{article.replace('<p>', '<div class=x>').replace('</p>', '</div>')}</article></body>") for i in range(8)]
    assert set(extracted(spark, parts).values()) == {"\n".join(own(i) for i in range(3))}, "near copies count once"
    notices = [(i, f"http://h.com/{i}", f"<body>{chrome(i)}<article><div class=x>{own(1)}</div><div class=x>{own(2)}</div><div class=x>{own(3)}</div>{f'<p>{own(50 + i)}</p>' if i else ''}</article></body>") for i in range(40)]
    got = extracted(spark, notices)
    assert got[0] == "\n".join(own(i) for i in (1, 2, 3)) and "chrome" not in "".join(got.values()), "an article of template alone stays"


# ---------------------------------------------------------------- op 8

def test_common_prefix_and_masks(spark):
    rng = random.Random(1)
    pairs = []
    for i in range(60):
        turn = lambda: {"role": rng.choice(["user", "assistant"]), "text": rng.choice(["a", "b", "<|end|>", ""])}
        head = [turn() for _ in range(rng.randrange(4))]
        pairs.append((i, head + [turn() for _ in range(rng.randrange(3))], head + [turn() for _ in range(rng.randrange(3))]))
    turns = "array<struct<role: string, text: string>>"
    df = with_clashes(spark.createDataFrame(pairs, f"pair long, chosen {turns}, rejected {turns}"))
    shown = lambda ts: "".join(f"<|{t['role']}|>\n{t['text'].replace('<|', '< |')}<|end|>\n" for t in ts)
    for r in chat.preference(df).collect():
        _, c, j = pairs[r["pair"]]
        n = next((k for k in range(min(len(c), len(j))) if c[k] != j[k]), min(len(c), len(j)))
        assert (r["n_common"], r["prompt"], r["chosen_completion"], r["rejected_completion"]) == (n, shown(c[:n]), shown(c[n:]), shown(j[n:]))
        for side, ts in (("chosen", c), ("rejected", j)):
            at, trained = 0, ""
            for part in filter(None, r[f"{side}_mask"].split(",")):
                k, on = map(int, part.split(":"))
                trained += r[f"{side}_completion"][at : at + k] * on
                at += k
            assert at == len(r[f"{side}_completion"])
            assert trained == "".join(t["text"].replace("<|", "< |") + "<|end|>\n" for t in ts[n:] if t["role"] == "assistant")


def test_pairs_of_odd_conversations(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "one"), (1, 2, "user", "more"), (2, 1, "assistant", "two"), (2, 0, None, None), (3, 0, "user", "alone"), (None, 0, "assistant", "x"), (4, 0, "assistant", "two"), (4, 0, "assistant", "two")]
    df = with_clashes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r["conv_id"]: r for r in chat.preference(chat.with_rejected(chat.gather(df))).collect()}
    assert set(got) == {1, 2, 4}
    assert got[1]["prompt"] == "<|user|>\nq<|end|>\n" and got[1]["rejected_completion"] == "<|assistant|>\ntwo<|end|>\n"
    assert got[4]["n_common"] == 2 and got[4]["chosen_mask"] == "" and got[2]["prompt"] == "<|unknown|>\n<|end|>\n"
    assert chat.with_rejected(chat.gather(df.limit(0))).count() == 0


# ---------------------------------------------------------------- op 9

@pytest.mark.parametrize("n", [0, 1, 40, 900])
def test_cascade_is_exact_over_the_universe(spark, n):
    keys = [f"key{i}" for i in range(3000)]
    listed = set(random.Random(n).sample(keys, n))
    universe = spark.createDataFrame([(k,) for k in keys] + [(None,), (keys[0],)], "key string")
    built = cascade.build(universe.filter(F.col("key").isin(list(listed))) if n else universe.limit(0), universe)
    h = universe.filter("key is not null").select("key", *cascade.hashes(F.col("key"))).toPandas()
    got = built.has(h.a.to_numpy(np.int64).view(np.uint64), h.b.to_numpy(np.int64).view(np.uint64))
    assert {k for k, x in zip(h.key, got) if x} == listed
    assert sum(x.size for x in built.levels) < 64 * 8 + 40 * n


def test_verdicts_of_odd_urls(spark):
    from islet.llm.queries import URL_RULES

    urls = ["http://example.com/en/x", "HTTP://WWW.Example.COM/en/y?q#f", "https://a.b.net/es/", "x.net/es/", "http://net/fr/z", "http://net/fr", "http://com", "http://com/", "http://notexample.com/en/", "a://b://net/es/", "http://x.net?/es/", "http://x.net:80/es/", None, "", "http://", "://.com/", "http://x..net/es/", "http://sub.www.example.com/en/"]
    df = with_clashes(spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string"))

    def one(u):
        at = (u or "").find("://")
        if at < 0:
            return "", ""
        rest = u[at + 3 :]
        n = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        tail = rest[n:]
        return "".join(c.lower() if c.isascii() else c for c in rest[:n]), tail[: next((i for i, c in enumerate(tail) if c in "?#"), len(tail))]

    for r in cascade.judge(df, URL_RULES).select("row.page_id", "row.row", "host", "path", "rule", "verdict").collect():
        host, path = one(urls[r["page_id"]])
        fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, rule, verdict = max(fits, default=(0, None, "allow"))
        assert (r["host"], r["path"], r["rule"], r["verdict"], r["row"]) == (host, path, rule, verdict, "own row")
    assert cascade.judge(df.limit(0), URL_RULES).count() == 0
    assert {r["verdict"] for r in cascade.judge(df, []).collect()} == {"allow"}
