"""Main text of web pages with site templates removed.

1. One pass hashes the subtrees of each page's boxes (tag, text and
   children); Spark counts each hash per host, once for each different body:
   pages that differ in their chrome or a few words count as one.
2. A subtree in at least ``MIN_PAGES`` different bodies' pages and at least
   ``MIN_SHARE`` of the host's is part of its template, unless it holds half
   of its page's (inside an article: the article's) words.
3. A second pass deletes a page's template subtrees, inside its article too,
   then those that are no article by their tag or class, and joins the blocks
   that remain.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from hashlib import blake2b
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from islet.llm.cascade import host
from islet.llm.common import stage

MIN_PAGES = 5
MIN_SHARE = 0.5  # of the host's different bodies
SHINGLE = 5  # words

#: Elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes template xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
DROPPED = frozenset("nav aside footer form button select option menu dialog svg canvas object embed audio video map head script style".split())
CLOSES_P = BLOCK - {"body", "html", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"}
#: An opening tag ends open ones of these names, up to the element named.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: Words of a class or id that mark what is no article.
MARKS = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs byline comment comments commentlist consent cookie cookies copyright disqus "
    "dropdown footer gdpr header hidden legal login masthead menu modal nav navbar navigation newsletter notice notices overlay pagination pager paywall "
    "popup promo promoted promotion recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription tags toc toolbar topbar widget widgets".split()
)
KEPT = frozenset("article main body html".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*>", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z0-9]+")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "marks", "hidden", "parts", "digest", "words")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.marks, self.hidden, self.parts = tag, (), False, []
        if attrs.strip():
            found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)}
            label = f"{found.get('class', '')} {found.get('id', '')} {found.get('role', '')}".lower()
            self.marks = _WORD.findall(label)
            self.hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()

    def boilerplate(self) -> bool:
        return self.hidden or self.tag in DROPPED or self.tag not in KEPT and not MARKS.isdisjoint(self.marks)


def tree(source: str) -> Node:
    """The page's element tree; unclosed and misplaced tags are mended the way
    browsers do it for common cases."""
    root = Node("html")
    stack, at = [root], 0

    def close(to: int) -> None:
        del stack[to:]

    while m := _TOKEN.search(source, at):
        if m.start() > at:
            stack[-1].parts.append(source[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
                if stack[i].tag in KEPT and tag not in BLOCK:
                    break
            continue
        if tag in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag in BLOCK:
                    break
        if tag in ENDS:
            names, bound = ENDS[tag]
            low = None
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in bound:
                    break
                if stack[i].tag in names:
                    low = i
            if low is not None:
                close(low)
        if tag in ("html", "body") and any(x.tag == tag for x in stack[1:]):
            continue
        node = Node(tag, m[3])
        stack[-1].parts.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(source, at)
            node.tag = "script"
            close_ = source.find(">", end.start()) if end else -1
            at = close_ + 1 if close_ >= 0 else len(source)
        elif tag not in VOID and not m[3].rstrip().endswith("/") or tag in BLOCK and tag != "hr":
            stack.append(node)
    if at < len(source):
        stack[-1].parts.append(source[at:])
    return root


def _walk(root: Node) -> list[tuple[Node, bool]]:
    """(element, inside the article) with parents before children."""
    out, stack = [], [(root, False)]
    while stack:
        node, inside = stack.pop()
        out.append((node, inside))
        inner = inside or node.tag in ("article", "main")
        stack.extend((p, inner) for p in node.parts if isinstance(p, Node))
    return out


def digests(root: Node) -> list[tuple[Node, bool]]:
    """Sets each element's digest, from its tag, words and children, and its
    number of words."""
    nodes = _walk(root)
    for node, _ in reversed(nodes):
        h = blake2b(node.tag.encode(), digest_size=8)
        node.words = 0
        if node.tag != "script":
            for p in node.parts:
                if isinstance(p, Node):
                    h.update(p.digest)
                    node.words += p.words
                else:
                    own = p.split()
                    h.update(" ".join(own).encode("utf-8", "replace"))
                    node.words += len(own)
        node.digest = h.digest()
    return nodes


def number(digest: bytes) -> int:
    return int.from_bytes(digest, "big", signed=True)


def boxes(nodes: list[tuple[Node, bool]]) -> list[Node]:
    """Elements that can be template: blocks that do not hold an article, with
    less than half of the page's or (inside) the articles' words."""
    holds: set[int] = set()
    for node, _ in reversed(nodes):
        if node.tag in KEPT or any(isinstance(p, Node) and id(p) in holds for p in node.parts):
            holds.add(id(node))
    page = nodes[0][0].words
    articles = sum(n.words for n, inside in nodes if n.tag in ("article", "main") and not inside)
    return [n for n, inside in nodes if n.tag in BLOCK and 2 * n.words < max(1, articles if inside else page) and id(n) not in holds and n.parts]


def blocks(root: Node, template: frozenset[int] = frozenset()) -> list[str]:
    """The article's blocks in page order, without template and boilerplate.
    The page has an article if an article or main element (that stands in no
    boilerplate) has words; else all of the body counts.  An article of
    template alone stays whole."""
    out = _lines(root, template)
    article = [line for inside, line in out if inside]
    if template and not article:
        article = [line for inside, line in _lines(root) if inside]
    return article or [line for _, line in out]


def body(root: Node) -> int:
    """A key of the page's text without boilerplate: the least hash of its
    shingles, so near copies have the same one as likely as they share one."""
    words = " ".join(blocks(root)).split()
    return min((crc32(" ".join(words[k : k + SHINGLE]).encode("utf-8", "replace")) for k in range(max(1, len(words) - SHINGLE + 1))), default=0)


def _lines(root: Node, template: frozenset[int] = frozenset()) -> list[tuple[bool, str]]:
    """(inside the article, block) without template, then boilerplate."""
    out: list[tuple[bool, str]] = []
    text: list[str] = []

    def flush(inside: bool) -> None:
        if text:
            line = _SPACE.sub(" ", html.unescape("".join(text))).strip()
            if line:
                out.append((inside, line))
            text.clear()

    may_go = {id(n) for n in boxes(_walk(root))} if template else ()
    # entries: element or text, inside the article, inside its header; or an end
    stack: list = [(root, False, False)]
    while stack:
        item, inside, header = stack.pop()
        if item is None:
            flush(inside)
        elif isinstance(item, str):
            if not header:
                text.append(item)
        elif item.tag == "br":
            text.append(" ")
        elif template and id(item) in may_go and number(item.digest) in template or item.boilerplate() or item.tag == "header" and not inside:
            if item.tag in BLOCK:
                flush(inside)
        else:
            inner = inside or item.tag in ("article", "main")
            headed = item.tag == "header" or header and item.tag not in HEADINGS
            block = item.tag in BLOCK
            if block:
                flush(inside)
                stack.append((None, inner, headed))
            for p in reversed(item.parts):
                stack.append((p, inner, headed))
    flush(False)
    return out


def _parsed(batch: pa.RecordBatch) -> Iterator[Node]:
    for x in batch["html"]:
        yield tree(x.as_py() or "")


def subtrees(pages: DataFrame) -> DataFrame:
    """pages(url, html) -> (host, page, body, hashes): the page's digest, its
    body's key and the digests of its boxes, a row for each page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            page, bodies, hashes = [], [], []
            for root in _parsed(batch):
                nodes = digests(root)
                page.append(number(root.digest))
                bodies.append(body(root))
                hashes.append(sorted({number(n.digest) for n in boxes(nodes)}))
            yield pa.RecordBatch.from_arrays([batch["host"], pa.array(page, pa.int64()), pa.array(bodies, pa.int64()), pa.array(hashes, pa.list_(pa.int64()))], names=["host", "page", "body", "hashes"])

    return pages.select(host(F.col("url")).alias("host"), "html").mapInArrow(run, "host string, page long, body long, hashes array<long>")


def site_templates(found: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, body, hashes) -> (host, hash) of subtrees on pages of at least
    ``min_pages`` different bodies of the host and ``min_share`` of them."""
    each = found.select("host", "body", F.explode("hashes").alias("hash")).distinct()
    often = each.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= min_pages)
    hosts = found.select("host", "body").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("all"))
    return often.join(hosts, "host").filter(F.col("pages") >= min_share * F.col("all")).select("host", "hash")


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, carry: tuple[str, ...] = ("page_id", "url"), min_share: float = MIN_SHARE) -> DataFrame:
    """pages(url, html, ..) -> (row, text): the main text, blocks joined by
    line breaks; ``row`` is a struct of the columns named by ``carry``.

    Null and empty pages have an empty text.  Pages without a host share one
    (empty) host.  Repeated pages have a row each and one template.
    """
    found = stage(subtrees(pages), "subtrees")
    sites = site_templates(found, min_pages, min_share)
    own = found.groupBy("host", "page").agg(F.first("hashes").alias("hashes")).select("host", "page", F.explode("hashes").alias("hash"))
    template = own.join(sites, ["host", "hash"]).groupBy("host", "page").agg(F.sort_array(F.collect_list("hash")).alias("template"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zstandard import ZstdCompressor

        pack = ZstdCompressor(level=3).compress
        for batch in batches:
            page, packed = [], []
            for x, root in zip(batch["html"], _parsed(batch)):
                digests(root)
                page.append(number(root.digest))
                packed.append(pack((x.as_py() or "").encode()))
            yield pa.RecordBatch.from_arrays([batch["row"], batch["host"], pa.array(page, pa.int64()), pa.array(packed, pa.binary())], names=["row", "host", "page", "packed"])

    rows = pages.select(F.struct(*carry).alias("row"), host(F.col("url")).alias("host"), "html")
    row = rows.schema["row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zstandard import ZstdDecompressor

        unpack = ZstdDecompressor().decompress
        for batch in batches:
            texts = []
            for x, t in zip(batch["packed"], batch["template"]):
                root = tree(unpack(x.as_py()).decode())
                gone = frozenset(t.as_py() or ())
                if gone:
                    digests(root)
                texts.append("\n".join(blocks(root, gone)))
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(texts, pa.string())], names=["row", "text"])

    from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

    packed = rows.mapInArrow(keyed, StructType([row, StructField("host", StringType()), StructField("page", LongType()), StructField("packed", BinaryType())]))
    joined = packed.join(template, ["host", "page"], "left").select("row", "packed", "template")
    return joined.mapInArrow(run, StructType([row, StructField("text", StringType())]))
