"""Main text of web pages by a site style tree.

The DOMs of the pages of one host are merged: the pages' elements that share a path (tags with
their classes from the root) are one node of the host's tree. A node keeps how often each
presentation (the sequence of its child elements) occurs, and for each feature of its own content (words,
links, images) how it is spread over the pages.

Importance is entropy. A feature that is the same on all m pages of a node has entropy 1 to the base m and tells
nothing, one of a single page has entropy 0. A node's content importance is 1 less the mean entropy of the features in its
branch, each by its occurrences, so a menu stays unimportant though one of its words changes from page to page. Its
presentation importance is the entropy of the presentations in its branch. The composite importance is the weighted mean
of both; what the children have flows to all nodes above them. A node seen on less than ``min_pages``
pages says too little and counts as important. All counts are Spark aggregations with
partial sums, so a host with most of the pages is merged by all tasks.

From each page, branches that the tree finds unimportant are removed. Elements that are never shown or are
controls (scripts, styles, forms ...) are no content on any page, and named elements (navigation, adverts, reader
comments, whose words do differ from page to page) go by their names: by any word of a class, id or role, but
not the article or main element itself, and running text in an article only by a whole class name. Running text inside
an article (paragraphs, headings, lists, tables) is content by its meaning and is not judged by
repetition. If the page has an article, the text is the article's; else that of its main
element; else what is left of the body.

Defined cases: a null or empty html has the empty text; a null or odd url counts as one host; repeated pages
are extracted each; very long pages and deep nesting are handled without recursion; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmetrics.llm.common import column, saved, slices

# Elements by their meaning in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NOT_CONTENT = frozenset("head nav footer aside form script style noscript template iframe object embed svg canvas button select option "
                        "textarea input dialog menu audio video map datalist fieldset label".split())
RUNNING_TEXT = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol li dl dt dd table thead tbody tfoot tr td th caption figure figcaption".split())
BLOCK = RUNNING_TEXT | frozenset("html body article main section div header footer nav aside form address hr center fieldset details summary hgroup".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words in class, id or role that name what is not the article.
NOT_CONTENT_NAMES = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb "
                              "breadcrumbs sidebar widget footer header masthead cookie cookies consent notice notices alert popup modal overlay newsletter "
                              "subscribe signup login share sharing social related recommended comment comments disqus reply replies pagination pager toolbar".split())
# Which open elements an opening tag closes, and where the search for them ends.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("html body article main section div header footer nav aside form table ul ol dl td th li blockquote button".split())

NOT_JUDGED = frozenset("html body main article head".split())
NAME = re.compile(r"[a-z]+")
#: Judged elements above one to which its content flows, the nearest ones.
DEEPEST = 64


@lru_cache(100_000)
def label(tag: str, attrs: str) -> tuple[str, bool, bool]:
    """(tag with the words of its classes, whether a word of its class, id or role names something else than
    content, whether a whole one of them does)."""
    if "=" not in attrs:
        return tag, False, False
    values = [v.lower() for _, v in ATTRIBUTE.findall(attrs)]
    words = {w for v in values for w in NAME.findall(v)}
    if not words:
        return tag, False, False
    named = tag not in ("html", "body", "article", "main")
    whole = {w for v in values for w in v.strip("\"'").split()}
    return f"{tag}.{' '.join(sorted(words))}", named and not NOT_CONTENT_NAMES.isdisjoint(words), named and not NOT_CONTENT_NAMES.isdisjoint(whole)


def number(*parts: object) -> int:
    """A stable signed 64-bit number of its arguments."""
    return int.from_bytes(hashlib.blake2b(repr(parts).encode(), digest_size=8).digest(), "little", signed=True)


@lru_cache(200_000)
def feature(text: str) -> int:
    """The number of a word, link or image."""
    return number(text)


@lru_cache(100_000)
def node_path(parent: int, name: str) -> int:
    """The number of the path that ends in ``name`` below ``parent``."""
    return number(parent, name)


# Markup: a tag with its attributes (quoted values may hold ">"), a comment, or a declaration.
MARKUP = re.compile(r"""<(?:(/?)([A-Za-z][^\s/>]*+)((?:"[^"]*+"|'[^']*+'|[^>"'])*+>|[^>]*+>)|!--.*?(?:-->|\Z)|[!?/][^>]*+(?:>|\Z))""", re.S)
ATTRIBUTE = re.compile(r"""(?:^|[\s/"'])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
#: What a link or image refers to.
REFERENCE = re.compile(r"""(?:^|[\s/"'])(href|src)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
# Elements whose content is text up to their own end tag.
RAW = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in ("script", "style", "textarea", "title", "iframe", "noframes", "noembed", "xmp")}


def unescape(text: str) -> str:
    """Character references decoded; the common case of only ``&amp;`` without a pattern."""
    if (n := text.count("&")) == 0:
        return text
    return text.replace("&amp;", "&") if n == text.count("&amp;") else html.unescape(text)


class Open:
    """An open element: its path in the tree, and what is known of its branch so far."""

    __slots__ = ("tag", "path", "styles", "drop", "zone", "judged")

    def __init__(self, tag: str, path: int, drop: bool, zone: int, judged: bool):
        self.tag, self.path, self.drop, self.zone, self.judged = tag, path, drop, zone, judged
        self.styles: list[str] = []


class Walker:
    """Walks a page once, in document order, closing elements as HTML implies.

    Without ``importance`` it only lists what the tree counts: the presentations of judged elements as (path,
    presentation) in ``seen``, the features of their own content in ``features``, and in ``above`` the judged
    paths from the root to each. With it, it removes branches and collects blocks of
    text as (zone, text); zones are 0 for the body, 1 inside main, 2 inside an article."""

    def __init__(self, importance: dict[int, float] | None = None, threshold: float = 0.0):
        self.collect = importance is None
        self.importance, self.threshold = importance or {}, threshold
        self.stack = [Open("", 0, False, 0, False)]
        self.blocks: list[tuple[int, str]] = []
        self.line: list[str] = []
        self.seen: list[tuple[int, int]] = []
        self.features: Counter = Counter()
        self.above: dict[int, list[int]] = {}
        self.removed = 0
        self.in_judged: list[Open] = []

    def flush(self, zone: int) -> None:
        if self.line:
            text = " ".join("".join(self.line).split())
            if text:
                self.blocks.append((zone, text))
            self.line = []

    def pop(self) -> None:
        e = self.stack.pop()
        if e.tag in BLOCK:
            self.flush(e.zone)
        if self.collect and e.judged:
            self.in_judged.pop()
            self.seen.append((e.path, number(*e.styles)))

    def start(self, tag: str, attrs: str) -> None:
        if tag in BLOCK:
            self.close_to({"p"} if tag not in CLOSES else {"p"} | CLOSES[tag])
        elif tag in CLOSES:
            self.close_to(CLOSES[tag])
        up = self.stack[-1]
        if tag in VOID:
            if tag == "img" and self.collect and self.in_judged:
                self.refer(attrs)
            if tag == "br":
                self.line.append(" ")
            elif tag == "hr":
                self.flush(up.zone)
            return
        if tag in BLOCK:
            self.flush(up.zone)
        name, named, whole = label(tag, attrs)
        path = node_path(up.path, name)
        if not up.styles or up.styles[-1] != name:  # runs of like children are one presentation
            up.styles.append(name)
        zone = 2 if tag == "article" else max(up.zone, tag == "main")
        text = zone == 2 and (tag in RUNNING_TEXT or tag not in BLOCK)
        other = (whole if zone == 2 and tag in RUNNING_TEXT else named) or tag in NOT_CONTENT or (tag == "header" and zone < 2) or (up.tag == "header" and tag not in HEADINGS)
        judged = not (up.drop or text or tag in NOT_JUDGED)
        unimportant = judged and self.importance.get(path, 1.0) < self.threshold
        self.removed += unimportant
        drop = up.drop or other or unimportant
        e = Open(tag, path, drop, zone, judged)
        self.stack.append(e)
        if judged and self.collect:
            self.in_judged.append(e)
            if path not in self.above:
                self.above[path] = [x.path for x in self.in_judged[-DEEPEST:]]
        if self.collect and self.in_judged and tag == "a":
            self.refer(attrs)

    def refer(self, attrs: str) -> None:
        for _, v in REFERENCE.findall(attrs):
            self.features[self.in_judged[-1].path, feature(v)] += 1

    def close_to(self, tags: set[str]) -> None:
        """Close the nearest open element of ``tags``, unless a container stands between."""
        for i in range(len(self.stack) - 1, 0, -1):
            t = self.stack[i].tag
            if t in tags:
                while len(self.stack) > i:
                    self.pop()
                return
            if t in SCOPE:
                return

    def end(self, tag: str) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            t = self.stack[i].tag
            if t == tag:
                while len(self.stack) > i:
                    self.pop()
                return
            if tag not in BLOCK and t in BLOCK and tag not in NOT_CONTENT:
                return  # a stray end of an inline element

    def data(self, text: str) -> None:
        if self.collect:
            if self.in_judged:
                path = self.in_judged[-1].path
                for w in text.split():
                    self.features[path, feature(w)] += 1
        elif not (e := self.stack[-1]).drop and e.tag != "header":
            self.line.append(unescape(text))

    def finish(self, page: str) -> Walker:
        at = 0
        while (m := MARKUP.search(page, at)) is not None:
            if m.start() > at:
                self.data(page[at:m.start()])
            at, tag = m.end(), m[2]
            if tag is None:
                continue
            tag = tag.lower()
            if m[1]:
                self.end(tag)
                continue
            self.start(tag, m[3])
            if tag in RAW:
                close = RAW[tag].search(page, at)
                self.data(page[at:close.start() if close else len(page)])
                self.end(tag)
                at = close.end() if close else len(page)
        if at < len(page):
            self.data(page[at:])
        while len(self.stack) > 1:
            self.pop()
        self.flush(0)
        return self

    def text(self) -> str:
        best = max((z for z, _ in self.blocks), default=0)
        return "\n".join(t for z, t in self.blocks if z == best)


HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def host_of(url_col) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(url_col, F.lit("")), HOST, 1))


def counted(pages: DataFrame) -> DataFrame:
    """(host, path, kind, value, n, s, above): per node its presentations (kind 0), features (1, with the sum of
    n ln n over pages in ``s``) and pages (2, with the judged paths from the root to it)."""
    layout = "host string, path long, kind int, value long, n long, s double, above array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in slices(big, "html", 8 << 20):
                n: Counter = Counter()
                spread: Counter = Counter()
                above: dict = {}
                for host, page in zip(column(b, "host").to_pylist(), column(b, "html").to_pylist(), strict=True):
                    w = Walker().finish(page or "")
                    for path, style in w.seen:
                        n[host, path, 0, style] += 1
                    for (path, value), k in w.features.items():
                        n[host, path, 1, value] += k
                        if k > 1:
                            spread[host, path, 1, value] += k * math.log(k)
                    for path, chain in w.above.items():
                        n[host, path, 2, 0] += 1
                        above[host, path, 2, 0] = chain
                if n:
                    h, p, kind, v = zip(*n, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(h, pa.string()), pa.array(p, pa.int64()), pa.array(kind, pa.int32()), pa.array(v, pa.int64()), pa.array(n.values(), pa.int64()),
                                                      pa.array([spread.get(k, 0.0) for k in n], pa.float64()), pa.array([above.get(k) for k in n], pa.list_(pa.int64()))],
                                                     ["host", "path", "kind", "value", "n", "s", "above"])

    rows = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(run, layout)
    return rows.groupBy("host", "path", "kind", "value").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.max("above").alias("above"))


def tree(pages: DataFrame, weight: float = 0.8, min_pages: int = 8) -> DataFrame:
    """The nodes of all hosts' style trees: host, path, importance (saved)."""
    kind, n = F.col("kind"), F.col("n").cast("double")
    # With N occurrences and sum S of n ln n over its m pages, a feature's entropy is (ln N - S / N) / ln m, and its share of
    # a branch's mean is N; likewise a node's presentations, whose entropy is to the base of their number.
    nodes = saved(counted(pages).groupBy("host", "path").agg(
        F.max(F.when(kind == 2, F.col("n"))).alias("m"), F.max("above").alias("above"),
        F.coalesce(F.sum(F.when(kind == 1, n)), F.lit(0.0)).alias("w"), F.coalesce(F.sum(F.when(kind == 1, n * F.log(n) - F.col("s"))), F.lit(0.0)).alias("wh"),
        F.coalesce(F.sum(F.when(kind == 0, n)), F.lit(0.0)).alias("k"), F.coalesce(F.sum(F.when(kind == 0, n * F.log(n))), F.lit(0.0)).alias("ks")), "style-nodes")
    known = F.col("m") > 1
    own = nodes.select("host", F.explode("above").alias("path"), "w", F.when(known, F.col("wh") / F.log("m")).otherwise(0.0).alias("wh"),
                       "k", F.when(F.col("k") > 1, F.col("k") - F.col("ks") / F.log("k")).otherwise(F.col("k")).alias("kh"))
    branch = own.groupBy("host", "path").agg(*[F.sum(c).alias(c) for c in ("w", "wh", "k", "kh")])
    shown = F.when(F.col("k") > 0, F.col("kh") / F.col("k")).otherwise(0.0)
    content = F.when(F.col("w") > 0, 1 - F.col("wh") / F.col("w")).otherwise(shown)
    judged = nodes.where(F.col("m") >= min_pages).select("host", "path").join(branch, ["host", "path"])
    return saved(judged.select("host", "path", (weight * content + (1 - weight) * shown).alias("importance")), "style-tree")


def extract(pages: DataFrame, threshold: float = 0.3, weight: float = 0.8, min_pages: int = 8) -> DataFrame:
    """Per page: page_id, url, text, n_chars (code points of the text), n_removed (elements that the tree removed).

    Only the nodes to remove join the pages, as one array per host: their number is that of
    templates, not of pages."""
    remove = (tree(pages, weight, min_pages).where(F.col("importance") < threshold)
              .groupBy("host").agg(F.collect_set("path").alias("paths")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in slices(big, "html", 8 << 20):
                walked = [Walker(dict.fromkeys(p or [], 0.0), 0.5).finish(h or "") for h, p in zip(column(b, "html").to_pylist(), column(b, "paths").to_pylist(), strict=True)]
                texts = [w.text() for w in walked]
                yield pa.RecordBatch.from_arrays([column(b, "page_id"), column(b, "url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), pa.array([w.removed for w in walked], pa.int64())],
                                                 ["page_id", "url", "text", "n_chars", "n_removed"])

    rows = (pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host")).join(saved(remove, "style-remove"), "host", "left")
            .select("page_id", "url", "html", "paths"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long, n_removed long")
