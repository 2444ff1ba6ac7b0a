"""Site style tree (2) and WARC revisits (8)."""

import base64
import hashlib
import html
import re

import pytest

from feedmetrics.llm import site_style_tree as sst
from feedmetrics.llm import warc


def text_of(page, remove=()):
    return sst.Walker(dict.fromkeys(remove, 0.0), 0.5).finish(page).text()


@pytest.mark.parametrize(("page", "text"), [
    ("", ""), ("<p>", ""), ("a&amp;b", "a&b"), ("<!-- x", ""), ("</p></b>t", "t"), ("<script>a</scr", ""),
    ("<article><p>a<b>b</p>c<ul><li>1<li>2</ul><div class='share'>s</div></article><p>out", "ab\nc\n1\n2"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
    ("<article><header><h1>T</h1><p>by</p></header><p>x  \n y</p></article>", "T\nx y"),
    ("<nav>n</nav><main><p>m</p><form>f</form></main><footer>f</footer>", "m"),
    ("<article><p>x<section id=comments><p>c</p></section></article>", "x"),
    ("<article><p>1 &lt; 2 &#233; &nbsp;z<br>w</p></article>", "1 < 2 é z w"),
    ("<script>var t='</p>';</script><article><style>p{}</style><p title='a>b'>x</p></article>", "x"),
])
def test_main_text(page, text):
    assert text_of(page) == text


def test_deep_and_long_pages():
    assert text_of("<div>" * 20000 + "x") == "x"
    assert text_of("<article><p>" + "w " * 300000 + "</p></article>") == ("w " * 300000).strip()
    sst.Walker().finish("<div>" * 5000 + "x")


def test_repeated_branches_go_and_changing_ones_stay(spark):
    def page(i):
        return f"<body><div class=box>Same words on every page</div><div class=story>Story {i} tells of {i * 7}</div></body>"

    pages = spark.createDataFrame([(i, f"http://a.example/{i}", page(i)) for i in range(30)]
                                  + [(100, "http://b.example/", page(5)), (101, None, None), (102, "odd", ""), (0, "http://a.example/0", page(0))], "page_id long, url string, html string")
    got = {(r["page_id"], r["text"]) for r in sst.extract(pages.selectExpr("*", "1 as n_chars", "'x' as text")).collect()}
    assert got == ({(i, f"Story {i} tells of {i * 7}") for i in range(30)}
                   | {(100, "Same words on every page\nStory 5 tells of 35"), (101, ""), (102, "")})  # a host of one page keeps all
    assert sst.extract(pages.limit(0)).count() == 0


def test_the_tree_alone_removes_what_partly_changes(spark):
    """Neutral elements without a telling tag or name: menus with a word that changes, notices and adverts dealt from a few."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()

    def page(i):
        menu = " ".join(f"<span><a href='/s{k}'>{w}</a></span>" for k, w in enumerate(words[:8]))
        story = " ".join(f"w{(i * 31 + k * k * 7) % 997}" for k in range(40))
        return (f"<body><div class=xa><div>{menu} <span>here{i}</span></div></div><div class=xb>Our site keeps small files on your device, please agree {i % 2}</div>"
                f"<div class=xc><div><span>{story}</span></div></div><div class=xd><img src='/b{i % 3}.png'>Buy now, cheap offers {i % 3}</div></body>")

    pages = spark.createDataFrame([(i, f"http://a.example/{i}", page(i)) for i in range(40)], "page_id long, url string, html string")
    for r in sst.extract(pages).collect():
        assert r["text"] == " ".join(f"w{(r['page_id'] * 31 + k * k * 7) % 997}" for k in range(40)) and r["n_removed"] >= 3
    few = sst.extract(pages.limit(5)).collect()
    assert all(r["n_removed"] == 0 and "Buy now" in r["text"] for r in few)  # too few pages to tell


@pytest.mark.parametrize(("page", "text"), [
    ('<article class="post no-sidebar"><p>a</p></article>', "a"), ('<article class="comments-open"><p>a</p></article>', "a"),
    ('<article><p id="notice-period">n</p><p>a</p></article>', "n\na"), ('<article><p class="ad">n</p><p>a</p></article>', "a"),
    ('<article><p>a</p><div class="comment-list"><p>c</p></div></article>', "a"), ('<main class="has-sidebar"><p>a</p></main>', "a"),
])
def test_names_do_not_take_the_article(page, text):
    assert text_of(page) == text


def test_what_the_tree_removes_on_the_given_pages(spark):
    """Nothing: menu, advert and footer of each given page have words of their own, which no count over pages tells from
    content (their names and tags do). All nodes are judged and none is below the threshold."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")  # the smaller tables have too few pages a host
    low = sst.tree(pages).agg({"importance": "min", "path": "count"}).first()
    assert low["count(path)"] > 100 and low["min(importance)"] > 0.3
    assert sst.extract(pages).where("n_removed > 0").count() == 0


def test_importance_is_the_entropy(spark):
    pages = spark.createDataFrame([(i, "http://h.example/", f"<div class=c>{'ab'[i % 2]}</div>") for i in range(16)], "page_id long, url string, html string")
    (node,) = sst.tree(pages, weight=1.0).collect()
    assert node["importance"] == pytest.approx(0.25)  # one bit of four


def test_given_pages_against_a_plain_parser(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in sst.extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        text = "\n".join(x for x in blocks if x)
        assert got[r["page_id"]] == (text, len(text))


def brute_warc(rows, least):
    out = []
    for page, _, page_html in rows:
        raw = (page_html or "").encode()
        sha = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        best = max((p for p, _, h in rows if (h or "").encode() == raw), key=lambda p: -1 if p is None else p)
        revisit = len(raw) >= least and page != best
        out.append((page, len(raw), sha, "revisit" if revisit else "response", best if revisit else None))
    return sorted(out, key=repr)


PAGES = [(1, "http://a/", "x"), (2, "http://b/\r\nWARC-Type: evil", "x"), (3, None, "long é" * 50000), (4, "u", None), (5, "u", ""), (6, "v", "x"), (7, "w", "yy"), (8, "w", "long é" * 50000), (None, "n", "yy")]


@pytest.mark.parametrize("least", [0, 2])
def test_revisits_against_brute_force(spark, scratch, least):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 as payload_bytes", "'a' as file")
    got = warc.deduplicated_archives(pages, f"{scratch}/w", least).collect()
    assert sorted((tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in got), key=repr) == brute_warc(PAGES, least)
    by_id = {r["record_id"]: r for r in got}
    assert len(by_id) == len(PAGES)
    for r in got:
        if r["record_type"] == "revisit":
            original = by_id[r["refers_to_record"]]
            assert original["record_type"] == "response" and original["payload_digest"] == r["payload_digest"]


def test_one_original_among_repeated_rows(spark, scratch):
    pages = spark.createDataFrame([(1, "a", "x")] * 3, "page_id long, url string, html string").repartition(3)
    got = warc.deduplicated_archives(pages, f"{scratch}/w").collect()
    assert sorted(r["record_type"] for r in got) == ["response", "revisit", "revisit"]
    assert warc.deduplicated_archives(pages.limit(0), f"{scratch}/e").count() == 0
