"""URL filters against a plain loop, HTML extraction on hand-written pages."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from wareflow.llm import html_extraction, queries, url_filter

SF = "/root/testdata/sf0.001"


def judged(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
        path = rest[end:].split("?")[0].split("#")[0]
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_url_filter_against_a_loop(spark):
    rng = random.Random(1)
    hosts = ["org", "a.org", "b.a.org", "com", "x.com", "notorg", ".org", "A.Org", "münchen.de"]
    paths = ["", "/", "/en/", "/en/1", "/en/12/x", "/de/", "/a?b/en/1", "#/en/1", "/en/1#x?y"]
    urls = [f"{s}{h}{p}" for s in ("https://", "http://", "", "x://y://") for h in hosts for p in paths] + [None, "", "://", "https://"]
    rules = [(h, p, rng.choice(["allow", "block"])) for h in ("org", "a.org", "com", "x.com", "münchen.de") for p in ("/", "/en/", "/en/1", "") if rng.random() < 0.6]
    pages = spark.createDataFrame([(i, u, "old") for i, u in enumerate(urls)] + [(0, urls[0], "old")], "page_id long, url string, verdict string")
    listed = spark.createDataFrame(rules + [(None, "/", "block"), ("", "/", "block")], "host string, path string, verdict string")
    got = url_filter.filter_urls(pages, listed).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == judged(r["url"], rules), r["url"]
    none = url_filter.filter_urls(pages, listed.limit(0)).collect()
    assert {(r["rule"], r["verdict"]) for r in none} == {(None, "allow")}
    assert url_filter.filter_urls(pages.limit(0), listed).count() == 0


def test_bloom_filter_lets_all_listed_through(spark):
    """Many listed urls in few blocks: false hits are removed, no listed one is lost."""
    rules = [(f"h{i}.net", f"/p{i % 7}/", "block") for i in range(3000)]
    pages = spark.createDataFrame([(i, f"http://w.h{i}.net/p{i % 7}/x") for i in range(4000)], "page_id long, url string")
    got = url_filter.filter_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert sorted(r["page_id"] for r in got.where("verdict = 'block'").collect()) == list(range(3000))


@pytest.mark.parametrize("name", [n for n, (_, sql) in queries.QUERIES.items() if sql])
def test_queries_against_duckdb(spark, name):
    con = duckdb.connect()
    for table in ("pages", "documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    run, sql = queries.QUERIES[name]
    df = run(spark, SF)
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(con.execute(f"SELECT {', '.join(df.columns)} FROM ({sql})").fetchall(), key=repr)


ARTICLE = "<article><h1>Title &amp; more</h1><p>First   <b>bold</b>\n text<br>after break<p>Second &lt;x&gt; &#233;</p><ul><li>one<li>two</ul></article>"
TEXT = "Title & more\nFirst bold text\nafter break\nSecond <x> é\none\ntwo"


@pytest.mark.parametrize(
    "page,want",
    [
        (None, ""),
        ("", ""),
        ("plain words", "plain words"),
        (f"<html><head><title>t</title><script>var a='</p>';</script></head><body><nav><ul><li>Menu</ul></nav>{ARTICLE}<footer>foot</footer></body></html>", TEXT),
        (f"<body><header>Site</header><div class='ad'>Buy now</div>{ARTICLE}<aside>Side</aside><form>mail <input></form>", TEXT),
        (f"<body>{ARTICLE.replace('</article>', '<div class=comments><p>nice</div><div class=share>x</div></article>')}<section id='comments'>long reader text</section>", TEXT),
        ("<body><div class='menu'><a href=x>a</a></div><div class='post-17'><p>One two three.<p>Four</div></body>", "One two three.\nFour"),
        ("<body><article><p>a < b <!-- no --> c</article>", "a < b c"),
    ],
)
def test_page_text(page, want):
    assert html_extraction.page_text(page, html_extraction.page_path(page)) == want


def test_extract_votes_per_host(spark):
    post = "<body><div class='x9'><p>{}</div><div class='box'><p>{}</div>"
    rows = [(i, "http://a.b/1", post.format("main text of this page " * 5, "box")) for i in range(5)]
    # on one page the other container is larger; the host's path decides
    rows += [(9, "http://a.b/2", post.format("short main", "much longer text in the box " * 9)), (10, None, "<p>x"), (11, "http://c.d/", None), (11, "http://c.d/", None)]
    pages = spark.createDataFrame([(*r, "old") for r in rows], "page_id long, url string, html string, text string")
    got = html_extraction.extract(pages)
    assert got.columns == ["page_id", "url", "html", "text"]
    texts = {r["page_id"]: r["text"] for r in got.collect()}
    assert texts[9] == ("much longer text in the box " * 9).strip() and texts[11] == "" and got.count() == len(rows)
    assert html_extraction.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page,want",
    [
        ("<html><h1>T</h1><p>long text</p>", "T\nlong text"),
        ("<title>t</title><h1>T</h1><p>long text<p>more", "T\nlong text\nmore"),
        ("<!DOCTYPE html><html><head><title>t</title><h1>T</h1><p>long text", "T\nlong text"),
        ("<head><meta charset=utf-8><title>t</title><body><p>long text</p></body>", "long text"),
        ("<head><title>t</title>words first<p>then a block", "words first\nthen a block"),
        ("<html><nav>Menu</nav><p>text between</p><footer>foot</footer>", "text between"),
        ("<p><a href='/'>only a link</a></p>", "only a link"),
        ("<h1>T</h1><p>words all around the box</p><div>box</div>", "T\nwords all around the box\nbox"),
    ],
)
def test_page_without_body(page, want):
    assert html_extraction.page_text(page, html_extraction.page_path(page)) == want


LONG = "The whole article stands here, with many words. " * 4


@pytest.mark.parametrize(
    "attributes",
    [
        "class='content has-sidebar'", "class='page no-comments'", "id='header-and-content'", "class='layout-with-sidebar'", "class='page_without_ads'",
        "class='header'", "class='share-price-news'", "id='search'", "class='my-search-results'", "class='widget wide'",
    ],
)
def test_names_around_the_article(attributes):
    page = f"<body><nav>Menu</nav><div {attributes}><h1>T</h1><p>{LONG}</p><div class='share'>x</div></div><div class='site-footer'>foot</div></body>"
    assert html_extraction.page_text(page, html_extraction.page_path(page)) == f"T\n{LONG.strip()}"


def test_names_inside_the_article():
    kept = "<div class='no-ads'>one</div><div class='two-column-search-box'>two</div>"
    gone = "<div class='post-comments'>a</div><div class='ad-slot'>b</div><div id='left-sidebar'>c</div><div class='newsletter'>d</div><div role='search'>e</div>"
    page = f"<body><article><p>{LONG}</p>{kept}{gone}</article>"
    assert html_extraction.page_text(page, html_extraction.page_path(page)) == f"{LONG.strip()}\none\ntwo"
    # readers' comments may be longer than the article; a form may hold the whole page
    page = f"<body><div class='post'><p>Short text.</p></div><div id='comments'><p>{LONG}</p></div></body>"
    assert html_extraction.page_text(page, html_extraction.page_path(page)) == "Short text."
    for side in ("class='ad'", "class='menu'", "id='cookie'"):
        page = f"<body><div {side}>{LONG}</div><article><h1>T</h1><p>Short text.</p></article></body>"
        assert html_extraction.page_text(page, html_extraction.page_path(page)) == "T\nShort text."
    page = f"<body><form id='aspnetForm'><div class='menu'><a href='/'>Home</a></div><div><p>{LONG}</p></div></form></body>"
    assert html_extraction.page_text(page, html_extraction.page_path(page)) == LONG.strip()


@pytest.mark.parametrize(
    "page",
    [
        "<body><div class='post'><h1>T</h1><p>lead</p><div class='entry'><p>{}</p></div></div>",
        "<body><div class='post'><div class='head'><h1>T</h1><p>lead</p></div><div class='entry'><p>{}</p></div></div>",
        "<body><h1>T</h1><p>lead</p><div class='x'><p>{}</p></div>",
        "<body><div class='top'><h1>T</h1><p>lead</p></div><div class='box'>box</div><div class='entry'><p>{}</p></div>",
        "<body><table><tr><td>T<tr><td>lead<tr><td><p>{}</p></table>",
        "<body><h1>T</h1><p>lead</p><article><p>{}</p></article><p><a href='/'>Home</a> | <a href='/up'>Up</a></p>",
        "<body><div id='page'><h1>T</h1><p>lead</p><div class='entry'><p>{}</p></div></div>",
        "<html><body><h1>T</h1><p>lead</p><main><div><p>{}</p></div></main></body></html>",
    ],
)
def test_title_and_lead_beside_a_long_body(page):
    page = page.format(LONG * 5)
    assert html_extraction.page_text(page, html_extraction.page_path(page)) == f"T\nlead\n{(LONG * 5).strip()}"


def test_extract_with_several_templates(spark):
    # a host with two templates, the smaller one with a box under the other's path; pages without a host; a host without agreement
    news, shop = "<body><div class='x'><p>{}</div>", "<body><div class='x'>box</div><div class='y'><p>{}</div>"
    rows = [(i, "http://a.b/", news.format(f"news {i} {LONG}")) for i in range(6)] + [(10 + i, "http://a.b/", shop.format(f"shop {i} {LONG}")) for i in range(4)]
    rows += [(20 + i, None, news.format(f"news {i} {LONG}")) for i in range(3)] + [(30, "no host", shop.format(f"shop {LONG}"))]
    rows += [(40 + i, "http://c.d/", f"<body><div class='x'>box</div><div class='{c}'><p>{c} {LONG}</div>") for i, c in enumerate("abcdefgh")]
    got = {r["page_id"]: r["text"] for r in html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i].startswith(f"news {i % 10} ") for i in (*range(6), *range(20, 23)))
    assert all(got[i] == f"shop {i - 10} {LONG}".strip() for i in range(10, 14))
    assert got[30] == f"shop {LONG}".strip()
    assert all(got[40 + i] == f"{c} {LONG}".strip() for i, c in enumerate("abcdefgh"))


def test_own_names_of_columns_and_hosts_too_many_to_broadcast(spark, monkeypatch):
    """Columns named like inner ones stay as they are, and both joins give the same texts."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").withColumns({"_host": F.lit("h"), "_paths": F.lit("p"), "host": F.lit(1)})
    got = html_extraction.extract(pages)
    rows = sorted(map(repr, got.collect()))
    assert got.columns == [*pages.columns, "text"] and got.where("_host = 'h' AND _paths = 'p' AND host = 1").count() == pages.count()
    monkeypatch.setattr(html_extraction, "BROADCAST_BYTES", 0)
    assert sorted(map(repr, html_extraction.extract(pages).collect())) == rows
