"""Main text of pages: structure, repeated runs against brute force, broken markup."""

import html
import random
import re

import numpy as np
import pytest
from compare import SMALL

from patronlens.llm import html_text as ht
from patronlens.llm.queries import QUERIES, pages


def text(source):
    return ht.parse(source).main_text()


@pytest.mark.parametrize(
    "source,expected",
    [
        ("<nav>a</nav><article><h1>T</h1><p>x<b>y</b> z<br>w</article><footer>f</footer>", "T xy z w"),
        ("<article><p>a &amp; b &#233;&nbsp;c &lt;d&gt; &am</p></article>", "a & b é c <d> &am"),
        ("<article>a<script>if (x < 1) '</p>'</script>b<style>p{}</style><!-- <p>c</p> -->d</article>", "abd"),
        ("<article>a<div class='ad'>b</div><div class=\"comments\"><p>c</p></div><form>d</form><aside>e</aside>f</article>", "a f"),
        ("<article>keep<p>1</p></article><article class='comment'>no</article>", "keep 1"),
        ("<main><div>a</div><nav>n</nav></main><div>outside</div>", "a"),
        ("<article><p><b>unclosed<br><p>next</p></article><footer>f", "unclosed next"),
        ("<article>a <a title='x > y'>b</a> 1 < 2 <unknown>c", "a b 1 < 2 c"),
        ("<head><title>t</title><p>x", ""),
        ("<div class='menu'><ul><li>m</ul></div><header>h</header><div role=search>s</div><p hidden>h</p>", ""),
        ("<article></div><p>still inside</p></article>x", "still inside"),
        ("<article>a<header><h1>b</h1></header><div class='main-content no-sidebar'>c</div></article>", "a b c"),
        (None, ""), ("", ""), ("<", ""), ("<p", ""),
    ],
)
def test_structure(source, expected):
    page = ht.parse(source)
    assert (page.main_text() if page.content() is not None else "") == expected


def test_never_fails():
    rnd = random.Random(2)
    bits = ["<", ">", "<p", "</", "<article>", "</article>", "<!--", "-->", "&", "&amp", "'", '"', "<a b='", "x", " ", "<script>", "<div class=ad>"]
    for _ in range(3000):
        ht.parse("".join(rnd.choices(bits, k=rnd.randint(0, 30))))


@pytest.mark.parametrize("run", [1, 2, 3, 5, 8])
def test_suffix_array_equals_brute_force(run):
    rng = np.random.default_rng(run)
    for _ in range(20):
        docs = [rng.integers(0, 4, rng.integers(0, 30)) for _ in range(rng.integers(1, 7))]
        holders = {}
        for i, d in enumerate(docs):
            for p in range(len(d) - run + 1):
                holders.setdefault(tuple(d[p : p + run]), set()).add(i)
        found, rest = ht.repeated_places(docs, run)
        for d, f, r in zip(docs, found, rest, strict=True):
            places = range(len(d) - run + 1)
            assert f.tolist() == [p for p in places if len(holders[tuple(d[p : p + run])]) > 1]
            assert sorted([*f, *r]) == list(places)


def brute(rows, run=ht.RUN):
    """Text of every page, its repeated runs found by comparing all windows of its host."""
    parsed = {}
    for _, url, source in rows:
        parsed[url, source] = ht.parse(source)
    holders = {}
    host = lambda url: re.match(r"https?://([^/]*)", url or "") and re.match(r"https?://([^/]*)", url)[1]
    for row in set(rows):
        words = " ".join(t for t, _ in parsed[row[1:]].outside()).split()
        for p in range(len(words) - run + 1):
            holders.setdefault((host(row[1]), *words[p : p + run]), set()).add(row)
    out = []
    for page_id, url, source in rows:
        page = parsed[url, source]
        if page.content() is not None:
            out.append((page_id, url, page.main_text()))
            continue
        words, gone = [], []
        for t, kind in page.outside():
            words += t.split()
            gone += [kind == ht.Page.CHROME] * len(t.split())
        for p in range(len(words) - run + 1):
            if host(url) and len(holders[host(url), *words[p : p + run]]) > 1:
                gone[p : p + run] = [True] * run
        out.append((page_id, url, " ".join(w for w, g in zip(words, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def test_whole_table(spark):
    rows = [(r.page_id, r.url, r.html) for r in pages(spark, SMALL).collect()]
    out = QUERIES["op8_html_text"](spark, SMALL).collect()
    assert sorted(((r.page_id, r.url, r.text) for r in out), key=repr) == brute(rows)
    for r in out:
        source = next(h for i, _, h in rows if i == r.page_id)
        inside = re.search(r"<article>(.*)</article>", source, re.DOTALL)[1]
        assert r.text == " ".join(html.unescape(re.sub(r"</?(?:p|h1|br)>", " ", inside.replace("<b>", ""))).split())
        assert r.n_chars == len(r.text)


def test_odd_rows(spark):
    rows = [(1, None, None), (None, "http://a.b", ""), (2, "http://a.b", "<p>x</p>" * 20_000), (3, "ftp://", "<article>é🙂</article>")]
    docs = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, host int")
    out = {r.page_id: (r.text, r.n_chars) for r in ht.extract(docs).collect()}
    assert out == {1: ("", 0), None: ("", 0), 2: ("x " * 19_999 + "x", 39_999), 3: ("é🙂", 2)}
    assert ht.extract(docs.limit(0)).count() == 0
