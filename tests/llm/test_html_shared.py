"""Pages without an article: long whole-block boilerplate goes, shared passages and copies stay."""

import random
import re
from itertools import groupby

import pytest

from patronlens.llm import html_text as ht

RND = random.Random(8)
WORDS = ["".join(RND.choices("abcdefghijklmnop", k=6)) for _ in range(3_000)]
FOOTER = "all rights reserved by the makers of this host since its first day on the net"
PASSAGE = "a passage of prose that three of the articles quote from one and the same older source in full"
PHRASE = "at the end of the day"


def prose(rnd, n=30):
    return " ".join(rnd.choices(WORDS, k=n))


def extracted(spark, rows):
    out = ht.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return sorted(((r.page_id, r.url, r.text) for r in out), key=repr)


@pytest.mark.parametrize("shard", [2, 1000])
def test_shared_passages_phrases_and_copies_stay(spark, monkeypatch, shard):
    monkeypatch.setattr(ht, "SHARD", shard)
    rnd = random.Random(1)
    rows, expected = [], []
    for i in range(40):
        parts = [prose(rnd), f"{prose(rnd, 8)} {PHRASE} {prose(rnd, 8)}", prose(rnd, 12)]
        if i % 14 == 5:
            parts.insert(1, PASSAGE)
        html = "".join(f"<p>{p}</p>" for p in parts) + f"<div>{FOOTER}</div>"
        rows.append((i, f"http://host.example/{i}", html))
        expected.append((i, f"http://host.example/{i}", " ".join(parts)))
    for j in range(20):  # copies under other ids and addresses, in other markup
        rows.append((100 + j, f"http://host.example/copy/{j}", rows[3][2].replace("<p>", f"<p id='c{j}'>")))
        expected.append((100 + j, f"http://host.example/copy/{j}", expected[3][2]))
    assert extracted(spark, rows) == sorted(expected, key=repr)


def test_two_equal_pages_keep_their_text(spark):
    html = f"<p>{prose(random.Random(2))}</p><p>{PASSAGE}</p>"
    rows = [(1, "http://a.example/x", html), (2, "http://a.example/y", html)]
    assert all(t == re.sub("<[^>]*>", " ", html).strip().replace("  ", " ") for _, _, t in extracted(spark, rows))


def test_main_text_around_a_nested_article_stays():
    page = ht.parse("<div>out</div><main><h1>Title</h1><p>lead</p><nav>n</nav><article>body</article><p>after</p></main><footer>f</footer>")
    assert page.main_text() == "Title lead body after"
    assert [t for t, _ in page.outside()] == ["out", "n", "f"]


def plain(rows, run=ht.RUN):
    """The same by comparing all windows of all texts of a host."""
    parsed = [(i, url, ht.parse(source)) for i, url, source in rows]
    host = lambda url: m[1] if (m := re.match(r"https?://([^/]*)", url or "")) else ""
    held, texts, out = {}, {}, []
    for _, url, page in parsed:
        whole = " ".join(t for t, _ in page.blocks)
        texts.setdefault(host(url), set()).add(whole)
        words = " ".join(t for t, _ in page.outside()).split()
        for p in range(len(words) - run + 1):
            held.setdefault((host(url), *words[p : p + run]), set()).add(whole)
    for i, url, page in parsed:
        if page.content() is not None:
            out.append((i, url, page.main_text()))
            continue
        n = len(texts[host(url)])
        enough = max(3, min(5, -(-n // 2)), -(-n // 10)) if host(url) else 10**9
        words = " ".join(t for t, _ in page.outside()).split()
        gone = [False] * len(words)
        for p in range(len(words) - run + 1):
            if len(held[host(url), *words[p : p + run]]) >= enough:
                gone[p : p + run] = [True] * run
        at, blocks = 0, []
        for t, kind in page.outside():
            blocks.append((t, kind, all(gone[at : at + len(t.split())])))
            at += len(t.split())
        text = []
        for whole, group in groupby(blocks, key=lambda b: b[2]):
            group = list(group)
            if not whole or sum(len(b[0].split()) for b in group) < run:
                text += [b[0] for b in group if b[1] != ht.Page.CHROME]
        out.append((i, url, " ".join(text)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard", [1, 3, 1000])
def test_equals_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(ht, "SHARD", shard)
    rnd = random.Random(shard)
    common = [prose(rnd, rnd.randint(2, 14)) for _ in range(5)]
    rows = []
    for i in range(90):
        parts = [rnd.choice(common) if rnd.random() < 0.6 else prose(rnd, rnd.randint(1, 12)) for _ in range(5)]
        if rnd.random() < 0.3:
            parts[2] = f"{parts[2]} {prose(rnd, 2)}"
        body = "".join(f"<div>{p}</div>" for p in parts)
        url = rnd.choice(["http://one.example/x", "http://one.example/y", "https://two.example", None, "not a url"])
        rows.append((i, url, f"<body><nav>m n o</nav>{body}" if rnd.random() < 0.8 else f"<article>{prose(rnd, 3)}</article>{body}"))
    rows += rows[:3]
    rows += [(200 + i, u, h) for i, u, h in rows[:9]]
    out = extracted(spark, rows)
    assert out == plain(rows)
    assert any(len(t) < len(" ".join(x for x, k in ht.parse(h).outside() if k != 1)) for (_, _, t), (_, _, h) in zip(out, sorted(rows, key=repr)) if "<article" not in h)
