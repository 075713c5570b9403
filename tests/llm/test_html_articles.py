"""Pages with an article: the host's suffix array decides there too; shared passages and teasers stay."""

import random

import pytest
from test_html_shared import FOOTER, PASSAGE, extracted, prose

from patronlens.llm import html_text as ht


@pytest.mark.parametrize("shard", [2, 1000])
def test_notices_set_into_articles_go(spark, monkeypatch, shard):
    monkeypatch.setattr(ht, "SHARD", shard)
    rnd = random.Random(3)
    lead = prose(rnd, 12)
    rows, expected = [], []
    for i in range(40):
        url = f"http://host.example/{i}"
        parts = [lead if i == 7 else prose(rnd, 12), PASSAGE, f"{prose(rnd, 3)} {FOOTER}", prose(rnd, 20)]
        inside = parts[:2] + ([FOOTER] if i % 2 else []) + parts[2:]
        html = f"<article>{''.join(f'<p>{p}</p>' for p in inside)}</article><aside>{lead}</aside><footer>{FOOTER}</footer>"
        rows.append((i, url, html))
        expected.append((i, url, " ".join(parts)))
    rows += [(100 + i, f"http://other.example/{i}", rows[i][2]) for i in (1, 3)]  # too few pages to tell
    expected += [(100 + i, f"http://other.example/{i}", " ".join(ht.parse(rows[i][2]).main_text().split())) for i in (1, 3)]
    assert extracted(spark, rows) == sorted(expected, key=repr)


@pytest.mark.parametrize("shard", [2, 1000])
def test_a_notice_in_two_articles_stays(spark, monkeypatch, shard):
    monkeypatch.setattr(ht, "SHARD", shard)
    rnd = random.Random(4)
    rows = [
        (i, "http://host.example/", f"<article><p>{prose(rnd)}</p>{f'<p>{FOOTER}</p>' if i < 2 else ''}</article><footer>{FOOTER}</footer>")
        for i in range(20)
    ]
    assert all(t == ht.parse(rows[i][2]).main_text() for i, _, t in extracted(spark, rows))
