"""Divergence of sources against SQL and a plain version, with spilling blocks and odd rows."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import SMALL, difference

from patronlens.llm import divergence as dv
from patronlens.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, value string, rank int, term string, total int"


def plain(rows, least, top):
    """Results by definition for rows (text, lang, source)."""
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    groups, holders = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = [lower(t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        groups[lang or "", source or ""].update(terms)
        holders[lang or ""].update(set(terms))
    kept = {lang: [t for t, n in c.items() if n >= least] for lang, c in holders.items()}

    def shares(lang, counts):
        size = sum(counts[t] for t in kept[lang]) + 2 * len(kept[lang])
        return {t: 1 + 10**9 * (counts[t] + 2) // size for t in kept[lang]}

    f = lambda p, q: (p - q) ** 2 // (p + q)
    ranked = lambda found: sorted(found, key=lambda x: (-x[1], x[0].encode()))
    out = []
    for (lang, source), counts in groups.items():
        p = shares(lang, counts)
        whole = shares(lang, sum((c for (other, _), c in groups.items() if other == lang), Counter()))
        pairs = [
            (s, sum(f(p[t], q[t]) for t in kept[lang]))
            for (other, s), c in groups.items() if other == lang and s != source for q in [shares(lang, c)]
        ]
        terms = [(t, f(p[t], whole[t])) for t in kept[lang] if counts[t] and p[t] > whole[t]]
        out += [(lang, source, "pair", s, v, r) for r, (s, v) in enumerate(ranked(pairs), 1)]
        out += [(lang, source, "term", t, v, r) for r, (t, v) in enumerate(ranked(terms)[:top], 1)]
    return sorted(out)


def found(frame):
    return sorted(tuple(r) for r in frame.select("lang", "source", "part", "item", "value", "rank").collect())


def frame_of(spark, rows):
    return spark.createDataFrame([(i, *r, "v", 1, "t", 2) for i, r in enumerate(rows)], SCHEMA)


def test_query_equals_sql(spark):
    assert difference(QUERIES["op13_source_divergence"](spark, SMALL), ORACLES["op13_source_divergence"], SMALL) is None


@pytest.mark.parametrize("postings,chunk,piece", [(400_000, 20_000, 4_000_000), (30, 7, 10)])
def test_equals_plain_when_blocks_spill(spark, monkeypatch, postings, chunk, piece):
    for name, value in (("BLOCK_POSTINGS", postings), ("CHUNK", chunk), ("PIECE", piece)):
        monkeypatch.setattr(dv, name, value)
    rnd = random.Random(chunk)
    words = ["Alpha", "beta", "GAMMA", "é", "Été", "漢字", "x1y", "don't", "the", "THE", *(f"w{c}" for c in "abcdefgh")]
    source = lambda: "hot" if rnd.random() < 0.4 else rnd.choice(["a", "B", "é", "", None])
    rows = [(" ".join(rnd.choices(words, k=rnd.randint(0, 30))), rnd.choice(["en", "en", "de", None]), source()) for _ in range(200)]
    assert found(dv.audit(frame_of(spark, rows).repartition(4), 10, 3)) == plain(rows, 10, 3)


def test_odd_rows(spark):
    rows = [(None, None, None), ("", "", "s"), ("a b", "en", "x"), ("a b", "en", "x"), ("b c " * 50_000, "en", "y"), ("1 2 3", "en", "z"),
            ("q" * 5_000_000 + " a", "en", "x"), ("lone", "fr", "only"), ("ſ K a\x00b", "en", "w")]
    assert found(dv.audit(frame_of(spark, rows), 1, 10)) == plain(rows, 1, 10)
    assert found(dv.audit(frame_of(spark, rows), 10, 10)) == plain(rows, 10, 10)  # nothing is kept: pairs of value 0
    assert dv.audit(frame_of(spark, rows).limit(0)).count() == 0


def test_shares_are_exact():
    rnd = random.Random(1)
    for _ in range(2_000):
        total = rnd.randrange(1, 2 ** rnd.randrange(1, 53))
        count = rnd.randrange(0, total + 1)
        assert int(dv.share(np.array([count]), np.array([total]))[0]) == 1 + 10**9 * count // total
