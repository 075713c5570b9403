"""Removed words against brute force over all windows."""

import hashlib
import random
import re
from collections import Counter

import pytest
from compare import SMALL

from patronlens.llm import substring_dedup as sd
from patronlens.llm.queries import QUERIES, documents


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(texts, window):
    """(number of words, words kept) of every text."""
    split = [words_of(t) for t in texts]
    count = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(w), [x for x, g in zip(w, gone, strict=True) if not g]))
    return out


def expected(rows, window):
    return sorted(
        (i, n, n - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest())
        for (i, _), (n, kept) in zip(rows, brute([t for _, t in rows], window), strict=True)
    )


def result(frame):
    return sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in frame.collect())


def passages(seed, n):
    """Documents of few different words that share passages, so that windows, edges and minimisers recur."""
    rnd = random.Random(seed)
    fresh = lambda k: [rnd.choice("abcdefghij") + rnd.choice("xyz") for _ in range(k)]
    shared = [fresh(rnd.randint(3, 90)) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [rnd.choice(shared) if rnd.random() < 0.4 else fresh(rnd.randint(0, 50)) for _ in range(rnd.randint(0, 5))]
        rows.append((i, rnd.choice([" ", "\n", "  "]).join(" ".join(p) for p in parts)))
    return rows


@pytest.mark.parametrize("seed,window", [(1, 35), (2, 35), (3, 9)])
def test_equals_brute_force(spark, seed, window):
    rows = passages(seed, 120)
    assert result(sd.report(spark.createDataFrame(rows, "doc_id long, text string"), window)) == expected(rows, window)


def test_hot_minimisers_give_the_same(spark, monkeypatch):
    rows = passages(5, 100)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for hot in (1, 4, 20):
        monkeypatch.setattr(sd, "HOT", hot)
        assert result(sd.report(docs)) == expected(rows, 35)


def test_repetition_in_one_document(spark, monkeypatch):
    monkeypatch.setattr(sd, "LONGEST", 10)
    rows = [(1, "a " * 200), (2, "a " * 34), (3, " ".join(f"w{i}" for i in range(50)) * 2), (4, "b " * 36), (5, "c " * 35)]
    assert result(sd.report(spark.createDataFrame(rows, "doc_id long, text string"))) == expected(rows, 35)


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark, SMALL).collect()]
    out = result(QUERIES["op2_substring_dedup"](spark, SMALL))
    assert out == expected(rows, 35)
    assert sum(r[2] > 0 for r in out) > 50


def test_odd_rows(spark):
    text = " ".join(f"é{i}\t" for i in range(40))
    rows = [(1, None), (2, ""), (3, " \n"), (4, text), (4, text), (5, "x " + text + "y"), (None, text + "z " * 20_000), (6, "short")]
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, k1 string, m int")
    key = lambda r: (r[0] or 0, *r[1:])
    assert sorted(map(key, [tuple(r) for r in sd.report(docs).collect()])) == sorted(
        (i or 0, n, n - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest())
        for (i, _), (n, kept) in zip(rows, brute([t for _, t in rows], 35), strict=True)
    )
    kept = sd.deduplicated(docs)
    assert kept.columns == docs.columns
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert texts[1] is None and texts[4] == "" and texts[5] == "x y" and texts[6] == "short" and texts[3] == " \n"
    assert sd.report(docs.limit(0)).count() == 0 and sd.deduplicated(docs.limit(0)).count() == 0
