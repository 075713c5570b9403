"""The forward algorithm against listing all segmentations; accuracy on held-out documents."""

import math
import random
import zlib

import numpy as np
import pytest
from compare import SMALL

from patronlens.llm import language_id as li
from patronlens.llm.queries import QUERIES, documents

PIECES = ["▁", "▁a", "a", "b", "ab", "▁ab", "ba", "aba", "c", "bc"]


def segmentations(text):
    if not text:
        yield ()
    for n in range(1, len(text) + 1):
        if text[:n] in PIECES or n == 1:
            for rest in segmentations(text[n:]):
                yield (text[:n], *rest)


@pytest.fixture(scope="module")
def lattice():
    return li.Lattice(PIECES)


def test_forward_sums_all_segmentations(lattice):
    rng = np.random.default_rng(0)
    chances = rng.random((len(PIECES) + 1, 3)) * 0.1
    model = li.Model(["x", "y", "z"], lattice, chances)
    words = ["".join(random.Random(i).choices("abcd", k=i % 8 + 1)) for i in range(60)]
    row = lambda p: PIECES.index(p) if p in PIECES else len(PIECES)
    expected = [
        [math.log(sum(math.prod(chances[row(p), l] for p in s) for s in segmentations("▁" + w))) for l in range(3)] for w in words
    ]
    assert model.word_scores(words) == pytest.approx(np.array(expected))


def test_expected_counts_weigh_all_segmentations(lattice):
    chances = np.random.default_rng(1).random((len(PIECES) + 1, 1)) * 0.1
    words, times = ["abab", "baba", "dabc"], np.array([2.0, 1.0, 5.0])
    expected = np.zeros(len(PIECES) + 1)
    for w, n in zip(words, times, strict=True):
        rows = [[PIECES.index(p) if p in PIECES else len(PIECES) for p in s] for s in segmentations("▁" + w)]
        weights = np.array([np.prod(chances[r, 0]) for r in rows])
        for r, x in zip(rows, weights / weights.sum() * n, strict=True):
            np.add.at(expected, r, x)
    assert lattice.expected(words, times, chances) == pytest.approx(expected)


def test_words():
    assert li.words_of("The END, it's 3x²!") == ["the", "end", "it", "s", "x"]
    assert li.words_of(None) == li.words_of("12 ...") == []
    assert li.words_of("a" * 70) == ["a" * 70]


@pytest.mark.parametrize("chunk", [4_096, 5])
def test_long_words_are_scored_whole(lattice, monkeypatch, chunk):
    monkeypatch.setattr(li, "CHUNK", chunk)
    chances = np.random.default_rng(4).random((len(PIECES) + 1, 3)) * 0.1
    words = ["".join(random.Random(n).choices("abcd", k=n)) for n in (1, 4, 5, 6, 31, 32, 33, 42, 60)]
    whole = np.array([np.log(lattice.forward([w], chances)[0, -1]) for w in words])
    assert np.array([lattice.score(w, np.log(chances)) for w in words]) == pytest.approx(whole)
    assert li.Model(["x", "y", "z"], lattice, chances).word_scores(words) == pytest.approx(whole)
    for w in words[:6]:
        one = chances[:, [0]]
        assert lattice.expected_long(w, 3.0, np.log(one[:, 0])) == pytest.approx(lattice.expected([w], np.array([3.0]), one))
    long = "abcab" * 4_000
    assert np.isfinite(lattice.score(long, np.log(chances))).all()
    assert lattice.expected_long(long, 1.0, np.log(chances[:, 0])).sum() > len(long) / 3


def plain_query(rows):
    """(held_out, lang_pred, score) by a plain model that learns from the same words, in logarithms, word by word."""
    pieces = li.read_vocabulary()
    number, longest = {p: i for i, p in enumerate(pieces)}, max(map(len, pieces))
    held = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i, _, _ in rows}
    learned = [(t, l) for i, t, l in rows if not held[i] and l is not None and t is not None]
    languages = sorted({l for t, l in learned if li.words_of(t)})

    def edges(word):
        text = "▁" + word
        for a in range(len(text)):
            for b in range(a + 1, min(len(text), a + longest) + 1):
                if text[a:b] in number or b == a + 1:
                    yield a, b, number.get(text[a:b], len(pieces))

    chances = {l: [1 / len(pieces)] * len(pieces) + [li.UNKNOWN] for l in languages}
    for _ in range(li.ROUNDS):
        for l in languages:
            counts = [0.0] * (len(pieces) + 1)
            for text in (t for t, own in learned if own == l):
                for w in li.words_of(text):
                    own, size = list(edges(w)), len(w) + 2
                    alpha, beta = [1.0] + [0.0] * (size - 1), [0.0] * (size - 1) + [1.0]
                    for a, b, p in own:
                        alpha[b] += alpha[a] * chances[l][p]
                    for a, b, p in reversed(own):
                        beta[a] += beta[b] * chances[l][p]
                    for a, b, p in own:
                        counts[p] += alpha[a] * chances[l][p] * beta[b] / alpha[-1]
            counts = [c + li.SMOOTHING for c in counts[:-1]]
            chances[l] = [c / sum(counts) for c in counts] + [li.UNKNOWN]
    out = {}
    for i, text, _ in rows:
        words, total = li.words_of(text), {}
        for l in languages:
            total[l] = 0.0
            for w in words:
                alpha = [1.0] + [0.0] * (len(w) + 1)
                for a, b, p in edges(w):
                    alpha[b] += alpha[a] * chances[l][p]
                total[l] += math.log(alpha[-1])
        best = max(total.values(), default=0)
        sure = 1 / sum(math.exp(t - best) for t in total.values()) if words and languages else 0.0
        out[i] = held[i], min(l for l in languages if total[l] == best) if words and languages else "und", sure
    return out


def test_query_equals_a_plain_model(spark):
    rnd = random.Random(9)
    words = {"en": "the house and garden are green near old rivers", "de": "das haus und der garten sind grün am fluß", "fr": "la maison et le jardin sont très verts"}
    rows = [(i, " ".join(rnd.choices(words[l].split(), k=rnd.randint(1, 12))), l) for i in range(60) for l in [rnd.choice("en de fr".split())]]
    rows += [(100, "donaudampfschifffahrtsgesellschaftskapitaensmuetze haus", "de"), (101, None, "de"), (102, "", None), (103, "42", "en"), (104, "漢字 garten", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: (r.held_out, r.lang_pred, r.score) for r in li.identify(docs).collect()}
    expected = plain_query(rows)
    assert {i: f[:2] for i, f in found.items()} == {i: e[:2] for i, e in expected.items()}
    assert {i: f[2] for i, f in found.items()} == pytest.approx({i: e[2] for i, e in expected.items()})


def test_held_out_accuracy(spark):
    langs = {r.doc_id: r.lang for r in documents(spark, SMALL).collect()}
    found = QUERIES["op9_language_id"](spark, SMALL).collect()
    assert {r.doc_id for r in found} == set(langs) and len(found) == len(langs)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) / len(held) > 0.98


def test_odd_rows(spark):
    rows = [(i, f"the house and the garden are {'green' * (i % 3)}", "en", "s") for i in range(20)]
    rows += [(100 + i, f"das haus und der garten sind {'grün' * (i % 3)}", "de", "s") for i in range(20)]
    rows += [(200, None, "en", "s"), (201, "", "en", "s"), (202, "123 !!", "en", "s"), (None, "the house", "de", "s"), (203, "der garten", None, None),
             (1, "the house and the garden are green", "en", "s"), (204, "haus " * 40_000, None, None), (205, "x" * 50_000, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    found = li.identify(docs).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found}
    assert [by[i].lang_pred for i in (200, 201, 202)] == ["und"] * 3 and by[200].score == 0
    assert (by[None].lang_pred, by[None].held_out) == ("en", False)
    assert by[203].lang_pred == by[204].lang_pred == "de" and by[205].lang_pred in ("de", "en")
    stay = li.accepted(docs)
    assert stay.columns == docs.columns and not {200, 201, 202} & {r.doc_id for r in stay.collect()}
    assert li.identify(docs.limit(0)).count() == 0
    unlabelled = docs.withColumn("lang", docs.lang.substr(1, 0)).where("doc_id < 5").selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert {r.lang_pred for r in li.identify(unlabelled).collect()} == {"und"}
