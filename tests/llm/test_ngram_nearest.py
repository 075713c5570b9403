"""Pairs that share signatures but are not linked: few are given, and none that is linked is lost."""

import random

import numpy as np
import pytest
from test_ngram_join import check, near_copies

from patronlens.llm import ngram_join as nj


def family(seed, size, words, changed):
    """Copies of one text with ``changed`` words replaced in each: near one another, but not linked."""
    rnd = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    texts = []
    for i in range(size):
        copy = list(base)
        for at in rnd.sample(range(words), changed):
            copy[at] = f"x{i}_{at}"
        texts.append(" ".join(copy))
    return list(enumerate(texts))


def counted(monkeypatch):
    numbers, real = [], nj.verified

    def verified(pairs, *rest):
        numbers.append(pairs.count())
        return real(pairs, *rest)

    monkeypatch.setattr(nj, "verified", verified)
    return numbers


def test_unlinked_family_gives_few_pairs(spark, monkeypatch):
    numbers = counted(monkeypatch)
    rows = family(1, 160, 300, 4)
    check(spark, rows)
    assert sum(numbers) < 5 * len(rows)


@pytest.mark.parametrize("most", [2, 3])
def test_rounds_equal_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(nj, "NEAREST", most, raising=False)
    check(spark, near_copies(5, 3, 50, 120) + [(1000 + i, t) for i, t in family(2, 60, 120, 2)])


def test_outline_never_rejects_and_is_close():
    rnd = np.random.default_rng(3)
    for size in (1, 5, 63, 64, 65, 300, 700, 5000):
        for share in (0, 0.02, 0.1, 0.3):
            pool = rnd.integers(0, 2**64, size + int(size * share), dtype=np.uint64)
            a, b = np.unique(pool[:size]), np.unique(pool[-size:])
            far = int(nj.differing(*nj.folded([nj.outline(a).tobytes(), nj.outline(b).tobytes()])))
            true = len(np.setxor1d(a, b))
            assert far <= true and (size < 300 or far >= 0.6 * true)


def test_texts_are_not_shuffled_for_their_sets(spark, monkeypatch):
    plans, real = [], nj.settle

    def settled(rows):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return real(rows)

    monkeypatch.setattr(nj, "settle", settled)
    monkeypatch.setattr(nj, "MARKS", 1 << 15, raising=False)
    check(spark, near_copies(8, 3, 30, 60))
    fetching = [p for p in plans if "hashes" in p and "text" in p and "Join" in p]
    assert not fetching


def test_marks(spark):
    keys = spark.range(-50, 50).selectExpr("id * 7919 AS k1")
    marked = nj.marks(keys)
    bits = np.unpackbits(marked, bitorder="little")
    assert bits.sum() == 100 and all(bits[i * 7919 % len(bits)] for i in range(-50, 50))
    assert not nj.marks(keys.limit(0)).any()
