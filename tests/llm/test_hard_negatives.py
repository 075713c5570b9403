"""Hard negatives against SQL, plain Python, and odd rows."""

import random

import numpy as np
import pytest
from compare import SMALL, difference
from pyspark.sql import functions as F

from patronlens.llm import hard_negatives as hn
from patronlens.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, label int, embedding array<double>, row string, stripe int"


@pytest.mark.parametrize("shape", [(1, 1, 1), (7, 5, 3), (64, 64, 64), (130, 65, 257), (200, 300, 90), (256, 128, 300)])
def test_product_is_exact(shape):
    m, k, n = shape
    rng = np.random.default_rng(m)
    a, b = rng.integers(-(2**20), 2**20, (m, k)), rng.integers(-(2**20), 2**20, (n, k))
    assert (hn.product(a, b) == a @ b.T).all()
    a, b = rng.integers(-(2**62), 2**62, (m, k)), rng.integers(-(2**62), 2**62, (n, k))
    assert (hn.product(a, b) == a @ b.T).all()  # modulo 2^64 as well


def test_scores_beyond_a_long_are_bounded():
    a, b = np.array([[2**62, 5]]), np.array([[2**62, 1], [1, 1], [-(2**62), 0]])
    assert hn.scores(a, b).tolist() == [[2**63 - 1, 2**62 + 5, 1 - 2**63]]


def test_query_equals_sql(spark):
    assert difference(QUERIES["op11_hard_negatives"](spark, SMALL), ORACLES["op11_hard_negatives"], SMALL) is None


def plain(rows, anchor, positives, negatives):
    """(anchor, positive, rank, negative, their scores) by definition."""
    usable = [
        (i, l, [int(np.floor(256 * x)) for x in v]) for i, l, v, *_ in rows
        if l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    first = lambda found, k: sorted(found, key=lambda f: (-f[0], f[1] is None, f[1] or 0))[:k]
    out = []
    for a, (i, l, v) in enumerate(usable):
        if i is None or not anchor(i):
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), j, m) for b, (j, m, w) in enumerate(usable) if b != a]
        for p, j, _ in first([s for s in scored if s[2] == l], positives):
            hard = [s for s in scored if s[2] != l and 30 * p <= 100 * s[0] <= 90 * p]
            out += [(i, j, r, n, p, s) for r, (s, n, _) in enumerate(first(hard, negatives), 1)]
    return sorted(out, key=repr)


def found(frame):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in frame.select(names).collect()), key=repr)


@pytest.mark.parametrize("stripe,tile", [(64_000_000, 2_048), (600, 7)])
def test_equals_plain_with_ties_and_repeats(spark, monkeypatch, stripe, tile):
    for name, value in (("STRIPE_BYTES", stripe), ("COLUMNS", tile), ("ROWS", 3)):
        monkeypatch.setattr(hn, name, value)
    rnd = random.Random(tile)
    rows = [(i, rnd.randrange(4), [rnd.choice([0.0, 0.25, 0.5, -0.25, 1.0]) for _ in range(6)], "x", 1) for i in range(220)]
    rows += [(300 + i, 1, rows[10][2], "x", 1) for i in range(100)]  # a common vector
    rows += rows[20:23] * 2  # rows that repeat, an anchor among them
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(hn.mine(frame, F.col("vec_id") % 10 == 0, 5, 10)) == plain(rows, lambda i: i % 10 == 0, 5, 10)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, 1, [1.0, 2.0]), (1, 1, [1.0, 1.5]), (2, 2, [0.5, 0.5]), (3, 2, [1.0]), (None, 2, [0.5, 0.5]), (4, None, [1.0, 1.0]),
            (5, 2, None), (6, 2, [None, 1.0]), (7, 2, [nan, 1.0]), (8, 1, [inf, 1.0]), (9, 2, []), (10, 3, [0.001, -0.001]), (11, 2, [0.1] * 300)]
    rows = [(*r, "x", 1) for r in rows]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert found(hn.mine(frame, F.col("vec_id") % 5 == 0)) == plain(rows, lambda i: i % 5 == 0, 5, 10) != []
    assert hn.mine(frame.limit(0), F.col("vec_id") == 0).count() == 0
    assert hn.mine(frame, F.col("vec_id") == 12345).count() == 0
    huge = [(0, 1, [1e300], "x", 1), (1, 1, [1e300], "x", 1), (2, 2, [1e-300], "x", 1)]
    assert found(hn.mine(spark.createDataFrame(huge, SCHEMA), F.col("vec_id") == 0)) == []
