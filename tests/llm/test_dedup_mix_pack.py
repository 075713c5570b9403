"""Exact dedup, mixing and packing: edges, tables with odd columns, and brute force."""

import itertools
import random

import numpy as np
import pytest
from compare import SMALL, difference

from patronlens.llm import exact_dedup, mixing, packing
from patronlens.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, digest string, taken string"


def odd(spark):
    rows = [
        (1, "a b c", "a"), (2, "a b c", "a"), (2, "a b c", "a"), (3, None, None), (4, "", "b"), (None, "a b c", "a"),
        (None, "x", None), (None, "x", None), (9, "w " * 30_000, "c"), (10, "é　ß\n\ty", "b"),
    ]
    return spark.createDataFrame([(i, t, "en", s, 0, 7, "d", "t") for i, t, s in rows], SCHEMA)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, SMALL), ORACLES[name], SMALL) is None


def test_dedup_of_odd_rows(spark):
    index = exact_dedup.new_index(spark, 4)
    out = exact_dedup.decide(odd(spark), index).collect()
    seen = sorted(((r.doc_id or 0, r.keep_id, r.group_size, r.kept) for r in out), key=repr)
    assert (0, 2, 4, False) in seen and (1, 2, 4, False) in seen and seen.count((2, 2, 4, True)) == 2
    assert (3, 4, 2, False) in seen and (4, 4, 2, True) in seen and seen.count((0, None, 2, True)) == 2
    stays = exact_dedup.kept_rows(odd(spark), exact_dedup.new_index(spark, 4))
    assert stays.columns == odd(spark).columns
    assert sorted((r.doc_id or 0) for r in stays.collect()) == [0, 2, 4, 9, 10]
    assert exact_dedup.kept_rows(odd(spark).limit(0), exact_dedup.new_index(spark, 4)).count() == 0


def test_index_persists_and_takes_only_new_texts(spark):
    first = exact_dedup.new_index(spark, 4)
    docs = spark.createDataFrame([(i, f"text {i % 50}") for i in range(200)], "doc_id long, text string")
    assert first.add(docs).count() == 50
    spark.sql(f"DROP TABLE {first.table}")  # a later session knows the folder only
    again = exact_dedup.DigestIndex(spark, first.path, 4)
    more = spark.createDataFrame([(i, f"text {i % 60}") for i in range(1000, 1100)], "doc_id long, text string")
    out = exact_dedup.decide(more, again)
    assert sorted(r.doc_id % 60 for r in out.where("kept").collect()) == list(range(50, 60))
    assert out.where("NOT kept AND keep_id >= 1000 AND doc_id % 60 < 50").count() == 0
    assert again.rows().count() == 60
    joined = docs.select(exact_dedup.digest("text").alias("digest")).repartition(4, "digest").hint("merge").join(again.rows(), "digest", "left_anti")
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "SortMergeJoin" in text and "Bucketed: true" in text


def test_mix_takes_exact_budgets(spark):
    rnd = random.Random(3)
    rows = [(i, " ".join("w" * rnd.randint(0, 40)), "en", f"s{min(rnd.randint(0, 12), 5)}", 0, 0, "", "") for i in range(3000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = mixing.mix(docs).collect()
    total = sum(r.size for r in out)
    by = {k: list(g) for k, g in itertools.groupby(sorted(out, key=lambda r: r.source), key=lambda r: r.source)}
    assert sum(g[0].target for g in by.values()) == pytest.approx(1.5 * total)
    for group in by.values():
        assert sum(r.taken for r in group) == int(group[0].target)
        assert all(0 <= r.taken <= 2 * r.size for r in group)
    assert sorted(map(tuple, mixing.mix(docs.repartition(7)).collect())) == sorted(map(tuple, out))
    copies = mixing.mixed_rows(docs)
    assert copies.columns == docs.columns
    words = {}
    for r in copies.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split(" ")) * bool(r.text)
    assert words == {r.doc_id: r.taken for r in out if r.taken}


def test_mix_of_odd_rows(spark):
    out = mixing.mix(odd(spark)).collect()
    assert len(out) == 10 and sum(r.taken for r in out) == pytest.approx(1.5 * sum(r.size for r in out), abs=4)
    assert {r.source for r in out} == {"a", "b", "c", None}
    copies = mixing.mixed_rows(odd(spark)).collect()
    assert copies and all(r.text for r in copies)
    assert mixing.mix(odd(spark).limit(0)).count() == 0 and mixing.mixed_rows(odd(spark).limit(0)).count() == 0
    assert [r.taken for r in mixing.mix(odd(spark).where("doc_id = 3")).collect()] == [0]


def padding(ends, lengths):
    return sum(min(e for e in ends if e >= n) - n for n in lengths)


def test_boundaries_are_optimal():
    rnd = random.Random(5)
    for _ in range(60):
        bins = sorted(rnd.sample(range(1, 60), rnd.randint(1, 8)))
        counts = [rnd.randint(1, 9) for _ in bins]
        lengths = [b for b, c in zip(bins, counts) for _ in range(c)]
        for k in (1, 2, 3, 5):
            ends = packing.boundaries(bins, counts, [b * c for b, c in zip(bins, counts)], k)
            best = min(padding((*cut, bins[-1]), lengths) for m in range(min(k, len(bins))) for cut in itertools.combinations(bins[:-1], m))
            assert len(ends) <= k and padding(ends, lengths) == best


def test_padding_is_least_over_thousands_of_lengths(spark):
    rnd = random.Random(8)
    lengths = [min(40_000, int(rnd.lognormvariate(6, 1.2)) + 1) for _ in range(9_000)] + [20_000 + 7 * i for i in range(30)]
    docs = spark.createDataFrame([(i, "", n) for i, n in enumerate(lengths)], "doc_id long, text string, n long")
    out = packing.pack(docs, buckets=6, length=docs["n"])
    found = out.groupBy("bucket").agg({"bucket_len": "max", "n_tokens": "max", "padding": "sum"}).collect()
    assert all(r["max(bucket_len)"] == r["max(n_tokens)"] for r in found)
    exact = sorted(set(lengths))
    counts = [lengths.count(n) for n in exact]
    assert len(exact) > 2_000
    # Plain dynamic programming over all lengths.
    rows, tokens = np.append(0, np.cumsum(counts)), np.append(0, np.cumsum(np.array(exact) * counts))
    best = np.append(0, np.array(exact) * rows[1:] - tokens[1:]).astype(float)
    for _ in range(5):
        best = np.array([0.0] + [(best[:j] + exact[j - 1] * (rows[j] - rows[:j]) - (tokens[j] - tokens[:j])).min() for j in range(1, len(exact) + 1)])
    assert sum(r["sum(padding)"] for r in found) == best[-1]


def test_packing_of_odd_rows(spark):
    out = packing.pack(odd(spark), buckets=3, budget=8).collect()
    assert len(out) == 10 and all(r.padding == r.bucket_len - r.n_tokens >= 0 for r in out)
    batches = {}
    for r in out:
        batches.setdefault((r.bucket, r.batch), []).append(r)
    for rows in batches.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
        assert len(rows) == 1 or len(rows) * max(1, rows[0].bucket_len) <= 8
    assert packing.pack(odd(spark).limit(0)).count() == 0
