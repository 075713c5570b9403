"""The best documents against scoring all of them."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from compare import SMALL

from patronlens.llm import topk_search as ts
from patronlens.llm.common import reachable
from patronlens.llm.queries import QUERIES, documents


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, queries, k):
    bags = [Counter(words_of(t)) for _, t in rows]
    df = Counter(w for b in bags for w in b)
    mean = sum(sum(b.values()) for b in bags) / len(rows)
    holders = {}
    for i, b in enumerate(bags):
        norm = ts.K1 * (1 - ts.B + ts.B * sum(b.values()) / mean) if b else 0
        for w, tf in b.items():
            holders.setdefault(w, []).append((i, tf * (ts.K1 + 1) / (tf + norm)))
    out = {}
    for query_id, text in queries:
        scores = Counter()
        for w, n in Counter(words_of(text)).items():
            idf = math.log(1 + (len(rows) - df[w] + 0.5) / (df[w] + 0.5))
            for i, impact in holders.get(w, ()):
                scores[i] += n * idf * impact
        best = sorted(scores.items(), key=lambda s: (-round(s[1], 7), rows[s[0]][0] is None, rows[s[0]][0] or 0))[:k]
        out[query_id] = [(rows[i][0], s) for i, s in best]
    return out


def compare(found, expected):
    by = {}
    for r in found:
        by.setdefault(r.query_id, []).append((r.rank, r.doc_id, r.score))
    assert set(by) == {q for q, best in expected.items() if best}
    for q, rows in by.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, len(rows) + 1))
        assert [r[2] for r in rows] == pytest.approx([s for _, s in expected[q]], rel=1e-9)
        if len({round(s, 6) for _, s in expected[q]}) == len(rows):
            assert [r[1] for r in rows] == [i for i, _ in expected[q]]


@pytest.mark.parametrize("shard,block,visit", [(16_384, 64, 8), (40, 4, 1), (25, 8, 2), (16_384, 4, 1)])
def test_equals_scoring_everything(spark, monkeypatch, shard, block, visit):
    monkeypatch.setattr(ts, "SHARD", shard)
    monkeypatch.setattr(ts, "VISIT", visit)
    rnd = random.Random(shard)
    words = [f"w{int(rnd.paretovariate(0.7))}" for _ in range(4000)]
    rows = [(i, " ".join(rnd.choices(words, k=rnd.randint(0, 60)))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(ts, "BLOCK", block)
    queries = docs.where("doc_id % 7 = 0")
    compare(ts.search(docs, queries, 5).collect(), brute(rows, [r for r in rows if r[0] % 7 == 0], 5))


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark, SMALL).collect()]
    compare(QUERIES["op7_topk_search"](spark, SMALL).collect(), brute(rows, [r for r in rows if r[0] % 50 == 0], ts.K))


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "a"), (4, "A " * 30_000), (5, "zzz")]
    docs = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, rank int, shard string")
    found = ts.search(docs, docs, 3).collect()
    by = {}
    for r in found:
        by.setdefault(r.query_id, []).append(r.doc_id)
    assert set(by) == {3, 4, 5} and sorted(by[3], key=repr) == [3, 3, 4] or sorted(by[3], key=repr) == [3, 3, None]
    assert by[5] == [5]
    assert ts.search(docs.limit(0), docs.limit(0)).count() == 0
    assert ts.search(docs, docs.limit(0)).count() == 0


def test_query_without_id_is_left_out(spark):
    rows = spark.createDataFrame([(None, "a b"), (1, "a")], "doc_id long, text string")
    assert [(r.query_id, r.doc_id) for r in ts.search(rows, rows, 2).orderBy("rank").collect()] == [(1, 1), (1, None)]


def test_most_postings_of_frequent_words_are_passed_over():
    rnd = random.Random(5)
    words = [f"w{int(rnd.paretovariate(0.6))}" for _ in range(40_000)]
    texts = [" ".join(rnd.choices(words, k=rnd.randint(20, 200))) for _ in range(4_000)]
    found = ts.Postings()
    for a in range(0, len(texts), 1_000):
        found.add(pa.array(texts[a : a + 1_000]))
    index = ts.Index(found, sum(len(t.split()) for t in texts) / len(texts))
    for terms, times in [(t, n) for _, t, n in ts.bags(pa.array([" ".join(rnd.choices(words, k=6)) for _ in range(50)]))]:
        at = np.searchsorted(index.terms, terms)
        df = index.starts[index.lists[at + 1]] - index.starts[index.lists[at]]
        weights = times * np.log(1 + (index.n - df + 0.5) / (df + 0.5))
        docs, scores = index.best(terms, weights, 10)
        places = [slice(index.starts[index.lists[t]], index.starts[index.lists[t + 1]]) for t in at]
        whole = sum(w * np.bincount(index.doc[p], index.impact[p], index.n) for w, p in zip(weights, places))
        assert sorted(scores)[-10:] == pytest.approx(sorted(whole)[-10:])
        assert whole[docs] == pytest.approx(scores)
    assert index.read < index.held / 2


def test_equal_texts_go_by_id(spark, monkeypatch):
    monkeypatch.setattr(ts, "SHARD", 30)
    monkeypatch.setattr(ts, "BLOCK", 4)
    monkeypatch.setattr(ts, "VISIT", 1)
    rnd = random.Random(9)
    texts = [" ".join(f"w{int(rnd.paretovariate(0.8))}" for _ in range(40)) for _ in range(8)]
    docs = spark.createDataFrame([(i, texts[i * 7 % 8]) for i in range(200)], "doc_id long, text string").repartition(4)
    for r in ts.search(docs, docs.where("doc_id < 8"), 10).groupBy("query_id").agg({"doc_id": "collect_list"}).toDF("q", "ids").collect():
        assert sorted(r.ids) == [i for i in range(200) if i % 8 == r.q % 8][:10]


def test_building_a_shard_takes_little_beside_its_postings():
    import tracemalloc

    rnd = random.Random(4)
    texts = [" ".join(rnd.choices([f"w{i}" for i in range(20_000)], k=200)) for _ in range(1_000)]
    found = ts.Postings()
    found.add(pa.array(texts))
    tracemalloc.start()
    index = ts.Index(found, 200.0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 45 * len(index.doc)  # bytes a posting


def test_answers_and_copies_of_queries_do_not_grow_with_the_shards(spark, monkeypatch):
    rnd = random.Random(5)
    text = lambda: " ".join(f"w{int(rnd.paretovariate(0.6))}" for _ in range(25))
    rows = [(i, text()) for i in range(600)] + [(None, "w1 w2"), (900, None), (901, "w1 w3"), (901, "w1 w3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    queries = docs.where("doc_id % 50 = 0")
    given = []
    expected = brute(rows, [(r.doc_id, r.text) for r in queries.collect()], 10)
    monkeypatch.setattr(ts, "STRIPES", 1)
    stripes = spark.sparkContext.defaultParallelism
    for shard, held in ((16_384, 32_768), (10, 32_768), (10, 5)):
        monkeypatch.setattr(ts, "SHARD", shard)
        monkeypatch.setattr(ts, "HELD", held)
        found = ts.search(docs, queries)
        compare(found.collect(), expected)
        given.append(found._jdf.queryExecution().analyzed().toString().count(f"sequence(0, {stripes - 1}"))
    assert given == [1, 1, 1]


def test_alike_documents_lie_side_by_side_and_thresholds_carry_on():
    rnd = random.Random(8)
    texts = [" ".join(f"{'abcd'[i % 4]}{rnd.randrange(60)}" for _ in range(30)) for i in range(640)]
    found = ts.Postings()
    found.add(pa.array(texts))
    index = ts.Index(found, 30.0)
    kinds = [texts[i][0] for i in index.order]
    assert sorted(index.order.tolist()) == list(range(640)) and sum(a != b for a, b in zip(kinds, kinds[1:])) < 100
    _, terms, counts = next(ts.bags(pa.array([texts[0]])))
    docs, scores = index.best(terms, counts.astype(float), 10)
    best = dict(zip(docs.tolist(), scores.tolist()))
    least = sorted(scores)[-10]
    assert index.order[max(best, key=best.get)] == 0
    read, index.read = index.read, 0
    again = dict(zip(*(x.tolist() for x in index.best(terms, counts.astype(float), 10, least))))
    assert {d: s for d, s in again.items() if s >= least} == {d: s for d, s in best.items() if s >= least} and index.read <= read
    assert not len(index.best(terms, counts.astype(float), 10, 1e9)[0])


def language(rnd, kinds=4, words=12_000):
    """Texts in a few languages, each of frequent and rare words of its own."""
    common = [[f"{kind}x{int(rnd.paretovariate(0.8))}" for _ in range(words)] for kind in range(kinds)]
    return lambda i, n: " ".join(rnd.choices(common[i % kinds], k=n))


@pytest.mark.parametrize("long,columns,together,block", [(50, 4_096, 256, 8), (2, 3, 7, 4), (10**9, 10**9, 5, 8), (10, 0, 1, 1), (20, 50, 64, 16)])
def test_long_lists_and_queries_put_together_change_no_result(spark, monkeypatch, long, columns, together, block):
    for name, value in (("LONG", long), ("COLUMNS", columns), ("TOGETHER", together), ("BLOCK", block), ("SHARD", 60), ("STRIPES", 1)):
        monkeypatch.setattr(ts, name, value)
    rnd = random.Random(3)
    text = language(rnd)
    rows = [(i, text(i, rnd.choice((3, 30, 200)))) for i in range(700)]
    rows += [(1_000 + i, rows[i % 5][1]) for i in range(40)] + [(2_000, None), (2_001, "nowhere"), (2_002, " ".join(t for _, t in rows[:80]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    queries = [r for r in rows if r[0] % 25 == 0 or r[0] > 2_000]
    compare(ts.search(docs, docs.where("doc_id % 25 = 0 OR doc_id > 2000"), 10).collect(), brute(rows, queries, 10))


def test_whole_texts_as_queries_take_little_more_than_reading_their_lists(spark):
    rnd = random.Random(12)
    text = language(rnd, words=40_000)
    texts = [text(i, rnd.randint(50, 1_500)) for i in range(5_000)]

    def measured(rows):
        # In a task, as there numpy has one thread, whose CPU seconds are compared.
        from time import process_time

        texts = pa.array(rows)
        queries = [(t, c.astype(float)) for _, t, c in ts.bags(texts[:513])]
        postings, ids = [], [pa.array(np.arange(len(texts)))]
        for _ in range(3):
            postings.append(ts.Postings())
            for a in range(0, len(texts), 1_000):
                postings[-1].add(texts[a : a + 1_000])
        index, expected, times = ts.Index(postings.pop(), 775.0), [], []
        began = process_time()
        for terms, weights in queries[1:]:
            at = np.searchsorted(index.terms, terms)
            lists = [slice(index.starts[index.lists[t]], index.starts[index.lists[t + 1]]) for t in at]
            scores = np.bincount(np.concatenate([index.doc[p] for p in lists]), np.concatenate([w * index.impact[p] for w, p in zip(weights, lists)]), index.n)
            expected.append(np.sort(np.partition(scores, -10)[-10:])[::-1].tolist())
        read = process_time() - began
        for some in (queries[:1], queries):
            asked = [ts.Query(*[pa.scalar(i)] * 3, pa.scalar(t.tolist()), pa.scalar(w.tolist())) for i, (t, w) in enumerate(some)]
            began = process_time()
            ts._answer(asked, postings.pop(), 775.0, ids, ids, 10)
            times.append(process_time() - began)
        yield times[1] - times[0], read, expected, [[row[-1] for row in query.rows()] for query in asked[1:]]

    reachable(spark)
    ((took, read, expected, found),) = spark.sparkContext.parallelize(texts, 1).mapPartitions(lambda rows: measured(list(rows))).collect()
    for scores, best in zip(found, expected, strict=True):
        assert scores == pytest.approx(best, rel=1e-9)
    assert took < 2.5 * read, (took, read)
