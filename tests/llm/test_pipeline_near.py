"""The near-duplicate stage: sets of word 5-grams, linked at 0.8."""

import random
import re
from collections import Counter

import corpus_pipeline
import numpy as np
from test_pipeline import TINY, plain_mix, plain_packing

from patronlens.llm import language_id
from patronlens.llm import ngram_join as nj
from patronlens.llm.queries import documents


def grams(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} or ({tuple(words)} if words else set())


def similarity(a, b, n=5):
    a, b = grams(a, n), grams(b, n)
    return len(a & b) / len(a | b)


def plain_near(rows):
    """Rows (doc_id, text, ...) that stay: the smallest doc_id of each component of links at 0.8, all pairs compared."""
    sets, parent, holders = [grams(r[1]) for r in rows], list(range(len(rows))), {}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, own in enumerate(sets):
        shared = Counter(j for g in own for j in holders.get(g, ()))
        for j, both in shared.items():
            if 100 * both >= 80 * (len(own) + len(sets[j]) - both):
                parent[root(i)] = root(j)
        for g in own:
            holders.setdefault(g, []).append(i)
    first = {}
    for i, r in enumerate(rows):
        first[root(i)] = min(first.get(root(i), r[0]), r[0])
    return [r for i, r in enumerate(rows) if not sets[i] or first[root(i)] == r[0]]


def kept(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(r.doc_id for r in corpus_pipeline.near(spark, docs, TINY).collect())


def test_stage_links_between_its_threshold_and_that_of_op10(spark):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choices("abcdefgh", k=5))
    base = [word() for _ in range(500)]
    changed = [word() if i % 50 == 25 else w for i, w in enumerate(base)]  # 2 % of the words
    replaced = base[:200] + [word() for _ in range(40)] + base[240:]  # a paragraph of 8 %
    apart = [word() if i % 20 == 10 else w for i, w in enumerate(base)]  # 5 % of the words
    rows = [(i, " ".join(t)) for i, t in enumerate([base, changed, replaced, apart], 1)]
    assert all(0.8 <= similarity(rows[0][1], rows[i][1]) < 0.9 for i in (1, 2)) and similarity(rows[0][1], rows[3][1]) < 0.8
    assert all(similarity(rows[0][1], rows[i][1], 3) < 0.9 for i in (1, 2))
    assert kept(spark, rows) == [1, 4]


def test_stage_equals_brute_force(spark):
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choices("abcdefgh", k=4))
    texts = []
    for words in (8, 40, 150, 600):
        for _ in range(3):
            base = [word() for _ in range(words)]
            for _ in range(15):
                copy = [word() if rnd.random() < rnd.choice([0, 0.005, 0.02, 0.03]) else w for w in base]
                texts.append(" ".join(copy))
    rnd.shuffle(texts)
    rows = list(enumerate(texts))
    assert kept(spark, rows) == sorted(r[0] for r in plain_near(rows))


def test_sets_at_the_edge_share_a_signature():
    rng = np.random.default_rng(2)
    scheme = nj.Scheme(corpus_pipeline.NEAR)
    for size in [*range(1, 40), 147, 148, 400, 1000]:
        a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2))
        for larger in range(size, size * 100 // 80 + 1, 1 + size // 40):
            both = -(-80 * (size + larger) // 180)
            b = np.unique(np.concatenate([rng.permutation(a)[:both], rng.integers(0, 2**63, larger - both, dtype=np.uint64)]))
            assert scheme.linked(a, b)
            shared = [
                set(scheme.signatures(scheme.content(a, i), i).ravel().tolist()) & set(scheme.signatures(scheme.content(b, i), i).ravel().tolist())
                for i in set(scheme.instances(len(a))) & set(scheme.instances(len(b)))
            ]
            assert any(shared), (size, larger)


def test_pipeline_equals_plain_stages_at_its_threshold(spark):
    docs = documents(spark, TINY)
    judged = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs).collect()}
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect() if judged[r.doc_id][0] != "und" and judged[r.doc_id][1] >= 0.5]
    last = {text: doc_id for doc_id, text, _ in sorted(rows)}
    rows = plain_near([r for r in rows if last[r[1]] == r[0]])
    found = corpus_pipeline.run(spark, TINY).collect()
    assert Counter((r.doc_id, r.n_tokens, r.bucket, r.bucket_len, r.padding) for r in found) == plain_packing(plain_mix(rows))
