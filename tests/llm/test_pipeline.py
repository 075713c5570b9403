"""The pipeline against a plain version of its stages."""

import hashlib
import re
from collections import Counter

import corpus_pipeline

from patronlens.llm import packing
from patronlens.llm.queries import documents

TINY = "/root/testdata/sf0.001"


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def key(doc_id):
    return hashlib.md5(str(doc_id).encode()).hexdigest()


def plain_mix(rows):
    """(doc_id, text, source) as often as the mix takes them."""
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += size(text)
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes))}
    capped = set()
    while True:
        level = (1.5 * sum(sizes.values()) - 2 * sum(sizes[s] for s in capped)) / sum(w for s, w in weights.items() if s not in capped)
        more = {s for s in sizes if s not in capped and level * weights[s] > 2 * sizes[s]}
        if not more:
            break
        capped |= more
    out = []
    for source in sizes:
        left = int(2 * sizes[source] if source in capped else level * weights[source])
        mine = sorted((r for r in rows if r[2] == source), key=lambda r: (key(r[0]), r[0]))
        while left > 0:
            for doc_id, text, _ in mine:
                words = min(left, size(text))
                left -= words
                if words:
                    out.append((doc_id, text if words == size(text) else re.match(rf"(?:\s*\S+){{{words}}}", text)[0]))
    return out


def plain_packing(rows):
    """Multiset of (doc_id, tokens, bucket, length, padding) and the sizes of the batches."""
    lengths = [size(t) for _, t in rows]
    counts = Counter(lengths)
    order = sorted(counts)
    ends = packing.boundaries(order, [counts[n] for n in order], [n * counts[n] for n in order], packing.BUCKETS)
    placed = Counter()
    for (doc_id, _), n in zip(rows, lengths, strict=True):
        bucket = next(i for i, e in enumerate(ends) if e >= n)
        placed[doc_id, n, bucket + 1, ends[bucket], ends[bucket] - n] += 1
    return placed


def test_batches_of_the_pipeline_are_full(spark):
    found = corpus_pipeline.run(spark, TINY).collect()
    batches = Counter((r.bucket, r.batch) for r in found)
    full = {r.bucket: max(1, packing.BUDGET // max(1, r.bucket_len)) for r in found}
    for bucket, most in full.items():
        sizes = [n for (b, _), n in sorted(batches.items()) if b == bucket]
        assert all(n == most for n in sizes[:-1]) and 0 < sizes[-1] <= most


def test_stages_keep_columns_of_odd_tables(spark):
    rows = [(1, None, None, "x", 1), (2, "", "en", None, 2), (None, "the end of the day is near", "en", "x", 3)] + [
        (i, f"the words of the text number {i} are here for the language {i * 7}", "en", "x", 4) for i in range(3, 30)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, size int")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, TINY)
        assert docs.columns == ["doc_id", "text", "lang", "source", "size"]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, TINY).count() == docs.count() > 20


def test_empty_table(spark):
    docs = documents(spark, TINY).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, TINY)
    assert docs.count() == 0
