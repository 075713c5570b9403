"""Fingerprints against a plain version, byte by byte and document by document."""

import hashlib
import random

import numpy as np
import pytest
from compare import SMALL

from patronlens.llm import fingerprints as fp
from patronlens.llm.queries import QUERIES, documents


def plain_digest(data):
    count = [0] * fp.BUCKETS
    for p in range(len(data)):
        for (i, j), (x, y, z) in zip(fp._OFFSETS, fp._TABLES):
            if p + j < len(data):
                count[x[data[p]] ^ y[data[p + i]] ^ z[data[p + j]]] += 1
    q1, q2, q3 = (sorted(count)[fp.BUCKETS * q // 4 - 1] for q in (1, 2, 3))
    codes = [(c > q1) + (c > q2) + (c > q3) for c in count]
    head = f"{fp.length_code(len(data)):02x}{q1 * 15 // max(q3, 1):x}{q2 * 15 // max(q3, 1):x}"
    return head + "".join(f"{4 * a + b:x}" for a, b in zip(codes[::2], codes[1::2]))


def plain_likeness(a, b):
    score = min(abs(int(a[:2], 16) - int(b[:2], 16)), fp.LENGTH_CAP)
    score += sum(min(abs(int(x, 16) - int(y, 16)), 8) for x, y in zip(a[2:4], b[2:4]))
    for x, y in zip(a[4:], b[4:]):
        for shift in (2, 0):
            score += [0, 1, 2, 6][abs((int(x, 16) >> shift & 3) - (int(y, 16) >> shift & 3))]
    return 1 - score / fp.LARGEST


def plain(rows, digest=plain_digest):
    """Results by definition for rows (doc_id, text)."""
    md5 = lambda t: hashlib.md5((t or "").encode()).hexdigest()
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), md5(r[1])))
    out = []
    for n, (i, text) in enumerate(rows):
        text, other = text or "", rows[(n + 1) % len(rows)][1] or ""
        cut = len(text) // 3
        new = (text[: len(text) - cut] + other[:cut]).encode()
        own, changed, after = digest(text.encode()), digest(new), digest(other.encode())
        out.append((i, len(text), hashlib.sha256(new).hexdigest(), own, changed, plain_likeness(own, changed), plain_likeness(own, after)))
    return sorted(out, key=repr)


def found(frame):
    return sorted((tuple(r) for r in frame.select(fp._RESULT.names).collect()), key=repr)


def test_digests(monkeypatch):
    rnd = random.Random(0)
    texts = [bytes(rnd.choices(b"abcdefgh \xc3\xbc", k=k)) for k in [0, 1, 2, 3, 4, 5, *(rnd.randrange(400) for _ in range(40))]]
    expected = [plain_digest(t) for t in texts]
    for size in (1_000_000, 64, 7):
        monkeypatch.setattr(fp, "AT_ONCE", size)
        assert fp.written(fp.digests(texts)) == expected
    digests = fp.digests(texts)
    assert (fp.parsed(expected) == digests).all()
    shuffled = rnd.sample(expected, len(expected))
    assert fp.likeness(digests, fp.parsed(shuffled)) == pytest.approx([plain_likeness(a, b) for a, b in zip(expected, shuffled)], abs=1e-12)


def test_length_codes_rise():
    codes = [fp.length_code(n) for n in range(5_000)]
    assert codes == sorted(codes) and codes[0] == 0 and fp.length_code(2**60) == 255


@pytest.mark.parametrize("partitions", [1, 4, 40])
def test_equals_plain(spark, monkeypatch, partitions):
    rnd = random.Random(partitions)
    rows = [(rnd.randrange(70), "".join(rnd.choices("abcé 漢\U0001f600", k=rnd.choice([0, 1, 2, 3, 50])))) for _ in range(90)]
    rows += [(None, "x y z"), (None, None), (5, None), (6, ""), (7, "ab" * 30_000), (None, "")] + [(8, "same text again")] * 30
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        frame = spark.createDataFrame([(*r, "p", 3) for r in rows], "doc_id long, text string, part string, end int").repartition(3)
        assert found(fp.report(frame)) == plain(rows, lambda data: fp.written(fp.digests([data]))[0])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_few_rows(spark):
    one = spark.createDataFrame([(1, "abcdefghi")], "doc_id long, text string")
    assert found(fp.report(one)) == plain([(1, "abcdefghi")])
    assert fp.report(one.limit(0)).count() == 0


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark, SMALL).collect()]
    ours = found(QUERIES["op12_fingerprints"](spark, SMALL))
    assert ours == plain(rows, lambda data: fp.written(fp.digests([data]))[0])
    assert np.mean([r[5] > r[6] for r in ours]) > 0.98  # an edited text is closer than the neighbour


def test_compared(spark):
    docs = spark.createDataFrame([(i, "lorem ipsum dolor " * i) for i in range(5)], "doc_id long, text string")
    prints = {r.doc_id: r.fingerprint for r in fp.fingerprinted(docs).collect()}
    pairs = [(a, b, prints[a], prints[b]) for a in prints for b in prints]
    near = fp.compared(spark.createDataFrame(pairs, "a long, b long, left string, right string")).collect()
    assert {(r.a, r.b): r.likeness for r in near} == pytest.approx({(a, b): plain_likeness(x, y) for a, b, x, y in pairs})
    assert all(r.likeness == 1 for r in near if r.a == r.b)
