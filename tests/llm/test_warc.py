"""Archives: round trips, broken framing, missing segments."""

import base64
import glob
import gzip
import hashlib

import pytest

from patronlens.llm import warc
from patronlens.operators.lineage import new_folder


def round_trip(spark, rows, columns="page_id long, url string, html string", **options):
    path = new_folder(spark, "archive")
    warc.write(spark.createDataFrame(rows, columns), path, **options)
    return path, warc.read(spark, path)


def brute(rows):
    largest = {}
    for page_id, _, html in rows:
        body = (html or "").encode()
        if body not in largest or (largest[body] is None) or (page_id is not None and page_id > largest[body]):
            largest[body] = page_id
    out = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        first = largest[body]
        out.append((page_id, len(body), digest, "response", None) if page_id == first else (page_id, len(body), digest, "revisit", first))
    return sorted(out, key=repr)


def test_odd_rows(spark):
    big = "é🙂<p>WARC/1.1\r\n\r\n\r\nContent-Length: 3\r\n" * 2000
    rows = [(1, "http://a/\r\n x: y", big), (2, None, big), (3, "u", None), (4, "u", ""), (None, "u", big), (None, "u", "only"),
            (6, "ü", "x" * warc.CHUNK), (7, "", "y" * 5), (7, "", "y" * 5)]
    _, out = round_trip(spark, rows)
    assert sorted(map(tuple, out.collect()), key=repr) == brute(rows)
    clash = [(*r, "a", 1) for r in rows]
    _, out = round_trip(spark, clash, "page_id long, url string, html string, digest string, n int")
    assert sorted(map(tuple, out.collect()), key=repr) == brute(rows)
    _, out = round_trip(spark, rows[:0])
    assert out.count() == 0


def test_small_payloads_may_all_be_responses(spark):
    _, out = round_trip(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], least=3)
    assert sorted((r.page_id, r.record_type) for r in out.collect()) == [(1, "response"), (2, "response"), (3, "revisit"), (4, "response")]


def test_archives_are_plain_warc(spark):
    path, _ = round_trip(spark, [(5, "http://a", "<p>" + "z" * 9000)], segment=1000)
    files = glob.glob(f"{path}/part-*.gz")
    records = [r for f in files for r in warc.parse(gzip.open(f).read())]
    kinds = [f["warc-type"] for f, _ in records]
    assert kinds.count("response") == 1 and kinds.count("continuation") == len(records) - 1 >= 9
    numbers = sorted(int(f["warc-segment-number"]) for f, _ in records)
    assert numbers == list(range(1, len(records) + 1))
    assert sum("warc-segment-total-length" in f for f, _ in records) == 1


def test_segments_in_any_order_and_missing_ones():
    parts = [{"segment": i, "total": 6 if i == 3 else None, "block": b"ab"} for i in (3, 1, 2)]
    assert warc.assemble(parts) == b"ababab"
    for broken in (parts[:2], parts[1:], [*parts, parts[0]], [{**p, "total": p["total"] and 7} for p in parts]):
        with pytest.raises(ValueError):
            warc.assemble(broken)


@pytest.mark.parametrize("payload", [b"", b"a", b"a" * 4096, b"\r\n0\r\n\r\n" * 3000])
def test_chunked_framing(payload):
    assert warc.from_chunks(warc.to_chunks(payload)) == payload
    with pytest.raises(ValueError):
        warc.from_chunks(warc.to_chunks(payload)[:-5])
    assert warc.from_chunks(b"3;x=1\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
