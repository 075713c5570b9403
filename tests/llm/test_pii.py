"""Spans against the patterns themselves, read literally."""

import hashlib
import re
import sys

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from patronlens.llm import pii
from patronlens.llm.queries import documents
from compare import SMALL


sys.set_int_max_str_digits(0)


def plain_luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    """Base spans by the plain patterns."""
    digits = lambda m: re.sub("[^0-9]", "", m)
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and plain_luhn(digits(m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    }
    return [(k, m.start(), m.end()) for k, (p, ok) in rules.items() for m in re.finditer(p, text) if ok(m[0])]


def base(text):
    return [s[:3] for s in pii.find(text) if s[0] in pii.BASE]


@given(st.text(alphabet="a@.-+ 0145(é%", max_size=60))
@settings(max_examples=1500, deadline=None)
def test_any_text_gives_the_spans_of_the_plain_patterns(text):
    assert base(text) == brute(text)


@pytest.mark.parametrize(
    "text",
    [
        "a@b.c_d@e.f", "x@y.z@w.v", "@a.b", "a@b", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.01.1.1", "4111-1111 1111 1111",
        "4111 1111 1111 1112", "+1 (319) 555-5132", "+1 23", "+12345678 ", "é🙂 +1 (319) 555-5132 a@b.co", "9" * 5000,
        "1.2.3." + "9" * 5000,
    ],
)
def test_edges(text):
    assert base(text) == brute(text)


def test_further_kinds_need_their_check_or_context():
    assert [s[0] for s in pii.find("IBAN DE89 3704 0044 0532 0130 00.")] == ["iban"]
    assert pii.find("IBAN DE88 3704 0044 0532 0130 00.") == []
    assert pii.find("part 123-45-6789") == [] and pii.find("it is 123-45-6789") == []
    assert [s[0] for s in pii.find("ssn 123-45-6789")] == ["ssn"]
    assert pii.find("card 4111111111111111")[0][3] > pii.find("order 4111111111111111")[0][3]


def test_long_runs_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "+1 " * 100_000, "A" * 100_000 + "@"):
        pii.find(text)


def test_whole_table(spark):
    docs = documents(spark, SMALL)
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = pii.report(docs).collect()
    assert len(found) == len(texts)
    for row in found:
        spans = brute(texts[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s[0] == k for s in spans) for k in pii.BASE]
        assert set(row.spans.split(",")) - {""} >= {f"{k}:{a}:{b}" for k, a, b in spans}
    assert sum(r.n_email for r in found) > 10 and sum(r.n_card for r in found) > 5


def test_nulls_repeats_and_empty_table(spark):
    rows = [(None, None, "x"), (1, "", "x"), (1, "a@b.co", "y"), (1, "a@b.co", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    out = sorted((r.n_email, r.spans, r.doc_id is None) for r in pii.report(docs).collect())
    assert out == [(0, "", False), (0, "", True), (1, "email:0:6", False), (1, "email:0:6", False)]
    assert pii.report(docs.limit(0)).count() == 0
