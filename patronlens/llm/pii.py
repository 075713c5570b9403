"""Personal data in texts: patterns propose spans, checksums confirm them, context words move their score.

The four base kinds (email, ip, card, phone) follow fixed patterns and keep every span
that passes its check. The further kinds are account numbers (iban, confirmed by
mod-97, which also decides where one ends) and social security numbers (ssn, without a checksum, so that only context
words can lift them over the threshold).

Defined results: null and empty texts have no spans; positions are code points, end
exclusive; texts are searched whole, in time linear in their length; equal texts give
equal spans; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
THRESHOLD = 0.5  # of the further kinds

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_ALPHANUMERIC = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
# Length of an account number by its country; others may have any from 15 to 34.
_IBAN_LENGTH = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
        26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
        30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
_DIGIT = re.compile(r"[0-9]")
_LOCAL_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# Score of a confirmed span without context, words that raise it, words that lower it.
_SCORES = {
    "email": (0.9, r"e-?mails?|mail|contact|correo|courriel|write", r"example|noreply|no-reply"),
    "ip": (0.6, r"ip|address|server|host|client|login|adresse|direcci[oó]n", r"version|section|chapter|release"),
    "card": (0.9, r"card|visa|mastercard|credit|debit|carte|karte|tarjeta|cvv|expir\w*", r"order|invoice|isbn|tracking|serial"),
    "phone": (0.7, r"phone|tel|telephone|call|mobile|cell|fax|tel[eé]fono|t[eé]l[eé]phone|telefon|handy", r"version|score"),
    "iban": (0.9, r"iban|account|bank|konto|compte|cuenta|bic|swift", r"serial|model|part"),
    "ssn": (0.3, r"ssn|social|security|taxpayer|tin", r"serial|model|part|order"),
}
_RAISE = {k: re.compile(rf"\b(?:{up})\b", re.IGNORECASE) for k, (_, up, _) in _SCORES.items()}
_LOWER = {k: re.compile(rf"\b(?:{down})\b", re.IGNORECASE) for k, (_, _, down) in _SCORES.items()}
CONTEXT = (48, 24)  # code points read before and after a span
STEP = 0.25


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number without blanks has check digits that fit."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches. One is sought around each ``@``, so no run of characters is read twice."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARACTERS:
            start -= 1
        free = max(free, at)  # a failed sign also ends what later ones may claim
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def _accounts(text: str) -> Iterator[tuple[int, int]]:
    """Account numbers. Of the ends of words that one may have, the country's comes first, then the others, longest first."""
    at = 0
    while m := _IBAN.search(text, at):
        start, size, ends = m.start(), 0, {}
        for i in range(start, m.end()):
            if text[i] != " ":
                size += 1
                if text[i + 1 : i + 2] not in _ALPHANUMERIC:
                    ends[size] = i + 1
        lengths = sorted((n for n in ends if n >= 15), key=lambda n: (n != _IBAN_LENGTH.get(text[start : start + 2]), -n))
        at = start + 1
        for n in lengths:
            if mod97(text[start : ends[n]].replace(" ", "")):
                yield start, ends[n]
                at = ends[n]
                break


def _candidates(text: str) -> Iterator[tuple[str, int, int]]:
    for start, end in _emails(text):
        yield "email", start, end
    if not _DIGIT.search(text):
        return
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) < 4 and int(p or 0) < 256 for part in m[0].split(".")):
            yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield "card", m.start(), m.end()
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield "phone", m.start(), m.end()
    for start, end in _accounts(text):
        yield "iban", start, end
    for m in _SSN.finditer(text):
        yield "ssn", m.start(), m.end()


def score(kind: str, text: str, start: int, end: int) -> float:
    near = text[max(0, start - CONTEXT[0]) : start] + "\n" + text[end : end + CONTEXT[1]]
    moved = _SCORES[kind][0] + STEP * bool(_RAISE[kind].search(near)) - STEP * bool(_LOWER[kind].search(near))
    return round(min(1.0, max(0.0, moved)), 4)


def find(text: str | None, threshold: float = THRESHOLD) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by kind as listed in ``KINDS``, then start."""
    spans = [(k, a, b, score(k, text, a, b)) for k, a, b in _candidates(text or "")]
    return [s for s in spans if s[0] in BASE or s[3] >= threshold]


SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def spans(text: str = "text", threshold: float = THRESHOLD) -> Column:
    """Spans of a text column, as an array of (kind, start, end, score)."""

    @pandas_udf(SPANS)
    def search(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in find(t, threshold)] for t in batch])

    return search(F.col(text))


def listed(found: str, kinds: tuple[str, ...] = KINDS) -> Column:
    """Spans of the given kinds as text: ``kind:start:end``, joined by commas."""
    chosen = F.filter(found, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, counts by base kind, base_sha256, spans, n_iban, n_ssn, top_score) for every row."""
    found = docs.select("doc_id", spans("text", threshold).alias("found"))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(count, BASE),
        F.sha2(listed("found", BASE), 256).alias("base_sha256"), listed("found").alias("spans"),
        *map(count, KINDS[len(BASE):]),
        F.array_max(F.transform("found", lambda s: s["score"])).alias("top_score"),
    )
