"""Account numbers with words and numbers after them."""

import random
import re
import time

import pytest

from patronlens.llm import pii

GERMAN, BRITISH, NORWEGIAN = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947"


def accounts(text):
    return [text[a:b] for k, a, b, _ in pii.find(text) if k == "iban"]


@pytest.mark.parametrize("account", [GERMAN, BRITISH, NORWEGIAN, GERMAN.replace(" ", ""), NORWEGIAN.replace(" ", "")])
@pytest.mark.parametrize("after", ["", " BIC COBADEFFXXX", " 100 EUR", " BY 3 MAY 2024 OR LATER THAN THAT", ".", " and", " 7"])
def test_words_and_numbers_after_an_account(account, after):
    assert accounts(f"IBAN {account}{after}") == [account]


def test_accounts_that_follow_each_other_or_a_false_start():
    assert accounts(f"{GERMAN} {BRITISH} {NORWEGIAN}") == [GERMAN, BRITISH, NORWEGIAN]
    assert accounts(f"ACCOUNT AB13 CDE FGH {GERMAN}") == [GERMAN]
    assert accounts(f"{GERMAN}X") == accounts(f"X{GERMAN}") == []
    assert accounts("DE88 3704 0044 0532 0130 00 BIC COBADEFFXXX") == []


def test_other_countries_have_any_end_that_fits():
    body = "ABCD 1234 5678 9012 3"
    check = next(c for c in range(2, 99) if pii.mod97(f"ZZ{c:02}{body.replace(' ', '')}"))
    assert accounts(f"bank ZZ{check:02} {body}") == [f"ZZ{check:02} {body}"]
    text = f"bank ZZ{check:02} {body} TODAY"
    ends = [m.end() for m in re.finditer(r"[A-Z0-9]+", text)]
    fits = [text[5:e] for e in ends if 15 <= len(a := text[5:e].replace(" ", "")) <= 34 and pii.mod97(a)]
    assert accounts(text) == [max(fits, key=len)]


def test_linear():
    rnd = random.Random(1)
    for text in ("AA11" * 50_000, "AA11 " * 50_000, "A1 " * 80_000, " ".join(rnd.choices(["DE89", "3704", "AB12", "C"], k=60_000))):
        start = time.perf_counter()
        pii.find(text)
        assert time.perf_counter() - start < 20
