"""Turn codes, numbers and texts into labels with built-in expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from patronlens.functions.rules import Rule

_TESTS = {
    "lt": lambda c, b: c < b[0],
    "le": lambda c, b: c <= b[0],
    "gt": lambda c, b: c > b[0],
    "ge": lambda c, b: c >= b[0],
    "eq": lambda c, b: c == b[0],
    "between": lambda c, b: c.between(b[0], b[1]),
}


def as_column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_match(cases: Sequence[tuple[Column, Any]], default: Any = None) -> Column:
    """Value of the first case whose test holds, else ``default`` (null if none)."""
    test, value = cases[0]
    chain = F.when(test, value)
    for test, value in cases[1:]:
        chain = chain.when(test, value)
    return chain if default is None else chain.otherwise(default)


def decode(c, mapping: Mapping[Any, Any], default: Any = None) -> Column:
    c = as_column(c)
    return first_match([(c == code, label) for code, label in mapping.items()], default)


def band(c, rules: Sequence[Rule], default: Any = None) -> Column:
    c = as_column(c)
    return first_match([(_TESTS[r.op](c, r.bounds), r.label) for r in rules], default)


def classify_like(c, patterns: Sequence[tuple[str, Any]], default: Any = None) -> Column:
    c = as_column(c)
    return first_match([(c.like(pattern), label) for pattern, label in patterns], default)


def ratio(numerator, denominator) -> Column:
    """Quotient as double; null when the denominator is zero."""
    return F.try_divide(
        as_column(numerator).cast("double"), as_column(denominator).cast("double")
    )
