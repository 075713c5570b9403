"""Labels taken from dates and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from patronlens.functions import rules
from patronlens.functions.labels import as_column, band


def generation(birthday) -> Column:
    return band(F.year(as_column(birthday)), rules.GENERATION, rules.GENERATION_ELSE)


def zodiac(birthday) -> Column:
    """Sign from a per-month cut-off table: the month's own sign, or next month's."""
    day = as_column(birthday)
    cut_offs = F.array(*[F.lit(last) for last, _ in rules.ZODIAC])
    signs = [sign for _, sign in rules.ZODIAC]
    opening = F.array(*[F.lit(s) for s in signs])
    closing = F.array(*[F.lit(s) for s in signs[1:] + signs[:1]])
    month = F.month(day) - 1
    sign = F.when(F.dayofmonth(day) <= F.get(cut_offs, month), F.get(opening, month)).otherwise(
        F.get(closing, month)
    )
    return F.coalesce(sign, F.lit(rules.ZODIAC_ELSE))


def slot(log_time) -> Column:
    """Part of the day; null when the time could not be read."""
    return band(F.hour(as_column(log_time)), rules.SLOTS)


def whole_seconds_between(start, end) -> Column:
    """Seconds from ``start`` to ``end``, each first cut to the whole second."""
    start = F.date_trunc("second", as_column(start))
    end = F.date_trunc("second", as_column(end))
    return F.timestamp_diff("SECOND", start, end)
