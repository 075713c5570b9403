"""Facts read from page addresses and browser strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from patronlens.functions import rules
from patronlens.functions.labels import as_column, classify_like


def page_type(url) -> Column:
    return classify_like(url, rules.PAGE_TYPES, rules.PAGE_ELSE)


def device(user_agent) -> Column:
    return classify_like(user_agent, rules.DEVICES, rules.DEVICE_ELSE)


def product_id(url) -> Column:
    """Number between the first product mark and the first page suffix, else null."""
    url = as_column(url)
    start = F.instr(url, rules.PRODUCT_MARK)
    stop = F.instr(url, rules.PAGE_SUFFIX)
    skip = len(rules.PRODUCT_MARK)
    text = F.substring(url, start + skip, stop - start - skip)
    return F.when((start > 0) & (stop > start), text.try_cast("int"))
