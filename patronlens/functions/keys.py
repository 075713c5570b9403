"""Member-key normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from patronlens.functions.labels import as_column

SUFFIX_WIDTH = 3


def member_key(c, width: int = SUFFIX_WIDTH) -> Column:
    """Last ``width`` characters as a number in text form; null when not numeric.

    Members whose numbers share that suffix become one, so operators group by the
    full id unless the caller applies this first.
    """
    suffix = F.right(as_column(c).cast("string"), F.lit(width))
    return suffix.try_cast("bigint").cast("string")
