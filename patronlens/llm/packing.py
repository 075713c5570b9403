"""Packing by optimal length buckets.

Lengths go into a global histogram; dynamic programming over it chooses the bucket lengths
that minimise padding; batches of at most ``budget`` padded tokens form inside each
bucket, in hash order.

Lengths up to ``EXACT`` are bins of their own. Longer ones are counted with the next length of ``digits`` significant
binary digits, which bounds the histogram (``EXACT`` bins and some 130 for each doubling) whatever the corpus. A
bin is as long as its longest document, so the padding of the chosen buckets is exact, and least among all buckets
that don't cut a bin of lengths above ``EXACT``; below, among all.

Defined results: null and empty texts have length 0 and are packed with the shortest; a
document longer than the budget is a batch of its own, whole; rows that repeat a doc_id
are packed as rows of their own; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.llm.common import id_hash, with_prefix, word_count
from patronlens.operators.lineage import settle

BUCKETS = 8
BUDGET = 16_384  # padded tokens of a batch
EXACT = 16_384
DIGITS = 8


def length_bin(length: Column, digits: int = DIGITS) -> Column:
    """``length`` up to ``EXACT``, else the smallest number with at most ``digits`` significant binary digits that is not below it."""
    bits = F.when(length > EXACT, F.length(F.bin(length))).otherwise(0)
    step = F.expr("1L") * F.pow(F.lit(2), F.greatest(bits - digits, F.lit(0))).cast("long")
    return (F.ceil(length / step) * step).cast("long")


def boundaries(bins: list[int], counts: list[int], totals: list[int], buckets: int) -> list[int]:
    """Bucket lengths, shortest first, with the least padding when every row is padded to its bucket.

    ``bins`` are rising lengths, with the rows and tokens counted under each. Of equal
    paddings, the one whose buckets begin earlier.
    """
    if not bins:
        return []
    size = np.array(bins, dtype=np.int64)
    rows = np.concatenate([[0], np.cumsum(np.array(counts, dtype=np.int64))])
    tokens = np.concatenate([[0], np.cumsum(np.array(totals, dtype=np.int64))])
    n = len(bins)
    best = size * rows[1:] - tokens[1:]  # one bucket for the first j + 1 bins
    cuts = []
    for _ in range(min(buckets, n) - 1):
        now, cut = best.copy(), np.full(n, -1)
        # The best cut of a longer prefix is no earlier, so each one halves what is left to try on both sides.
        open_ = [(1, n - 1, 0, n - 2)]
        while open_:
            first, last, low, high = open_.pop()
            j = (first + last) // 2
            i = np.arange(low, min(high, j - 1) + 1)
            cost = best[i] + size[j] * (rows[j + 1] - rows[i + 1]) - (tokens[j + 1] - tokens[i + 1])
            least = int(np.argmin(cost))
            if cost[least] < best[j]:
                now[j], cut[j] = cost[least], low + least
            if first < j:
                open_.append((first, j - 1, low, low + least))
            if j < last:
                open_.append((j + 1, last, low + least, high))
        best = now
        cuts.append(cut)
    ends, j = [n - 1], n - 1
    for cut in reversed(cuts):
        if cut[j] >= 0:
            j = int(cut[j])
            ends.append(j)
    return [int(size[e]) for e in reversed(ends)]


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, length: Column | None = None) -> DataFrame:
    """(doc_id, n_tokens, bucket, bucket_len, batch, slot, padding) for every row of ``docs``.

    ``length`` is the token count of a row, by default its words. Buckets count from 1,
    batches and slots from 0; (bucket, batch) names a batch.
    """
    length = word_count("text") if length is None else length
    rows = settle(docs.select("doc_id", length.alias("n_tokens"), id_hash("doc_id").alias("key")))
    # Bounded by the definition of a bin.
    histogram = (
        rows.groupBy(length_bin(F.col("n_tokens")).alias("bin"))
        .agg(F.max("n_tokens").alias("longest"), F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("t")).orderBy("bin").collect()
    )
    ends = boundaries([h.longest for h in histogram], [h.n for h in histogram], [h.t for h in histogram], buckets)
    bucket, bucket_len = F.lit(1), F.lit(ends[0] if ends else 0)
    for i, end in enumerate(ends[1:], 2):
        above = F.col("n_tokens") > ends[i - 2]
        bucket, bucket_len = F.when(above, i).otherwise(bucket), F.when(above, F.lit(end)).otherwise(bucket_len)
    rows = rows.select("*", bucket.alias("bucket"), bucket_len.cast("long").alias("bucket_len"), F.lit(1).alias("one"))
    placed = with_prefix(rows, "bucket", "key", "one", ["doc_id", "n_tokens"], "place")
    capacity = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.lit(1), F.col("bucket_len")))).cast("long")
    return placed.select(
        "doc_id", "n_tokens", "bucket", "bucket_len",
        F.floor(F.col("place") / capacity).cast("long").alias("batch"),
        (F.col("place") % capacity).cast("long").alias("slot"),
        (F.col("bucket_len") - F.col("n_tokens")).alias("padding"),
    )
