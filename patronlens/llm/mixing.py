"""Mixing sources to target weights, cut exactly to each source's word budget.

Every document gets a hash-random key. Within a source the keys are sorted in ranges, word
counts are summed range by range, and each source is taken up to its budget: whole
epochs first, then documents in key order, the last one in part.

Defined results: a null source is a source of its own, last in order; null and empty texts
have no words and are never taken; rows that repeat a doc_id are documents of their
own; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronlens.llm.common import WORD, id_hash, with_prefix, word_count
from patronlens.operators.lineage import settle

WEIGHTS = (3, 1, 2)  # of the sources in code point order, over and over
SHARE = 1.5  # size of the mix as a share of all words
MOST_EPOCHS = 2


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size) to (source, rank, source_size, target).

    A target above ``most`` times its source stops there, and the excess is shared again by
    weight among the others, until none is above. Each round sends two sums to the
    driver. The table has one row per source, as many as there are weights to state.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = settle(ranked.withColumn("weight", weight))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, free = 0.0, None
    while True:
        open_ = F.lit(True) if free is None else F.col("weight") * F.lit(level) <= F.col("source_size") * most
        closed_size, open_weight, n_open = ranked.agg(
            F.coalesce(F.sum(F.when(~open_, F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(open_, F.col("weight"))), F.lit(0)),
            F.count(F.when(open_, 1)),
        ).first()
        if n_open == free or not open_weight:
            break
        level, free = (share * total - most * closed_size) / open_weight, n_open
    capped = F.col("weight") * F.lit(level) > F.col("source_size") * most
    target = F.when(capped, (F.col("source_size") * most).cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return ranked.select("source", "rank", "source_size", target.alias("target"))


def mix(docs: DataFrame, carry: Sequence[str] = (), **options) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken): words that the mix takes of each document.

    ``carry`` names further columns to pass through.
    """
    rows = settle(
        docs.select("doc_id", "source", *carry, word_count("text").alias("size"), id_hash("doc_id").alias("__key"))
    )
    aims = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), **options)
    ranked = rows.alias("r").join(aims.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source"))).select(
        "r.*", F.col("rank").alias("__rank"), "source_size", "target"
    )
    placed = with_prefix(ranked, "__rank", "__key", "size", ["doc_id", "size"], "__before")
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - epochs * F.col("source_size") - F.col("__before")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return placed.select("doc_id", "source", *carry, "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs`` once for each time they are taken, with all their columns.

    A document taken twice is there twice. The one that a source's budget cuts
    contributes its first words, as far as the budget reaches.
    """
    columns = docs.columns
    docs = settle(docs.withColumn("__row", F.monotonically_increasing_id()))
    taken = mix(docs.select("doc_id", "source", "text", "__row"), ["__row"], **options).where("taken > 0")
    taken = taken.select("__row", F.col("size").alias("__size"), F.col("taken").alias("__taken"))
    copies = F.sequence(F.lit(1), F.ceil(F.col("__taken") / F.col("__size")).cast("int"))
    rows = docs.join(taken, "__row").withColumn("__copy", F.explode(copies))
    words = F.least(F.col("__size"), F.col("__taken") - (F.col("__copy") - 1) * F.col("__size")).cast("int")
    each = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    cut = F.when(words < F.col("__size"), F.array_join(F.slice(each, F.lit(1), words), "")).otherwise(F.col("text"))
    return rows.withColumn("text", cut).select(*columns)
