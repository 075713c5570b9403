"""What users do on the site: time slots, devices, dwell times, page habits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patronlens.functions import dates, rules, web
from patronlens.functions.labels import band, ratio
from patronlens.operators.lineage import settle
from patronlens.operators.sequence import place
from patronlens.operators.topk import top_k_per_group

LIST_PART = 10_000  # views per row of a list column; longer histories go on in further rows
SLOT_LABELS = [r.label for r in rules.SLOTS]


def slot_series(logs: DataFrame) -> DataFrame:
    """Views per user and slot, one column per slot in clock order (``slot_1`` first)."""
    return _slot_counts(logs).drop("unreadable")


def _slot_counts(logs: DataFrame) -> DataFrame:
    part = dates.slot("log_time")
    counts = [F.count_if(part == label).alias(f"slot_{i}") for i, label in enumerate(SLOT_LABELS, 1)]
    return logs.groupBy(F.col("global_user_id").alias("user_id")).agg(
        *counts, F.count_if(part.isNull()).alias("unreadable")
    )


def browse_slots(logs: DataFrame) -> DataFrame:
    """Views per user and slot as rows, ranked by slot label descending.

    The five slots are counted side by side in one aggregation by user and turned
    into rows afterwards; the rank of a slot is one plus the number of its user's slots
    with a higher label, so no window and no second shuffle is needed.
    """
    labels = sorted(enumerate(SLOT_LABELS, 1), key=lambda s: s[1], reverse=True)
    rank: Column = F.lit(1)
    entries = []
    for i, label in labels:
        n = F.col(f"slot_{i}")
        row = F.struct(F.lit(label).alias("slot"), n.alias("count"), rank.alias("rank"))
        entries.append(F.when(n > 0, row))
        rank = rank + F.when(n > 0, 1).otherwise(0)
    lost = F.struct(F.lit(None).cast("string").alias("slot"), F.lit(0).cast("bigint").alias("count"), rank.alias("rank"))
    entries.append(F.when(F.col("unreadable") > 0, lost))
    return (
        _slot_counts(logs)
        .select("user_id", F.explode(F.array_compact(F.array(*entries))).alias("s"))
        .select("user_id", "s.slot", "s.count", "s.rank")
    )


def slot_by_job(logs: DataFrame, users: DataFrame) -> DataFrame:
    """Users per job and slot of their most frequent view time; ``users`` carries job labels."""
    counted = logs.groupBy(F.col("global_user_id").alias("user_id"), "log_time").agg(F.count("log_time").alias("n"))
    usual = top_k_per_group(counted, ["user_id"], "log_time", 1)
    joined = users.select("id", "job").join(usual, F.col("id") == F.col("user_id"))
    grouped = joined.groupBy("job", dates.slot("log_time").alias("slot")).agg(F.count("log_time").alias("count"))
    # At most one row per job and slot is left here.
    rid = F.row_number().over(W.partitionBy("job").orderBy(F.desc("slot")))
    return grouped.select("job", "slot", F.when(F.col("slot").isNull(), 0).otherwise(F.col("count")).alias("count"), rid.alias("rid"))


def device_class(logs: DataFrame) -> DataFrame:
    return logs.select("id", F.col("global_user_id").alias("user_id"), web.device("user_agent").alias("device"))


def _timeline(logs: DataFrame, *extra: Column) -> DataFrame:
    """Views in time order per user. A user's views are cut by hour, so even the busiest
    user is sorted in many tasks."""
    views = logs.select("id", F.col("global_user_id").alias("user_id"), "log_time", *extra)
    return place(views, ["user_id"], ["log_time", "id"], F.date_trunc("hour", "log_time"))


def _dwell() -> Column:
    """Label for the gap to the next view; ``0`` on the last, null when the time is unreadable."""
    gap = dates.whole_seconds_between("log_time", "following")
    label = F.when(F.col("following").isNull(), rules.DWELL_LAST).otherwise(band(gap, rules.DWELL))
    return F.when(F.col("log_time").isNotNull(), label)


def dwell_time(logs: DataFrame) -> DataFrame:
    return _timeline(logs).select("id", "user_id", _dwell().alias("dwell"))


def page_frequency(logs: DataFrame) -> DataFrame:
    """Views per day of a user's span on each page type."""
    views = logs.select(F.col("global_user_id").alias("user_id"), web.page_type("loc_url").alias("page"), "log_time")
    grouped = views.groupBy("user_id", "page").agg(
        F.datediff(F.max("log_time"), F.min("log_time")).alias("days"), F.count("page").alias("views")
    )
    return grouped.withColumn("frequency", _frequency())


def _frequency() -> Column:
    return band(ratio("views", "days"), rules.PAGE_FREQUENCY, rules.PAGE_FREQUENCY_ELSE)


def _page_state(logs: DataFrame) -> DataFrame:
    """What stretches and habits are made of, one row per user, hour and page: views, first and last."""
    views = logs.select(F.col("global_user_id").alias("user_id"), web.page_type("loc_url").alias("page"), "log_time")
    return views.groupBy("user_id", F.date_trunc("hour", "log_time").alias("_slice"), "page").agg(
        F.count(F.lit(1)).alias("_weight"), F.count("page").alias("views"),
        F.min("log_time").alias("log_time"), F.max("log_time").alias("last"),
    )


def browse_history(logs: DataFrame, part_size: int = LIST_PART) -> DataFrame:
    """Page types, slots, dwell times and devices of each user's views, newest first, and page habits.

    Histories of more than ``part_size`` views go on in rows with a higher ``part``;
    read in part order they give the whole history. Unreadable slots and dwell times
    are not listed.

    The log is read twice: once for the counts per hour and page, from which both the places of the
    views and the habits follow, and once for the views. Habits meet the views as rows in the grouping that
    makes the lists, one set for each part, so no list is ever shuffled to a join.
    """
    state = settle(_page_state(logs))
    labelled = place(
        logs.select(
            "id", F.col("global_user_id").alias("user_id"), "log_time", web.page_type("loc_url").alias("page"),
            dates.slot("log_time").alias("slot"), web.device("user_agent").alias("device"),
        ),
        ["user_id"], ["log_time", "id"], F.date_trunc("hour", "log_time"), counted=state,
    )
    place_from_end = F.col("total") - F.col("start") - 1
    views = labelled.select(
        "user_id",
        F.floor(place_from_end / part_size).alias("part"),
        F.struct(place_from_end.alias("at"), "page", "slot", "device", _dwell().alias("dwell")).alias("view"),
    )
    pages = state.groupBy("user_id", "page").agg(
        F.datediff(F.max("last"), F.min("log_time")).alias("days"), F.sum("views").alias("views"), F.sum("_weight").alias("n")
    )
    kinds = F.sort_array(F.collect_list(F.struct("page", _frequency().alias("frequency"))))
    habits = pages.groupBy("user_id").agg(F.sum("n").alias("total"), kinds.alias("habits"))
    last_part = F.ceil(F.col("total") / part_size) - 1
    beside = habits.select("user_id", F.explode(F.sequence(F.lit(0).cast("bigint"), last_part)).alias("part"), "habits").select(
        "user_id", "part", F.explode("habits").alias("habit")
    )
    rows = views.withColumn("habit", F.lit(None).cast(beside.schema["habit"].dataType)).unionByName(
        beside.withColumn("view", F.lit(None).cast(views.schema["view"].dataType))
    )
    parts = rows.groupBy("user_id", "part").agg(
        F.sort_array(F.collect_list("view")).alias("views"), F.sort_array(F.collect_list("habit")).alias("habits")
    )
    column = lambda name: F.array_compact(F.transform("views", lambda v: v[name])).alias(name + "s")
    return parts.select(
        "user_id",
        "part",
        column("page"),
        column("slot"),
        column("dwell"),
        column("device"),
        F.transform("habits", lambda h: h["page"]).alias("page_kinds"),
        F.transform("habits", lambda h: h["frequency"]).alias("page_frequencies"),
    )
