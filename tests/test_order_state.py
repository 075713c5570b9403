"""Labels from merged state against one run over all orders; what an update reads; writers that die."""

import re

import pytest
from compare import SMALL
from pyspark.sql import functions as F

from patronlens.operators import lineage, lookup, orders
from patronlens.operators.order_state import OrderState
from patronlens.plans.queries import SCALED_CUTS
from patronlens.sources.standins import StandIns


def rows_of(frame):
    return sorted(map(repr, frame.collect()))


@pytest.mark.parametrize("batches", [1, 5])
def test_merged_labels_equal_one_run(spark, batches):
    x = StandIns(spark, SMALL)
    # Members without a number, and orders without a day or an amount.
    odd = x.orders.withColumns({
        "memberId": F.when(F.col("memberId") % 11 == 0, None).otherwise(F.col("memberId")),
        "modified": F.when(F.col("id") % 13 == 0, None).otherwise(F.col("modified")),
        "orderAmount": F.when(F.col("memberId") % 5 == 0, None).otherwise(F.col("orderAmount")),
    })
    state = OrderState(spark, lineage.new_folder(spark, "state"), odd, 4)
    for i in range(batches):
        state.add(odd.where(F.pmod(F.xxhash64("id"), F.lit(batches)) == i))
    assert rows_of(state.profile(**SCALED_CUTS)) == rows_of(orders.consumer_profile(odd, **SCALED_CUTS))
    assert rows_of(state.rfm_metrics("2001-08-02", 3)) == rows_of(orders.rfm_metrics(odd, "2001-08-02", 3))
    state.add(odd.limit(0))
    assert rows_of(state.profile()) == rows_of(orders.consumer_profile(odd))


def test_an_update_reads_the_new_orders_and_does_not_move_the_state(spark):
    x = StandIns(spark, SMALL)
    state = OrderState(spark, lineage.new_folder(spark, "state"), x.orders, 8)
    state.add(x.orders.where("id % 2 = 0"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = state.merge(x.orders.where("id % 2 = 1"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scans = re.findall(r"FileScan parquet (\S*)\[", text)
    assert len(scans) == 2 and sum("bucketed_" in s for s in scans) == 1
    assert "Bucketed: true" in text
    # Between the join and the state there is neither an exchange nor a second reading of orders.
    side = text[text.index("SortMergeJoin"):]
    lines = side.split("\n")
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and "bucketed_" in line)
    depth = lambda line: re.match(r"[\s:+\-*()\d]*", line).end()
    above = []
    for line in reversed(lines[:at]):
        if depth(line) < depth(lines[at]) and (not above or depth(line) < depth(above[-1])):
            above.append(line)
    assert above and not any("Exchange" in line for line in above if "SortMergeJoin" not in line)


def test_a_dead_writer_leaves_the_former_content(spark):
    index = lookup.contact_index(spark, lineage.new_folder(spark, "contacts"), 4)
    users = spark.createDataFrame([(1, "a@x", "13"), (2, None, "14"), (3, "b@x", "has@"), (4, "a@x", "13")], "id long, email string, mobile string")
    assert index.rows().count() == 0
    index.replace(lookup.contacts_of(users))
    broken = users.withColumn("id", F.when(F.col("id") == 4, F.raise_error(F.lit("died"))).otherwise(F.col("id")).cast("long"))
    with pytest.raises(Exception, match="died"):
        index.replace(lookup.contacts_of(broken))
    fresh = lookup.contact_index(spark, index.path, 4)  # another session opens it
    assert sorted(map(tuple, fresh.rows().collect())) == [("13", 1), ("13", 4), ("14", 2), ("a@x", 1), ("a@x", 4), ("b@x", 3)]
    for _ in range(3):
        fresh.replace(lookup.contacts_of(users.limit(2)))
    assert len(fresh.versions()) == 2 and fresh.rows().count() == 3


def test_a_lookup_reads_one_bucket(spark):
    x = StandIns(spark, SMALL)
    index = lookup.contact_index(spark, lineage.new_folder(spark, "contacts"), 16)
    index.replace(lookup.contacts_of(x.users))
    contact = x.users.select("email").first()[0]
    # The plan names the buckets only where the scan keeps them apart; they are pruned either way.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        found = lookup.by_indexed_contact(x.users, index, contact)
        assert "SelectedBucketsCount: 1 out of 16" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert rows_of(found) == rows_of(lookup.by_contact(x.users, contact)) != []
    requests = x.users.select(F.col("mobile").alias("contact")).limit(20)
    assert rows_of(lookup.by_indexed_contacts(x.users, index, requests)) == rows_of(lookup.by_contacts(x.users, requests)) != []
    index.replace(lookup.contacts_of(x.users.limit(0)))
    assert index.rows().count() == 0


def test_two_tables_of_one_last_name_are_two(spark):
    a, b = (lookup.contact_index(spark, f"{lineage.new_folder(spark, k)}/idx", 2) for k in "ab")
    one = spark.createDataFrame([("x", 1)], "contact string, id long")
    a.replace(one)
    assert (a.rows().count(), b.rows().count()) == (1, 0)


def test_names_of_tables_go_with_the_intermediate_ones(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(lineage, "_WRITTEN", {})
    monkeypatch.setattr(lineage, "_NAMED", {})
    index = lookup.contact_index(spark, str(tmp_path / "kept"), 2)
    index.replace(spark.createDataFrame([("x", 1)], "contact string, id long"))
    index.rows()
    assert any(t.name.startswith(index.name) for t in spark.catalog.listTables())
    lineage.clear(spark)
    assert not any(t.name.startswith(index.name) for t in spark.catalog.listTables())
    assert index.rows().count() == 1  # its files are the caller's
