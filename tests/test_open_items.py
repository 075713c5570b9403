"""Longest prefixes, counted ingest, habits in one pass, stretches by counts, names of clusters."""

import io
from collections import Counter
from contextlib import redirect_stdout

import pytest
from compare import SMALL, difference

from patronlens.operators import activity, profile, segment, sequence
from patronlens.plans.oracles import ORACLES
from patronlens.plans.queries import QUERIES
from patronlens.sources import tables
from patronlens.sources.standins import StandIns


@pytest.mark.parametrize("name", ["region_by_prefix", "ingest_orders", "ingest_losses", "browse_history", "browse_history_parts", "purchase_history", "weekly_basket"])
def test_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, SMALL), ORACLES[name], SMALL) is None


def test_longest_prefix_with_odd_rows(spark):
    regions = spark.createDataFrame(
        [("13", "a", "a"), ("1300", "b", "b"), ("1300", "c", "b"), ("130012345678", "d", "d"), (None, "e", "e"), ("99", None, "f")],
        "region_key string, province string, city string",
    )
    users = spark.createDataFrame([(1, "1300999"), (1, "1300999"), (2, "13"), (3, "1"), (4, None), (5, ""), (6, "130012345678"), (7, "991")], "id long, mobile string")
    found = profile.with_prefix_region(users, regions)
    assert Counter(map(tuple, found.collect())) == Counter([
        (1, "1300999", "c", "b"), (1, "1300999", "c", "b"), (2, "13", "a", "a"), (3, "1", None, None), (4, None, None, None),
        (5, "", None, None), (6, "130012345678", "d", "d"), (7, "991", None, "f"),
    ])
    assert profile.with_prefix_region(users, regions.limit(0)).where("province IS NULL").count() == 8
    plan = io.StringIO()
    with redirect_stdout(plan):
        found.explain()
    assert "NestedLoop" not in plan.getvalue() and "Cartesian" not in plan.getvalue()


def test_ingest_tells_what_it_lost(spark):
    raw = spark.createDataFrame(
        [("1", "7", "1.5", "60"), ("x", "8", "", None), ("2", None, "1,5", "never"), (None, None, None, None)],
        "id string, memberId string, orderAmount string, finishTime string",
    )
    typed, rejects, losses = tables.ingest(raw, "tbl_orders")
    assert typed.schema == tables.conform(raw, "tbl_orders").schema or typed.columns == tables.SCHEMAS["tbl_orders"].fieldNames()
    assert sorted(map(str, typed.collect())) == sorted(map(str, tables.conform(raw, "tbl_orders").collect()))
    assert {k: n for k, n in losses.items() if n} == {"rows": 4, "id": 1, "orderAmount": 2, "finishTime": 1}
    kept = {r.raw: r.lost for r in rejects.collect()}
    assert kept == {
        '{"id":"x","memberId":"8","orderAmount":"","finishTime":null}': ["id", "orderAmount"],
        '{"id":"2","memberId":null,"orderAmount":"1,5","finishTime":"never"}': ["finishTime", "orderAmount"],
    }
    assert tables.ingest(raw.limit(0), "tbl_orders")[2]["rows"] == 0


def test_history_reads_the_log_twice_and_shuffles_no_list(spark):
    plan = io.StringIO()
    with redirect_stdout(plan):
        activity.browse_history(StandIns(spark, SMALL).logs).explain("formatted")
    text = plan.getvalue()
    # One scan of the log is left in the plan; the other wrote the counts.
    assert text.count("events.parquet") == 1
    joins = [i for i, line in enumerate(text.splitlines()) if "Join" in line and line.strip()[:1] in "+*:"]
    assert len(joins) <= 1


def test_stretches_follow_counts(spark):
    names = [f"{'x' * 20}{i:03d}" for i in range(300)] + ["x" * 20, "x", "ab", "abc", "zz"] + ["same name"] * 90
    rows = spark.createDataFrame([(m, n) for m in (1, 2) for n in names] + [(None, n) for n in names] + [(3, None)], "m long, name string")
    cut = sequence.with_stretch(rows, ["m"], "name", bound=40)
    sizes = {(r.m, r._stretch): r["count"] for r in cut.groupBy("m", "_stretch").count().collect()}
    assert cut.count() == rows.count()
    # Only rows of one and the same text may be more than the bound; 32 characters tell these names apart.
    assert max(n for (_, s), n in sizes.items() if s != "sa") <= 40 and sizes[1, "sa"] == 90
    ordered = [r._stretch for r in cut.where("m = 1").orderBy("name").collect()]
    assert ordered == sorted(ordered)
    placed = sequence.place(cut, ["m"], ["name"], cut["_stretch"])
    starts = sorted(r.start for r in placed.where("m = 2").collect())
    assert starts == list(range(len(names)))


def test_clusters_keep_their_names(spark):
    before = spark.createDataFrame([(i, 5.0 + i % 2 / 10, 1.0) for i in range(40)] + [(100 + i, 1.0, 4.9 - i % 2 / 10) for i in range(40)] + [(200, 0.0, 0.0)], "memberId long, a double, b double")
    after = before.withColumn("b", before.b * 1.1).orderBy(before.memberId.desc()).repartition(5)
    former = segment.segment_centers(before, ["a", "b"], 3)
    named = lambda rows, **o: {r.memberId: r.value for r in segment.kmeans_segment(rows, ["a", "b"], 3, **o).collect()}
    old, ranked, kept = named(before), named(after), named(after, former=former)
    assert kept == old and ranked != old
    stored = segment.centers(after, segment.fit(after, ["a", "b"], 3), ["a", "b"], 3, former)
    assert [r.value for r in stored.collect()] == [3, 2, 1]
    # A former training with fewer clusters: what is left takes the free values.
    assert sorted(set(named(after, former=former.where("value < 3")).values())) == [1, 2, 3]
