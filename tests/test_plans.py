"""What the physical plans must and must not contain."""

import re

import pytest
from compare import SMALL

from patronlens.plans.queries import QUERIES


def plan(spark, name):
    frame = QUERIES[name](spark, SMALL)
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("recommend")])
def test_no_cross_join_no_python_no_forced_broadcast(spark, name):
    text = plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonEval", "ArrowEval", "MapInPandas", "BroadcastHashJoin"):
        assert bad not in text, bad


@pytest.mark.parametrize("name", ["spend_by_city", "purchase_cycle", "preferred_payment", "brand_preference", "discount_scores"])
def test_status_filter_reaches_the_scan(spark, name):
    assert "EqualTo(o_orderstatus,F)" in plan(spark, name)


@pytest.mark.parametrize(
    "name, columns",
    [
        ("spend_by_city", "o_custkey:bigint,o_orderstatus:string,o_totalprice:double"),
        ("browse_slots", "ts:timestamp_ntz,user_id:bigint"),
        ("login_summary", "ts:timestamp_ntz,user_id:bigint,event_type:string"),
        ("purchase_frequency", "o_custkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz"),
    ],
)
def test_scans_read_only_what_is_used(spark, name, columns):
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", plan(spark, name))
    assert any(set(columns.split(",")) == set(s.split(",")) or
               set(columns.split(",")) | {"event_id:bigint"} == set(s.split(",")) for s in schemas), schemas


@pytest.mark.parametrize(
    "name, shuffles",
    [
        ("login_summary", 1), ("purchase_cycle", 1), ("return_propensity", 1), ("rfm_scores", 1),
        ("browse_slots", 1), ("slot_series", 1), ("page_frequency", 1), ("consumer_profile", 2),
        ("preferred_payment", 2), ("product_ratings", 1), ("demographics", 0), ("device_class", 0),
    ],
)
def test_number_of_shuffles(spark, name, shuffles):
    assert plan(spark, name).count("Exchange hashpartitioning") == shuffles


@pytest.mark.parametrize("name", ["preferred_payment", "product_preference", "slot_by_job"])
def test_top_rows_are_cut_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert re.search(r"WindowGroupLimit .* Partial", text) and re.search(r"WindowGroupLimit .* Final", text)


def test_orders_are_read_once_for_the_consumer_profile(spark):
    assert plan(spark, "consumer_profile").count("FileScan") == 1


@pytest.mark.parametrize("name, shuffles", [("coupon_scores", 3), ("discount_scores", 3)])
def test_scores_of_lines_do_not_read_products(spark, name, shuffles):
    text = plan(spark, name)
    assert "part.parquet" not in text and text.count("Exchange") <= shuffles
