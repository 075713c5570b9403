import pytest
from compare import SMALL, difference

import __spark_entry__ as contract
from patronlens.plans.oracles import ORACLES
from patronlens.plans.queries import QUERIES

CLUSTERED = {
    "rfm_segment", "rfm_centers", "value_label", "consumer_profile_valued", "value_by_age_gender_segment",
    "value_by_province_segment", "coupon_segment", "discount_segment", "user_titles", "lookup_titles",
    "recommend_products", "recommend_brands", "customer_360_titled",
}


def test_every_query_has_sql_unless_it_clusters_or_recommends():
    assert set(QUERIES) - set(ORACLES) == CLUSTERED
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, SMALL), ORACLES[name], SMALL) is None


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["city", "amount"]
    assert frame.count() == 25
