import json

import pytest

from patronlens.operators import lookup

PEOPLE = [
    (1, "a@x", "131", "80后", "学生", "男"), (2, "b@x", "132", "80后", "教师", "女"),
    (3, "c@x", "133", "90后", "学生", None), (4, None, None, None, "学生", "女"),
]


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(PEOPLE, "id int, email string, mobile string, age string, job string, gender string")


def ids(frame):
    return sorted(r["id"] for r in frame.collect())


def test_contact(people):
    assert ids(lookup.by_contact(people, "b@x")) == [2]
    assert ids(lookup.by_contact(people, "131")) == [1]
    assert ids(lookup.by_contact(people, "999")) == []


def test_contacts(spark, people):
    asked = spark.createDataFrame([("b@x",), ("133",), ("nobody@x",), ("131",)], "contact string")
    assert ids(lookup.by_contacts(people, asked)) == [1, 2, 3]


def test_search(people):
    assert ids(lookup.search_users(people)) == [1, 2, 3, 4]
    assert ids(lookup.search_users(people, age="none", job="none", gender="none")) == [1, 2, 3, 4]
    assert ids(lookup.search_users(people, job="学生")) == [1, 3, 4]
    assert ids(lookup.search_users(people, age="80后", job="学生", gender="男")) == [1]
    assert ids(lookup.search_users(people, gender="女", age="90后")) == []
    assert ids(lookup.search_request(people, '{"age": "80后", "job": "none", "gender": "女"}')) == [2]


def test_ids(spark, people):
    assert ids(lookup.by_id(people, 3, "id")) == [3]
    wanted = spark.createDataFrame([(3,), (3,), (9,)], "wanted int")
    assert ids(lookup.by_ids(people, wanted, "id")) == [3]


def test_json_leaves_out_missing_values(people):
    got = [json.loads(r["json"]) for r in lookup.as_json(people).collect()]
    assert got[3] == {"id": 4, "job": "学生", "gender": "女"}


def test_whole_view_of_one_customer(spark, people):
    profiles = people.selectExpr("*", "'' AS province", "cast(null AS string) AS city")
    weeks = spark.createDataFrame([(1, 9, 5, "a,b,c等"), (1, 2, 1, "z")], "id int, cycle int, count bigint, preview string")
    preference = spark.createDataFrame([(1, "t", "a")], "memberId int, productType string, productName1 string")
    consumer = spark.createDataFrame([(77, 1, "7日")], "id int, memberId int, cycle string")
    slots = spark.createDataFrame([(2, 4)], "user_id int, slot_1 bigint")
    titles = spark.createDataFrame([(2, "省钱能手", "无")], "id int, thrift_title string, coupon_title string")
    got = {r["id"]: r for r in lookup.customer_360(profiles, weeks, preference, consumer, slots, titles).collect()}
    assert len(got) == 4
    assert [tuple(w) for w in got[1]["baskets"]] == [(2, 1, "z"), (9, 5, "a,b,c等")]
    assert (got[1]["province"], got[1]["city"], got[1]["cycle"], got[1]["thrift_title"]) == ("查询失败", "查询失败", "7日", "无")
    assert got[2]["slot_1"] == 4 and got[2]["thrift_title"] == "省钱能手" and got[2]["baskets"] is None
