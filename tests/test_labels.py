"""Rule tables against a plain reading of them, value by value."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from patronlens.functions import dates, rules, web
from patronlens.functions.keys import member_key
from patronlens.functions.labels import band, classify_like, decode, ratio

RULE_LISTS = {
    name: value
    for name, value in vars(rules).items()
    if isinstance(value, list) and value and isinstance(value[0], rules.Rule)
}


def plain(value, rule_list):
    for op, b, label in rule_list:
        if {
            "lt": lambda: value < b[0], "le": lambda: value <= b[0], "gt": lambda: value > b[0],
            "ge": lambda: value >= b[0], "eq": lambda: value == b[0], "between": lambda: b[0] <= value <= b[1],
        }[op]():
            return label
    return None


def values(spark, column_type, data, expression):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {column_type}")
    return [r[0] for r in frame.orderBy("i").select(expression).collect()]


@pytest.mark.parametrize("name", sorted(RULE_LISTS))
def test_every_edge_of_every_rule_list(spark, name):
    rule_list = RULE_LISTS[name]
    edges = sorted({float(b) for r in rule_list for b in r.bounds})
    step = 0.01 if edges[-1] > 1 else 0.0001
    probes = [e + d for e in edges for d in (-step, 0.0, step)] + [-1.0, 1e9]
    assert values(spark, "double", probes, band("v", rule_list)) == [plain(p, rule_list) for p in probes]
    assert values(spark, "double", [None], band("v", rule_list)) == [None]
    assert values(spark, "double", [None], band("v", rule_list, rule_list[0].label)) == [rule_list[0].label]


def test_shared_edges_go_to_the_first_rule(spark):
    assert values(spark, "int", [60, 40, 20], band("v", rules.BUY_SCORE)) == [4, 3, 2]
    assert values(spark, "int", [2, 3, 4, 5, 6], band("v", rules.ACTIVITY_SCORE)) == [2, 2, 3, 4, 5]


def test_gaps_between_order_value_bands_stay_null(spark):
    assert values(spark, "double", [999.5, 9999.5, 0.5], band("v", rules.ORDER_VALUE)) == [None] * 3


def test_decode_falls_back(spark):
    got = values(spark, "string", ["1", "2", "9", None], decode("v", rules.GENDER, rules.GENDER_ELSE))
    assert got == ["男", "女", "未知", "未知"]


def test_zodiac_every_day_of_a_leap_year(spark):
    signs = ["摩羯座", "水瓶座", "双鱼座", "白羊座", "金牛座", "双子座", "巨蟹座", "狮子座", "处女座", "天秤座", "天蝎座", "射手座"]
    last = [20, 19, 20, 20, 21, 21, 22, 22, 23, 23, 22, 21]
    days = [date(2020, 1, 1) + timedelta(n) for n in range(366)]
    expected = [signs[d.month - 1] if d.day <= last[d.month - 1] else signs[d.month % 12] for d in days]
    assert values(spark, "date", days, dates.zodiac("v")) == expected
    assert values(spark, "date", [None], dates.zodiac("v")) == ["其他"]
    assert expected[19] == "摩羯座" and expected[20] == "水瓶座"  # Jan 20 and 21


def test_generation(spark):
    days = [date(y, 6, 1) for y in (1949, 1950, 1959, 1960, 1999, 2000, 2029, 2030)] + [None]
    assert values(spark, "date", days, dates.generation("v")) == [
        "其他", "50后", "50后", "60后", "90后", "00后", "20后", "其他", "其他",
    ]


def test_slots(spark):
    hours = [0, 7, 8, 12, 13, 17, 18, 21, 22, 23]
    times = [datetime(2024, 1, 1, h, 59, 59) for h in hours] + [None]
    assert values(spark, "timestamp", times, dates.slot("v")) == [
        "0点-7点", "0点-7点", "8点-12点", "8点-12点", "13点-17点", "13点-17点",
        "18点-21点", "18点-21点", "22点-24点", "22点-24点", None,
    ]


def test_member_key(spark):
    numbers = ["13822841013", "12", "000", "a12", "9a12", None]
    assert values(spark, "string", numbers, member_key("v")) == ["13", "12", "0", None, None, None]


def test_product_id(spark):
    urls = [
        "/product/12.html", "http://x/product/7.html?a=/product/8.html", "/product/.html", ".html/product/5",
        "/product/x.html", "/product/5", "/item/5.html", "", None,
    ]
    assert values(spark, "string", urls, web.product_id("v")) == [12, 7] + [None] * 7


def test_page_type_takes_the_first_pattern(spark):
    urls = ["/login?to=/order", "/order/product", "/product/index", "/item", "/index", "/help", None]
    assert values(spark, "string", urls, web.page_type("v")) == [
        "登录页", "我的订单页", "商品页", "分类页", "首页", "其他页面", "其他页面",
    ]


def test_device(spark):
    agents = ["Linux; Android 9", "iPhone OS", "Windows WOW64", "X11; Linux", "Macintosh", None]
    assert values(spark, "string", agents, web.device("v")) == ["Android", "IOS", "Window", "Linux", "Mac", "Mac"]


def test_brand_classes(spark):
    names = ["统帅 海尔 冰箱", "海尔 洗衣机", "MOOKA 电视", "KFR-35", "卡萨帝", "杯子"]
    assert values(spark, "string", names, classify_like("v", rules.BRANDS, rules.BRAND_NONE)) == [
        "统帅", "海尔", "摩卡", "小超人", "卡萨帝", "无偏好",
    ]


def test_ratio_by_zero_is_null(spark):
    assert values(spark, "int", [0, 4], ratio(F.lit(2), "v")) == [None, 0.5]


def test_login_recency_edges(spark):
    from patronlens.operators.profile import recency_band

    days = [-1, 0, 1, 2, 7, 8, 14, 15, 30, 31, None]
    assert values(spark, "int", days, recency_band("v")) == [
        "1天以内", "1天以内", "1天以内", "7天以内", "7天以内", "14天以内", "14天以内",
        "30天以内", "30天以内", "30天未登录", "30天未登录",
    ]
