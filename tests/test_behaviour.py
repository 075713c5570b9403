"""Orders, lines and recommendation inputs on hand-made rows."""

from datetime import date, datetime
from decimal import Decimal

from patronlens.operators import baskets, orders, profile, recommend, reports, activity

ORDERS = "id bigint, memberId bigint, orderSn string, orderStatus string, paymentName string, modified timestamp, finishTime timestamp, orderAmount decimal(18,2), giftCardAmount decimal(18,2), productAmount decimal(18,2)"
GOODS = "cOrderSn string, productType string, productName string, couponAmount decimal(18,2), activityPrice decimal(18,2)"


def order(i, member, status="202", pay="card", day="2020-01-01", amount="100", gift="0", listed="100"):
    at = None if day is None else datetime.fromisoformat(day)
    money = lambda v: None if v is None else Decimal(v)
    return (i, member, f"s{i}", status, pay, at, at, money(amount), money(gift), money(listed))


def rows(frame, key="memberId"):
    return {r[key]: r for r in frame.collect()}


def test_order_labels(spark):
    frame = spark.createDataFrame(
        [
            order(3, 1, day="2019-03-05", amount="998.50"), order(2, 1, day="2020-03-04", amount="999.50"),
            order(4, 1, status="1"), order(5, 1, status="0"), order(6, 1, status="9", pay="cash"),
            order(7, 2, pay="b"), order(8, 2, pay="a"), order(9, 2, pay=None), order(10, 2, pay=None), order(11, 2, pay=None),
            order(12, 3, status="1"),
            order(13, 4, day=None, amount=None, pay=None),
            order(14, None),
        ],
        ORDERS,
    )
    cycle = rows(orders.purchase_cycle(frame))
    # day 64 of 2019 and day 64 of 2020 (a leap year) are one distinct day over 366 days
    assert (cycle[1]["id"], cycle[1]["cycle"], cycle[1]["band"]) == (2, 366.0, "六月以上")
    assert rows(orders.purchase_cycle(frame, distinct_days="date"))[1]["cycle"] == 183.0
    assert cycle[4]["cycle"] is None and cycle[4]["band"] == "六月以上"
    assert 3 not in cycle and None in cycle
    assert {k: r["paymentName"] for k, r in rows(orders.preferred_payment(frame)).items()} == {
        1: "card", 2: "a", 4: None, None: "card",
    }
    average = rows(orders.avg_order_band(frame))
    assert average[1]["aov"] == 999.0 and average[1]["band"] == "1-999" and average[4]["band"] is None
    largest = rows(orders.max_order_band(frame))
    assert largest[1]["max_amount"] == 999 and largest[1]["band"] == "1-999" and largest[4]["band"] == ">9999"
    back = rows(orders.return_propensity(frame))
    assert (back[1]["exchange_rate"], back[1]["return_rate"], back[1]["exchange_level"]) == (0.2, 0.2, "高")
    assert back[2]["exchange_level"] == "低" and back[3]["exchange_rate"] == 1.0
    whole = rows(orders.consumer_profile(frame))
    assert set(whole) == {1, 2, 4, None}
    assert whole[1].asDict() == {
        "id": 2, "memberId": 1, "cycle": "六月以上", "paymentName": "card", "avg_order_band": "1-999",
        "max_order_band": "1-999", "frequency": "低", "exchange": "高", "return": "高",
    }
    assert whole[2]["paymentName"] == "a" and whole[4]["paymentName"] is None


def test_every_day_of_the_year_counts_once(spark):
    from datetime import timedelta

    days = [(datetime(2020, 1, 1) + timedelta(n)).isoformat() for n in range(366)]
    frame = spark.createDataFrame([order(i, 1, day=d) for i, d in enumerate(days * 2)], ORDERS)
    assert orders.member_facts(frame).first()["days"] == 366


def test_rfm_scores_close_the_gaps_unless_strict(spark):
    metrics = spark.createDataFrame(
        [(1, 0, 200, Decimal("199999.50")), (2, 16, 49, Decimal("9999.50")), (3, None, 1, Decimal("5"))],
        "memberId bigint, recency int, frequency bigint, money decimal(18,2)",
    )
    assert {k: tuple(r)[1:] for k, r in rows(orders.rfm_scores(metrics)).items()} == {1: (5, 5, 4), 2: (1, 1, 1), 3: (1, 1, 1)}
    assert {k: tuple(r)[1:] for k, r in rows(orders.rfm_scores(metrics, strict=True)).items()} == {
        1: (None, 5, None), 2: (1, 1, None), 3: (None, 1, 1),
    }


def test_rfm_shift(spark):
    frame = spark.createDataFrame([order(1, 1, day="2020-01-01T23:00:00")], ORDERS)
    assert orders.rfm_metrics(frame, "2020-01-11").first()["recency"] == 10
    assert orders.rfm_metrics(frame, date(2020, 1, 11), 7).first()["recency"] == 3


def line(sn, product="p", kind="t", coupon="0", activity_price="0"):
    money = lambda v: None if v is None else Decimal(v)
    return (sn, kind, product, money(coupon), money(activity_price))


def test_coupon_scores_with_cards_on_orders(spark):
    placed = spark.createDataFrame(
        [order(1, 1, gift="0.5"), order(2, 1, gift="0.00"), order(3, 1, status="1", gift="9"), order(4, 2, gift="1"), order(5, 3, gift=None)],
        ORDERS,
    )
    lines = spark.createDataFrame(
        [line("s1", coupon="0.5"), line("s1", coupon="0.00"), line("s1", coupon=None), line("s2", coupon="1", activity_price="3"),
         line("s3", coupon="1"), line("zz", coupon="1")],
        GOODS,
    )
    cuts = [*[__import__("patronlens.functions.rules", fromlist=["eq"]).eq(n, n) for n in range(9)]]
    got = {k: tuple(r)[1:] for k, r in rows(baskets.coupon_scores(placed, lines, cuts, cuts, cuts)).items()}
    # member 1: s1 has three lines and a card, s2 none; member 2 has an order without lines
    assert got == {1: (2, 3, 1), 2: (0, 1, 0), 3: (0, 0, 0)}


def test_product_preference_ties_and_depth(spark):
    placed = spark.createDataFrame([order(1, 1), order(2, 2), order(3, 3), order(4, 1, status="1")], ORDERS)
    lines = spark.createDataFrame(
        [line("s1", p, k) for p, k in [("b", "x"), ("a", "y"), ("c", "y"), ("c", "y"), ("d", "x"), ("d", "x")]]
        + [line("s2", p) for p in ("a", "b")] + [line("s3", p) for p in ("c", "b", "a")] + [line("s4", "a")] * 9,
        GOODS,
    )
    got = {k: tuple(r)[1:] for k, r in rows(baskets.product_preference(placed, lines)).items()}
    assert got == {1: ("x", "c", "d", "a"), 3: ("t", "a", "b", "c")}
    assert set(rows(baskets.product_preference(placed, lines, k=2))) == {1, 2, 3}


def test_weekly_basket_parts_join_to_the_whole(spark):
    users = spark.createDataFrame([(1, "a@x", "131"), (2, "b@x", "132")], "id bigint, email string, mobile string")
    placed = spark.createDataFrame([order(1, 1), order(2, 1, day="2021-01-04"), order(3, 1, day="2019-01-03"), order(4, 9)], ORDERS)
    lines = spark.createDataFrame(
        [line("s1", "b")] * 5 + [line("s3", "a")] * 4 + [line("s1", None)] + [line("s2", "z"), line("s4", "q")], GOODS
    )
    whole = {(r["id"], r["cycle"]): r for r in baskets.weekly_basket(placed, lines, users).collect()}
    # 2020-01-01, 2019-01-03 and 2021-01-04 are all in week 1 of their year
    assert list(whole) == [(1, 1)]
    assert whole[1, 1]["products"] == ["a"] * 4 + ["b"] * 5 + ["z"] and whole[1, 1]["count"] == 11
    parts = sorted(baskets.weekly_basket(placed, lines, users, part_size=3).collect(), key=lambda r: r["part"])
    assert [r["part"] for r in parts] == [0, 1, 2, 3] and all(r["count"] == 11 for r in parts)
    assert sum((r["products"] for r in parts), []) == whole[1, 1]["products"]
    years = baskets.weekly_basket(placed, lines, users, with_year=True).collect()
    assert {(r["year"], r["cycle"], r["count"]) for r in years} == {(2019, 1, 4), (2020, 1, 6), (2021, 1, 1)}
    shown = {(r["id"], r["cycle"]): (r["count"], r["preview"]) for r in baskets.basket_preview(placed, lines, users).collect()}
    assert shown == {(1, 1): (11, "a,a,a等")}


def test_brand_weights(spark):
    placed = spark.createDataFrame([order(1, 1), order(2, 2), order(3, 3), order(4, 4)], ORDERS)
    lines = spark.createDataFrame(
        [line("s1", "杯子")] * 30 + [line("s1", "海尔 a")] * 2
        + [line("s2", "海尔 a")] * 9 + [line("s2", "卡萨帝 b")]
        + [line("s3", "杯子")]
        + [line("s4", "统帅 c"), line("s4", "卡萨帝 d")],
        GOODS,
    )
    got = {k: r["brand"] for k, r in rows(baskets.brand_preference(placed, lines)).items()}
    assert got == {1: "海尔", 2: "卡萨帝", 3: "无偏好", 4: "卡萨帝"}
    users = spark.createDataFrame([(1,), (4,), (7,)], "id bigint")
    rated = {(r["user_id"], r["brand"]): r["rating"] for r in baskets.brand_ratings(users, placed, lines).collect()}
    assert rated == {(1, 5): 2, (4, 1): 1, (4, 2): 1}


def test_discount_scores_on_orders(spark):
    placed = spark.createDataFrame(
        [order(1, 1, amount="95", listed="100"), order(2, 2, amount="97.5", listed="100"), order(3, 2, amount="1", listed="0"),
         order(4, 3, amount="99", listed="100"), order(5, 3, status="1", amount="1", listed="100")],
        ORDERS,
    )
    got = {k: tuple(r)[1:] for k, r in rows(baskets.discount_scores(placed)).items()}
    assert got == {1: (1, 1, 4), 2: (1, 1, 2), 3: (1, 1, 1)}


def test_login_intensity_and_absent_users(spark):
    users = spark.createDataFrame(
        [(1, date(2020, 1, 10), date(2020, 1, 1)), (2, date(2020, 1, 1), date(2020, 1, 2)), (3, date(2020, 1, 1), date(2020, 1, 1)), (4, None, None)],
        "id bigint, lastLoginTime date, registerTime date",
    )
    logs = spark.createDataFrame(
        [(1, "/login", datetime(2020, 1, 1))] * 100 + [(2, "/login", datetime(2020, 1, 1)), (3, "/index", datetime(2020, 1, 1)), (4, "/login", None)],
        "global_user_id bigint, loc_url string, log_time timestamp",
    )
    got = {k: (r["rate"], r["band"]) for k, r in rows(profile.login_intensity(users, logs), "id").items()}
    assert got == {1: (10.0, "一般"), 2: (None, None), 3: (0.0, "无"), 4: (None, None)}


def test_region_display(spark):
    users = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None)], "id int, region_key string")
    regions = spark.createDataFrame([("a", "P", "C"), ("b", "P", ""), ("c", "", None)], "region_key string, province string, city string")
    shown = {k: tuple(r)[1:] for k, r in rows(profile.with_region(users, regions, display=True), "id").items()}
    assert shown == {1: ("P", "C"), 2: ("P", "P"), 3: ("查询失败", "查询失败"), 4: ("查询失败", "查询失败")}


def test_browse_slots_with_an_unreadable_time(spark):
    logs = spark.createDataFrame(
        [(1, datetime(2024, 1, 1, h)) for h in (0, 9, 9, 23)] + [(1, None), (2, datetime(2024, 1, 1, 14))],
        "global_user_id int, log_time timestamp",
    )
    got = sorted((r["user_id"], r["rank"], r["slot"], r["count"]) for r in activity.browse_slots(logs).collect())
    assert got == [(1, 1, "8点-12点", 2), (1, 2, "22点-24点", 1), (1, 3, "0点-7点", 1), (1, 4, None, 0), (2, 1, "13点-17点", 1)]


def test_page_frequency_of_a_single_view(spark):
    logs = spark.createDataFrame(
        [(1, "/login", datetime(2024, 1, 1))]
        + [(2, "/index", datetime(2024, 1, d)) for d in (1, 1, 1, 2)]
        + [(3, "/index", datetime(2024, 1, d)) for d in (1, 11)]
        + [(4, "/index", datetime(2024, 1, d)) for d in (1, 2, 3)],
        "global_user_id int, loc_url string, log_time timestamp",
    )
    got = {r["user_id"]: r["frequency"] for r in activity.page_frequency(logs).collect()}
    assert got == {1: "偶尔", 2: "经常", 3: "偶尔", 4: "很少"}


def test_spend_by_suffix_merges_members(spark):
    from patronlens.functions.keys import member_key

    placed = spark.createDataFrame([order(1, 1001, amount="1.60"), order(2, 2001, amount="1.30"), order(3, 3, status="1")], ORDERS)
    users = spark.createDataFrame([(1, "c")], "id bigint, city string")
    assert reports.spend_by(placed, users, "city").collect() == []
    merged = reports.spend_by(placed, users, "city", member=member_key("memberId").cast("bigint"))
    assert merged.collect() == [("c", 2)]


def test_zodiac_series_has_all_signs(spark):
    by_sign = spark.createDataFrame([("双鱼座", 5), ("其他", 9)], "constellation string, amount bigint")
    got = [tuple(r) for r in reports.zodiac_series(by_sign).collect()]
    assert len(got) == 12 and got[0] == (1, "白羊座", 0) and got[11] == (12, "双鱼座", 5)


def test_product_ratings(spark):
    logs = spark.createDataFrame(
        [(1, "/product/5.html"), (1, "/product/5.html"), (1, "/product/x.html"), (2, "/item")],
        "global_user_id bigint, loc_url string",
    )
    assert recommend.product_ratings(logs).collect() == [(1, 5, 2)]
