"""Placing rows in order must equal a plain sort of each group, whatever the skew."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from patronlens.operators.activity import browse_history, dwell_time
from patronlens.operators.sequence import place

START = datetime(2024, 1, 1)


def make(seed, n=600, users=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = 0 if rng.random() < 0.4 else rng.choice([None, *range(1, users)])
        at = None if rng.random() < 0.03 else START + timedelta(seconds=rng.randrange(4 * 3600) // 7 * 7)
        rows.append((i, user, at))
    return rows


def by_group(rows):
    groups = defaultdict(list)
    for i, user, at in rows:
        groups[user].append((at or datetime.min, i, at))
    return {u: sorted(g) for u, g in groups.items()}


def test_place_equals_a_plain_sort(spark):
    rows = make(1)
    frame = spark.createDataFrame(rows, "id int, user int, at timestamp")
    placed = place(frame, ["user"], ["at", "id"], F.date_trunc("hour", "at"))
    got = {r["id"]: (r["start"], r["total"], r["following"]) for r in placed.collect()}
    assert len(got) == len(rows)
    for group in by_group(rows).values():
        for n, (_, i, _) in enumerate(group):
            following = group[n + 1][2] if n + 1 < len(group) else None
            assert got[i] == (n, len(group), following)


def test_place_with_weights(spark):
    rows = [("a", "x", 2), ("a", "y", 3), ("a", "z", 1), ("b", "x", 5), (None, "q", 4), (None, None, 2)]
    frame = spark.createDataFrame(rows, "k string, v string, n bigint")
    placed = place(frame, ["k"], ["v"], F.left("v", F.lit(1)), F.col("n"))
    got = {(r["k"], r["v"]): (r["start"], r["total"]) for r in placed.collect()}
    assert got == {
        ("a", "x"): (0, 6), ("a", "y"): (2, 6), ("a", "z"): (5, 6), ("b", "x"): (0, 5),
        (None, None): (0, 6), (None, "q"): (2, 6),
    }


def test_dwell_edges(spark):
    seconds = [0, 0, 59, 119, 419, 720]  # gaps 0, 59, 60, 300, 301, none
    logs = [(i, 1, "", "/x", START + timedelta(seconds=s)) for i, s in enumerate(seconds)]
    logs += [(10, 2, "", "/x", START), (11, 2, "", "/x", None), (12, None, "", "/x", START)]
    frame = spark.createDataFrame(logs, "id int, global_user_id int, user_agent string, loc_url string, log_time timestamp")
    got = {r["id"]: r["dwell"] for r in dwell_time(frame).collect()}
    assert got == {
        0: "1分钟内", 1: "1分钟内", 2: "1-5分钟", 3: "1-5分钟", 4: "5分钟以上", 5: "0", 10: "0", 11: None, 12: "0",
    }


def test_history_parts_join_to_the_whole(spark):
    rows = make(2, n=300)
    pages = ["/login", "/order", "/product/1.html", "/other"]
    logs = [(i, u, "iPhone", pages[i % 4], at) for i, u, at in rows]
    frame = spark.createDataFrame(logs, "id int, global_user_id int, user_agent string, loc_url string, log_time timestamp")
    labels = ["登录页", "我的订单页", "商品页", "其他页面"]
    whole = defaultdict(list)
    for r in sorted(browse_history(frame, part_size=7).collect(), key=lambda r: r["part"]):
        assert len(r["pages"]) <= 7
        whole[r["user_id"]] += r["pages"]
    for user, group in by_group(rows).items():
        assert whole[user] == [labels[i % 4] for _, i, _ in reversed(group)]
    one = {r["user_id"]: r["pages"] for r in browse_history(frame).collect()}
    assert one == dict(whole)
