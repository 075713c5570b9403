"""Segments and recommendations: what must hold whatever the random start."""

import numpy as np
from compare import SMALL

from patronlens.functions import rules
from patronlens.operators import lineage, orders, recommend, segment
from patronlens.plans import queries
from patronlens.sources.standins import ORDERS_AS_OF, StandIns


def scores(spark):
    return queries._scores(StandIns(spark, SMALL))


def test_segments_do_not_depend_on_partitioning(spark):
    frame = scores(spark)
    seen = [
        sorted(map(tuple, segment.rfm_segment(frame.repartition(n, "memberId")).collect())) for n in (1, 5, 13)
    ]
    assert seen[0] == seen[1] == seen[2]
    assert len(seen[0]) == frame.count()


def test_many_vectors_do_not_depend_on_partitioning_either(spark):
    frame = spark.range(12_000).selectExpr("id AS memberId", "id % 251 AS recency", "id % 241 AS frequency", "id % 239 AS money")
    seen = [sorted(map(tuple, segment.rfm_segment(frame.repartition(n)).collect())) for n in (1, 3, 7)]
    assert seen[0] == seen[1] == seen[2]


def test_ids_of_any_size_get_recommendations(spark):
    x = StandIns(spark, "/root/testdata/sf0.001")
    ratings = recommend.product_ratings(x.logs)
    large = ratings.selectExpr("user_id + 13822841014 AS user_id", "product + 5000000000 AS product", "rating")
    best = recommend.recommend(large, "product", 4)
    audit = dict(recommend.recommend_audit(large, best, "product", 4).select("measure", "n").collect())
    users = ratings.select("user_id").distinct().count()
    assert audit == {
        "users": users, "lists": users, "shortest": 4, "longest": 4, "unknown": 0, "strangers": 0, "repeats": 0, "misprinted": 0,
    }
    dense = [r.dense for r in recommend.dense_ids(large, "user_id").orderBy("user_id").collect()]
    assert dense == list(range(users))


def test_titles_write_two_tables_and_all_are_cleared(spark):
    lineage.clear(spark)
    queries.QUERIES["user_titles"](spark, "/root/testdata/sf0.001").count()
    assert lineage.clear(spark) <= 2
    assert lineage.clear(spark) == 0


def test_each_member_is_in_the_nearest_cluster_and_values_follow_the_centres(spark):
    frame = scores(spark)
    model = segment.fit(frame, segment.RFM_COLUMNS, 7)
    centres = [np.array(c) for c in model.clusterCenters()]
    values = segment.rank_clusters(model, 7)
    assert sorted(values.values()) == list(range(8 - len(centres), 8))
    sums = {v: centres[c].sum() for c, v in values.items()}
    assert all(sums[v] <= sums[v + 1] for v in sums if v + 1 in sums)
    assigned = {r[0]: r[1] for r in segment.rfm_segment(frame).collect()}
    for row in frame.collect():
        point = np.array(row[1:4], dtype=float)
        distances = [np.linalg.norm(point - c) for c in centres]
        mine = distances[next(c for c, v in values.items() if v == assigned[row["memberId"]])]
        assert mine <= min(distances) + 1e-9
    table = segment.centers(frame, model, segment.RFM_COLUMNS, 7).collect()
    assert [r["value"] for r in table] == sorted(values.values(), reverse=True)


def test_weighted_fit_equals_a_fit_over_all_rows(spark):
    """Two clear clouds: Lloyd's steps end in the same centres either way."""
    from pyspark.ml.clustering import KMeans

    points = [(1, 1, 1)] * 50 + [(1, 1, 2)] * 10 + [(5, 5, 5)] * 30 + [(5, 5, 4)] * 5
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "memberId int, recency int, frequency int, money int")
    weighted = segment.fit(frame, segment.RFM_COLUMNS, 2, iterations=20).clusterCenters()
    plain = KMeans(k=2, seed=100, maxIter=20, featuresCol="feature").fit(segment.assemble(frame, segment.RFM_COLUMNS))
    by_sum = lambda centres: sorted(map(tuple, centres), key=sum)
    assert np.allclose(by_sum(weighted), by_sum(plain.clusterCenters()))
    assert np.allclose(by_sum(weighted), [(1, 1, 70 / 60), (5, 5, 170 / 35)])


def test_fewer_distinct_vectors_than_clusters(spark):
    frame = spark.createDataFrame([(1, 5, 5, 5), (2, 1, 1, 1), (3, 1, 1, 1)], "memberId int, recency int, frequency int, money int")
    got = {r[0]: r[1] for r in segment.rfm_segment(frame).collect()}
    assert got[1] == 7 and got[2] == got[3] < 7


def test_value_labels_cover_all_values(spark):
    frame = spark.createDataFrame([(v,) for v in range(1, 8)], "value int")
    got = [r[0] for r in frame.select(orders.value_label("value")).collect()]
    assert got == ["很低", "低", "中下", "中", "中上", "高", "超高"]


def test_titles(spark):
    users = spark.createDataFrame([(1,), (2,), (3,)], "id bigint")
    thrift = spark.createDataFrame([(1, 3), (2, 1)], "memberId bigint, value int")
    coupon = spark.createDataFrame([(1, 2), (2, 3), (3, 3)], "memberId bigint, value int")
    got = {r["id"]: (r["memberId"], r["thrift_title"], r["coupon_title"]) for r in segment.user_titles(users, thrift, coupon).collect()}
    assert got == {1: ("1", "省钱能手", "无"), 2: ("2", "无", "有券必买")}


def test_recommendations(spark, tmp_path):
    x = StandIns(spark, "/root/testdata/sf0.001")
    ratings = recommend.product_ratings(x.logs)
    model = recommend.fit(ratings, "product", iterations=3)
    best = recommend.top_items(model, 10).collect()
    users = {r[0] for r in ratings.select("user_id").distinct().collect()}
    assert {r["id"] for r in best} == users
    known = {r[0] for r in ratings.select("product").distinct().collect()}
    for row in best:
        assert len(row["items"]) == min(10, len(known)) == len(set(row["items"]))
        assert set(row["items"]) <= known
        assert row["favorites"] == ",".join(map(str, row["items"]))
    recommend.save_model(model, f"{tmp_path}/als")
    again = recommend.top_items(recommend.load_model(f"{tmp_path}/als"), 10).collect()
    assert sorted(map(str, again)) == sorted(map(str, best))
    some = ratings.select("user_id").distinct().limit(3)
    assert recommend.top_items(model, 2, some).count() == 3


def test_scored_items_match_the_factors(spark):
    """Brute force over the factor matrices."""
    x = StandIns(spark, "/root/testdata/sf0.001")
    model = recommend.fit(recommend.product_ratings(x.logs), "product", iterations=2)
    item = {r["id"]: np.array(r["features"]) for r in model.itemFactors.collect()}
    user = {r["id"]: np.array(r["features"]) for r in model.userFactors.collect()}
    for row in recommend.top_items(model, 3).collect():
        score = {i: float(user[row["id"]] @ f) for i, f in item.items()}
        third = sorted(score.values(), reverse=True)[2]
        assert all(score[i] >= third - 1e-4 for i in row["items"])


def test_users_of_the_fit_get_their_factors_back_and_new_ones_get_lists(spark):
    ratings = recommend.product_ratings(StandIns(spark, "/root/testdata/sf0.001").logs)
    model = recommend.fit(ratings, "product", iterations=3)
    own = {r["id"]: np.array(r["features"]) for r in model.userFactors.collect()}
    again = {r["id"]: np.array(r["features"]) for r in recommend.fold_in(model, ratings).userFactors.collect()}
    assert own.keys() == again.keys()
    assert all(np.abs(own[u] - again[u]).max() <= 1e-3 * np.abs(own[u]).max() for u in own)
    product = ratings.orderBy("product").first()["product"]
    strangers = spark.createDataFrame(
        [(900_001, product, 3), (900_001, -5, 7), (900_002, -5, 1), (900_003, product, 0), (None, product, 1), (900_004, None, 2), (900_005, product, None)],
        "user_id long, product long, rating long",
    )
    folded = recommend.fold_in(model, strangers)
    assert [r["id"] for r in folded.userFactors.collect()] == [900_001]
    # The one new user solves (Y'Y + c y y' + reg) x = (1 + c) y.
    item = {r["id"]: np.array(r["features"], dtype=float) for r in model.itemFactors.collect()}
    every, y, c = np.array(list(item.values())), item[product], rules.ALS_ALPHA * 3
    right = np.linalg.solve(every.T @ every + c * np.outer(y, y) + rules.ALS_REGULARISATION * np.eye(rules.ALS_RANK), (1 + c) * y)
    assert np.allclose(folded.userFactors.first()["features"], right, rtol=1e-3, atol=1e-5)
    assert len(recommend.top_items(folded, 4).first()["items"]) == 4
    assert recommend.top_items(recommend.fold_in(model, strangers.where("false")), 4).count() == 0


def test_folding_takes_ids_of_any_size_and_heavy_users_and_items(spark):
    ratings = recommend.product_ratings(StandIns(spark, "/root/testdata/sf0.001").logs)
    named = ratings.selectExpr("concat('u', user_id) AS user_id", "product + 5000000000 AS product", "rating")
    model, _, items = recommend.train(named, "product", iterations=2)
    first = named.orderBy("product").first()["product"]
    fresh = named.selectExpr("'heavy' AS user_id", "product", "rating").unionByName(
        named.selectExpr("concat(user_id, '+') AS user_id", f"{first} AS product", "rating")
    ).unionByName(named.selectExpr("'unknown' AS user_id", "7L AS product", "1L AS rating"))
    best = {r["id"]: r["items"] for r in recommend.recommend_folded(model, items, fresh, "product", 3).collect()}
    users = {f"{r[0]}+" for r in named.select("user_id").distinct().collect()}
    assert best.keys() == users | {"heavy"}
    known = {r[0] for r in named.select("product").distinct().collect()}
    assert all(len(set(found)) == 3 and set(found) <= known for found in best.values())


def test_rfm_constants():
    assert (rules.RFM_CLUSTERS, rules.KMEANS_SEED, rules.KMEANS_ITERATIONS) == (7, 100, 2)
    assert ORDERS_AS_OF == "2001-08-02"
