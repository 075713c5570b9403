"""Query catalogue: every operator over the bundled test tables.

Times, dates and lists are shown as text and decimals as doubles, so that results
compare equal across engines; the operators themselves return typed columns.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.functions import rules
from patronlens.functions.keys import member_key
from patronlens.operators import activity, baskets, lineage, lookup, order_state, orders, profile, recommend, reports, segment
from patronlens.sources import tables
from patronlens.sources.standins import LOGS_AS_OF, ORDERS_AS_OF, StandIns

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BRAND_LABELS = [label for _, label in rules.BRANDS_SCALED]
LATER = "2024-02-20"  # a later reference day, at which users fall into other recency bands


def _query(function: Callable[[StandIns], DataFrame]):
    QUERIES[function.__name__] = lambda spark, directory: function(StandIns(spark, directory))
    return function


def _day(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in columns})


def _moment(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in columns})


def _doubles(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: F.col(c).cast("double") for c in columns})


def _texts(rows: DataFrame, *columns: str, by: str = ", ") -> DataFrame:
    return rows.withColumns({c: F.array_join(c, by) for c in columns})


# --- users and logins ------------------------------------------------------


@_query
def login_summary(x):
    return _moment(profile.login_summary(x.logs), "last_log")


@_query
def demographics(x):
    return profile.demographics(x.users)


@_query
def generation_band(x):
    return profile.generation_band(x.users)


@_query
def zodiac(x):
    return profile.zodiac(x.users)


@_query
def login_recency(x):
    return profile.login_recency(x.logs, LOGS_AS_OF)


@_query
def login_recency_later(x):
    return profile.login_recency(x.logs, LATER)


@_query
def login_intensity(x):
    return profile.login_intensity(x.users, x.logs)


@_query
def login_intensity_scaled(x):
    return profile.login_intensity(x.users, x.logs, rules.LOGIN_INTENSITY_SCALED)


def _profiles(x, how="inner"):
    return profile.user_profile(
        x.users, x.logs, x.regions, LOGS_AS_OF, how, intensity_cuts=rules.LOGIN_INTENSITY_SCALED
    )


@_query
def user_profile(x):
    return _day(profile.user_profile(x.users, x.logs, x.regions, LOGS_AS_OF), "birthday")


@_query
def user_profile_all(x):
    """With users who never viewed a page."""
    return _day(_profiles(x, "left"), "birthday")


@_query
def region_display(x):
    """Region texts as shown; users on the black list stand for those whose region is unknown."""
    known = F.when(F.col("is_blackList") == "0", F.col("region_key"))
    shown = profile.with_region(x.users.select("id", known.alias("region_key")), x.regions, display=True)
    return shown


@_query
def region_by_prefix(x):
    """Area of each user's number by the longest prefix known."""
    return profile.with_prefix_region(x.users.select("id", "mobile"), x.prefixes)


@_query
def ingest_orders(x):
    """Orders typed from text, with what each row lost."""
    typed, rejects, _ = tables.ingest(x.orders_as_text, "tbl_orders")
    told = rejects.select("id", F.array_join("lost", ",").alias("lost"))
    rows = typed.select("id", "memberId", F.col("finishTime").cast("bigint").alias("finished"), F.col("orderAmount").alias("amount"))
    return _doubles(rows.join(told, "id", "left"), "amount")


@_query
def ingest_losses(x):
    """Rows read, and values of each column that could not be."""
    _, _, losses = tables.ingest(x.orders_as_text, "tbl_orders")
    return x.spark.createDataFrame(sorted(losses.items()), "item string, n bigint")


@_query
def member_key_spend(x):
    """Completed spend per three-digit member suffix: members sharing a suffix are merged."""
    keyed = x.done.withColumn("memberId", member_key("memberId"))
    return _doubles(orders.member_facts(keyed).select("memberId", "done", "amount"), "amount")


# --- orders ----------------------------------------------------------------


@_query
def purchase_cycle(x):
    return orders.purchase_cycle(x.done)


@_query
def purchase_cycle_scaled(x):
    return orders.purchase_cycle(x.done, rules.CYCLE_SCALED)


@_query
def purchase_cycle_by_date(x):
    return orders.purchase_cycle(x.done, rules.CYCLE_SCALED, distinct_days="date")


@_query
def preferred_payment(x):
    return orders.preferred_payment(x.done)


@_query
def avg_order_band(x):
    return orders.avg_order_band(x.done)


@_query
def avg_order_band_scaled(x):
    return orders.avg_order_band(x.done, rules.AVG_ORDER_SCALED)


@_query
def max_order_band(x):
    return orders.max_order_band(x.done)


@_query
def max_order_band_scaled(x):
    return orders.max_order_band(x.done, rules.MAX_ORDER_SCALED, rules.MAX_ORDER_SCALED_ELSE)


@_query
def purchase_frequency(x):
    return orders.purchase_frequency(x.done)


@_query
def purchase_frequency_scaled(x):
    return orders.purchase_frequency(x.done, rules.FREQUENCY_SCALED)


@_query
def return_propensity(x):
    return orders.return_propensity(x.orders)


@_query
def return_propensity_scaled(x):
    return orders.return_propensity(x.orders, rules.RETURN_RATE_SCALED)


@_query
def consumer_profile(x):
    return orders.consumer_profile(x.orders)


SCALED_CUTS = {
    "cycle": rules.CYCLE_SCALED,
    "average": rules.AVG_ORDER_SCALED,
    "largest": rules.MAX_ORDER_SCALED,
    "largest_else": rules.MAX_ORDER_SCALED_ELSE,
    "frequency": rules.FREQUENCY_SCALED,
    "returns": rules.RETURN_RATE_SCALED,
}


@_query
def consumer_profile_scaled(x):
    return orders.consumer_profile(x.orders, **SCALED_CUTS)


def _state_of_batches(x):
    """The state after three batches of orders by their day, each merged into what the ones before left."""
    state = order_state.OrderState(x.spark, lineage.new_folder(x.spark, "state"), x.orders, 8)
    day = F.coalesce(F.to_date("modified"), F.lit("1900-01-01").cast("date"))
    for first, last in (("0001-01-01", "1994-06-30"), ("1994-07-01", "1996-12-31"), ("1997-01-01", "9999-12-31")):
        state.add(x.orders.where(day.between(F.lit(first).cast("date"), F.lit(last).cast("date"))))
    return state


@_query
def consumer_profile_merged(x):
    """All order labels from a state that each batch of orders is merged into."""
    return _state_of_batches(x).profile(**SCALED_CUTS)


@_query
def rfm_metrics_merged(x):
    return _doubles(_state_of_batches(x).rfm_metrics(ORDERS_AS_OF), "money")


@_query
def rfm_metrics(x):
    return _doubles(orders.rfm_metrics(x.orders, ORDERS_AS_OF), "money")


@_query
def rfm_metrics_shifted(x):
    """With the reference day moved back by the fixed number of days."""
    return _doubles(orders.rfm_metrics(x.orders, ORDERS_AS_OF, rules.RECENCY_SHIFT_DAYS), "money")


@_query
def rfm_scores(x):
    return orders.rfm_scores(orders.rfm_metrics(x.orders, ORDERS_AS_OF))


@_query
def rfm_scores_strict(x):
    return orders.rfm_scores(orders.rfm_metrics(x.orders, ORDERS_AS_OF), strict=True)


def _scores(x):
    return orders.rfm_scores(
        orders.rfm_metrics(x.orders, ORDERS_AS_OF),
        rules.RECENCY_SCALED, rules.FREQUENCY_SCORE_SCALED, rules.MONEY_SCALED,
    )


@_query
def rfm_scores_scaled(x):
    return _scores(x)


@_query
def rfm_value_total(x):
    return orders.rfm_value_total(_scores(x))


# --- order lines -----------------------------------------------------------


@_query
def product_preference(x):
    return baskets.product_preference(x.done, x.goods)


@_query
def weekly_basket(x):
    return _texts(baskets.weekly_basket(x.done, x.goods, x.users), "products")


@_query
def weekly_basket_by_year(x):
    """Weeks of different years apart, long lists cut into parts of three."""
    return _texts(baskets.weekly_basket(x.done, x.goods, x.users, with_year=True, part_size=3), "products")


@_query
def basket_preview(x):
    return baskets.basket_preview(x.done, x.goods, x.users)


def _coupon_scores(x, *cuts):
    return baskets.coupon_scores(x.orders_with_card, x.lines.drop("giftCardAmount"), *cuts)


COUPON_CUTS = (rules.USE_SCORE_SCALED,) * 3


@_query
def coupon_scores(x):
    return _coupon_scores(x)


@_query
def coupon_scores_scaled(x):
    return _coupon_scores(x, *COUPON_CUTS)


@_query
def coupon_scores_by_line(x):
    """With the gift card kept on the line."""
    return baskets.coupon_scores(x.orders, x.lines)


@_query
def coupon_scores_scaled_by_line(x):
    return baskets.coupon_scores(x.orders, x.lines, *COUPON_CUTS)


def _discount_scores(x):
    return baskets.discount_scores(x.orders_listed, bought=rules.BUY_SCORE_SCALED)


@_query
def discount_scores(x):
    return baskets.discount_scores(x.orders_listed)


@_query
def discount_scores_scaled(x):
    return _discount_scores(x)


@_query
def discount_scores_by_line(x):
    """Lines in place of orders."""
    return baskets.discount_scores(x.done, x.lines)


@_query
def discount_scores_scaled_by_line(x):
    return baskets.discount_scores(x.done, x.lines, bought=rules.BUY_SCORE_SCALED)


def _brand_preference(x):
    return baskets.brand_preference(x.done, x.goods, rules.BRANDS_SCALED, rules.HOUSE_BRAND_SCALED)


@_query
def brand_preference(x):
    return _brand_preference(x)


@_query
def purchase_history(x):
    history = baskets.purchase_history(
        x.orders, x.product_lines, rules.BRANDS_SCALED, rules.HOUSE_BRAND_SCALED, products=x.products
    )
    return _texts(history, "product_scan", "product_buy")


@_query
def purchase_history_parts(x):
    """Long lists cut into parts of five."""
    history = baskets.purchase_history(
        x.orders, x.product_lines, rules.BRANDS_SCALED, rules.HOUSE_BRAND_SCALED, part_size=5, products=x.products
    )
    return _texts(history, "product_scan", "product_buy")


# --- page views ------------------------------------------------------------


@_query
def browse_slots(x):
    return activity.browse_slots(x.logs)


@_query
def slot_series(x):
    return activity.slot_series(x.logs)


def _slot_by_job(x):
    return activity.slot_by_job(x.logs, profile.demographics(x.users))


@_query
def slot_by_job(x):
    return _slot_by_job(x)


@_query
def device_class(x):
    return activity.device_class(x.logs)


@_query
def dwell_time(x):
    return activity.dwell_time(x.logs)


@_query
def page_frequency(x):
    return activity.page_frequency(x.logs)


def _history(x, **options):
    history = activity.browse_history(x.logs, **options)
    return _texts(history, "pages", "slots", "dwells", "devices", "page_kinds", "page_frequencies")


@_query
def browse_history(x):
    return _history(x)


@_query
def browse_history_parts(x):
    """Histories cut into parts of ten views."""
    return _history(x, part_size=10)


# --- reports ---------------------------------------------------------------


@_query
def spend_by_city(x):
    return reports.spend_by(x.done, profile.with_region(x.users, x.regions), "city")


@_query
def spend_by_job(x):
    return reports.spend_by(x.done, profile.demographics(x.users), "job")


def _suffix_users(x):
    """Users whose id is a member suffix, which is how suffix keys name them."""
    return x.users.where(F.col("id") < 1000)


@_query
def spend_by_job_suffix(x):
    """With members named by the last three digits of their number."""
    member = member_key("memberId").cast("bigint")
    return reports.spend_by(x.done, profile.demographics(_suffix_users(x)), "job", member)


@_query
def weekly_basket_suffix(x):
    done = x.done.withColumn("memberId", member_key("memberId").cast("bigint"))
    return _texts(baskets.weekly_basket(done, x.goods, _suffix_users(x)), "products")


@_query
def spend_by_zodiac(x):
    return reports.spend_by(x.done, profile.zodiac(x.users), "constellation")


@_query
def zodiac_series(x):
    return reports.zodiac_series(reports.spend_by(x.done, profile.zodiac(x.users), "constellation"))


def _age_gender(x):
    value = orders.rfm_value_total(_scores(x))
    return reports.value_by(profile.labelled_users(x.users), value, ["age", "gender"])


@_query
def value_by_age_gender(x):
    return _age_gender(x)


def _by_province(x):
    value = orders.rfm_value_total(_scores(x))
    users = profile.with_region(x.users, x.regions)
    return reports.value_by(users, value, ["province"], truncate=True)


@_query
def value_by_province(x):
    return _by_province(x)


@_query
def province_match(x):
    return reports.province_match(_by_province(x).select("province", "value"), x.provinces)


@_query
def gender_totals(x):
    return reports.gender_totals(_age_gender(x))


@_query
def age_gender_matrix(x):
    return reports.age_gender_matrix(_age_gender(x)).withColumnsRenamed({"男": "male", "女": "female"})


def _brand_by_age(x):
    labels = [*BRAND_LABELS, rules.BRAND_NONE]
    return reports.brand_by_age(profile.generation_band(x.users), _brand_preference(x), labels), labels


@_query
def brand_by_age(x):
    return _brand_by_age(x)[0].withColumnRenamed(rules.BRAND_NONE, "none")


@_query
def brand_age_series(x):
    ages = {age: f"born_{age[:2]}s" for age in rules.GENERATION_SERIES}
    return reports.brand_age_series(*_brand_by_age(x)).withColumnsRenamed(ages)


@_query
def job_slot_matrix(x):
    return reports.job_slot_matrix(_slot_by_job(x))


# --- lookups ---------------------------------------------------------------


def _contacts(x):
    """A request per customer: by e-mail for one half, by mobile number for the other."""
    even = F.col("id") % 2 == 0
    return x.users.select(F.when(even, F.col("email")).otherwise(F.col("mobile")).alias("contact"))


def _buyers(x):
    return x.orders.select(F.col("memberId").alias("wanted"))


@_query
def lookup_profile(x):
    return _day(lookup.by_contacts(_profiles(x, "left"), _contacts(x)), "birthday")


@_query
def lookup_profile_indexed(x):
    """Requests met through the contact index."""
    index = lookup.contact_index(x.spark, lineage.new_folder(x.spark, "contacts"), 8)
    index.replace(lookup.contacts_of(x.users))
    return _day(lookup.by_indexed_contacts(_profiles(x, "left"), index, _contacts(x)), "birthday")


@_query
def lookup_basket(x):
    found = lookup.by_contacts(baskets.weekly_basket(x.done, x.goods, x.users), _contacts(x), x.users)
    return _texts(found, "products").drop("id")


@_query
def lookup_consumer(x):
    return lookup.by_ids(orders.consumer_profile(x.orders, **SCALED_CUTS), _buyers(x))


@_query
def lookup_slots(x):
    return lookup.by_ids(activity.browse_slots(x.logs), _buyers(x), key="user_id")


@_query
def lookup_preference(x):
    return lookup.by_ids(baskets.product_preference(x.done, x.goods), _buyers(x))


@_query
def search_users(x):
    return lookup.search_users(_profiles(x, "left"), age="80后", job="学生", gender=lookup.ANY).select(
        "id", "username", "province", "city", "email", "mobile"
    )


@_query
def search_users_three(x):
    body = '{"age": "60后", "job": "教师", "gender": "女"}'
    return lookup.search_request(_profiles(x, "left"), body).select(
        "id", "username", "province", "city", "email", "mobile"
    )


@_query
def search_users_open(x):
    """No condition: everybody."""
    return lookup.search_users(_profiles(x, "left")).select("id", "username", "province", "city", "email", "mobile")


@_query
def profiles_as_json(x):
    return lookup.as_json(profile.demographics(x.users))


def _whole_view(x, consumer, titles=None):
    whole = lookup.customer_360(
        _profiles(x),
        *baskets.preview_and_preference(x.done, x.goods, x.users, lines=x.lines),
        consumer,
        activity.slot_series(x.logs),
        titles,
    )
    week = F.transform("baskets", lambda b: F.concat_ws(":", b["cycle"].cast("string"), b["count"].cast("string"), b["preview"]))
    return _day(whole.withColumn("baskets", F.array_join(week, "; ")), "birthday")


@_query
def customer_360(x):
    return _whole_view(x, orders.consumer_profile(x.orders, **SCALED_CUTS))


# --- clusters and recommendations (no SQL counterpart) ----------------------


def _segments(x):
    return segment.rfm_segment(_scores(x))


@_query
def rfm_segment(x):
    return _segments(x)


@_query
def rfm_centers(x):
    return segment.segment_centers(_scores(x), segment.RFM_COLUMNS, rules.RFM_CLUSTERS)


@_query
def value_label(x):
    return _segments(x).select("memberId", orders.value_label("value").alias("value"))


@_query
def consumer_profile_valued(x):
    return orders.consumer_profile(x.orders, _segments(x), **SCALED_CUTS)


@_query
def value_by_age_gender_segment(x):
    return reports.value_by(profile.labelled_users(x.users), _segments(x), ["age", "gender"])


@_query
def value_by_province_segment(x):
    return reports.value_by(profile.with_region(x.users, x.regions), _segments(x), ["province"], truncate=True)


@_query
def coupon_segment(x):
    return segment.coupon_segment(_coupon_scores(x, *COUPON_CUTS))


@_query
def discount_segment(x):
    return segment.discount_segment(_discount_scores(x))


def _titles(x):
    """Both scores from one pass over the lines."""
    sums = lineage.settle(x.lines.groupBy("cOrderSn").agg(*baskets.coupon_sums(["couponAmount", "activityPrice"]), *x.listed_sums()))
    thrift = baskets.discount_scores(x.listed(sums), bought=rules.BUY_SCORE_SCALED)
    coupon = baskets.coupon_scores(x.orders_with_card, sums, *COUPON_CUTS)
    return segment.user_titles(x.users, segment.discount_segment(thrift), segment.coupon_segment(coupon))


@_query
def user_titles(x):
    return _titles(x)


@_query
def lookup_titles(x):
    return lookup.by_ids(_titles(x), _buyers(x), key="id")


@_query
def product_ratings(x):
    return recommend.product_ratings(x.logs)


@_query
def brand_ratings(x):
    return baskets.brand_ratings(x.users, x.orders, x.goods, rules.BRAND_CODES_SCALED)


@_query
def recommend_products(x):
    return recommend.recommend(recommend.product_ratings(x.logs), "product", rules.TOP_PRODUCTS).drop("items")


@_query
def recommend_brands(x):
    ratings = baskets.brand_ratings(x.users, x.orders, x.goods, rules.BRAND_CODES_SCALED)
    return recommend.recommend(ratings, "brand", rules.TOP_BRANDS).drop("items")


@_query
def customer_360_titled(x):
    """The whole view with the value label among the consumer labels, and with titles."""
    consumer = orders.consumer_profile(x.orders, _segments(x), **SCALED_CUTS)
    return _whole_view(x, consumer, _titles(x))


# --- audits: what must hold whatever clusters and factors come out ----------


@_query
def rfm_segment_audit(x):
    return segment.segment_audit(_scores(x), segment.RFM_COLUMNS, rules.RFM_CLUSTERS)


@_query
def coupon_segment_audit(x):
    return segment.segment_audit(_coupon_scores(x, *COUPON_CUTS), segment.COUPON_COLUMNS, rules.TITLE_CLUSTERS)


@_query
def discount_segment_audit(x):
    return segment.segment_audit(_discount_scores(x), segment.DISCOUNT_COLUMNS, rules.TITLE_CLUSTERS)


@_query
def user_titles_audit(x):
    """Who has titles, and that each title goes with the best segment and no other."""
    title = lambda c, text: F.col(f"{c}_title") == F.when(F.col(c) == rules.TITLE_CLUSTERS, text).otherwise(rules.NO_TITLE)
    right = title("thrift", rules.THRIFT_TITLE) & title("coupon", rules.COUPON_TITLE)
    return _titles(x).select("id", "memberId", right.alias("right"))


@_query
def customer_360_titled_audit(x):
    """Users, those with a value label, and those without a title text (none)."""
    label = lambda: F.col("value").isin(*rules.VALUE_LABELS.values())
    return customer_360_titled(x).agg(
        F.count(F.lit(1)).alias("users"), F.count_if(label()).alias("valued"),
        F.count_if(F.col("value").isNotNull() & ~label()).alias("mislabelled"),
        F.count_if(F.col("thrift_title").isNull() | F.col("coupon_title").isNull()).alias("untitled"),
    )


@_query
def value_label_audit(x):
    """Members of each segmented query: value labels, consumer profiles and reports cover the scored members."""
    labelled = F.count_if(F.col("value").isin(*rules.VALUE_LABELS.values()))
    counts = {
        "labelled": value_label(x).agg(labelled.alias("members")),
        "profiled": consumer_profile_valued(x).agg(labelled.alias("members")),
        "by_age_gender": value_by_age_gender_segment(x).agg(F.sum("users").alias("members")),
        "by_province": value_by_province_segment(x).agg(F.sum("users").alias("members")),
    }
    return reduce(DataFrame.unionByName, [rows.withColumn("query", F.lit(name)) for name, rows in counts.items()])


@_query
def recommend_products_audit(x):
    ratings = recommend.product_ratings(x.logs)
    return recommend.recommend_audit(ratings, recommend.recommend(ratings, "product", rules.TOP_PRODUCTS), "product", rules.TOP_PRODUCTS)


@_query
def recommend_brands_audit(x):
    """With user ids beyond 32 bits, as mobile numbers are."""
    ratings = baskets.brand_ratings(x.users, x.orders, x.goods, rules.BRAND_CODES_SCALED)
    ratings = ratings.withColumn("user_id", F.col("user_id") + 10_000_000_000)
    return recommend.recommend_audit(ratings, recommend.recommend(ratings, "brand", rules.TOP_BRANDS), "brand", rules.TOP_BRANDS)


@_query
def recommend_products_folded_audit(x):
    """Lists of users whose factors come from the stored item factors alone."""
    return recommend.fold_audit(recommend.product_ratings(x.logs), "product", rules.TOP_PRODUCTS)
