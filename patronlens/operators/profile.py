"""Who the users are and how they log in."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.functions import dates, rules, web
from patronlens.functions.labels import band, decode, ratio

PROFILE_COLUMNS = [
    "id", "username", "gender", "email", "mobile", "province", "city", "birthday", "log_recent",
    "log_f", "job", "politicalFace", "nationality", "marriage", "age", "constellation", "is_blackList",
]


def login_summary(logs: DataFrame) -> DataFrame:
    """Last view and number of login pages per user."""
    login = web.page_type("loc_url") == rules.LOGIN_PAGE
    return logs.groupBy(F.col("global_user_id").alias("user_id")).agg(
        F.max("log_time").alias("last_log"), F.count_if(login).alias("login_count")
    )


def _demographic_columns():
    return [
        decode("gender", rules.GENDER, rules.GENDER_ELSE).alias("gender"),
        decode("job", rules.JOB, rules.JOB_ELSE).alias("job"),
        decode("politicalFace", rules.POLITICAL, rules.POLITICAL_ELSE).alias("politicalFace"),
        decode("nationality", rules.NATIONALITY, rules.NATIONALITY_ELSE).alias("nationality"),
        decode("marriage", rules.MARRIAGE, rules.MARRIAGE_ELSE).alias("marriage"),
        decode("is_blackList", rules.BLACKLIST, rules.BLACKLIST_ELSE).alias("is_blackList"),
    ]


def demographics(users: DataFrame) -> DataFrame:
    return users.select("id", *_demographic_columns())


def generation_band(users: DataFrame) -> DataFrame:
    return users.select("id", dates.generation("birthday").alias("age"))


def zodiac(users: DataFrame) -> DataFrame:
    return users.select("id", dates.zodiac("birthday").alias("constellation"))


def labelled_users(users: DataFrame) -> DataFrame:
    """Users with every label that needs no other table."""
    return users.select(
        *[c for c in users.columns if c not in ("gender", "job", "politicalFace", "nationality", "marriage", "is_blackList")],
        *_demographic_columns(),
        dates.generation("birthday").alias("age"),
        dates.zodiac("birthday").alias("constellation"),
    )


def days_since(as_of: date | str, moment: str):
    return F.datediff(F.lit(str(as_of)).cast("date"), F.col(moment))


def recency_band(days):
    return band(days, rules.LOGIN_RECENCY, rules.LOGIN_RECENCY_ELSE)


def login_recency(logs: DataFrame, as_of: date | str) -> DataFrame:
    summary = login_summary(logs).withColumn("days", days_since(as_of, "last_log"))
    return summary.select("user_id", "days", recency_band("days").alias("band"))


def _intensity():
    account_days = F.datediff(F.col("lastLoginTime"), F.col("registerTime")) + 1
    return ratio(F.col("login_count"), account_days)


def login_intensity(users: DataFrame, logs: DataFrame, cuts=rules.LOGIN_INTENSITY) -> DataFrame:
    """Login pages per day of account age."""
    joined = users.join(login_summary(logs), F.col("id") == F.col("user_id"))
    rated = joined.select("id", _intensity().alias("rate"))
    return rated.select("id", "rate", band("rate", cuts).alias("band"))


def with_region(users: DataFrame, regions: DataFrame, key: str = "region_key", display: bool = False) -> DataFrame:
    """Province and city by region key.

    A small dimension is broadcast by Spark itself below its size threshold and
    sort-merge joined above it. ``display`` fills blanks the way the user page does.
    """
    joined = users.join(regions.select(key, "province", "city"), key, "left").drop(key)
    if not display:
        return joined
    known = F.nullif(F.col("province"), F.lit(""))
    province = F.coalesce(known, F.lit(rules.REGION_UNKNOWN))
    city = F.coalesce(F.nullif(F.col("city"), F.lit("")), province)
    return joined.withColumns({"province": province, "city": city})


def with_prefix_region(users: DataFrame, regions: DataFrame, number: str = "mobile", key: str = "region_key") -> DataFrame:
    """Province and city of the longest region prefix that ``number`` begins with; null where none does.

    ``regions`` holds prefixes of several lengths, nested ones too; of rows with an equal prefix the one
    with the highest province, then city, counts. Each distinct number gives one row for each length that
    occurs among the prefixes (these lengths, at most as many as the longest prefix has characters, reach the
    driver) and meets the prefixes in one equi-join, so nothing is compared by range or pattern. An empty prefix matches every number.
    """
    known = regions.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_prefix")).agg(
        F.max(F.struct("province", "city")).alias("_region")
    )
    lengths = [r[0] for r in known.select(F.length("_prefix")).distinct().collect()]
    numbers = users.select(F.col(number).alias("_number")).where("_number IS NOT NULL").distinct()
    fits = F.filter(F.array(*[F.lit(n) for n in sorted(lengths)]).cast("array<int>"), lambda n: n <= F.length("_number"))
    tried = numbers.select("_number", F.explode(fits).alias("_length")).withColumn("_prefix", F.left("_number", F.col("_length")))
    best = tried.join(known, "_prefix").groupBy("_number").agg(F.max(F.struct("_length", "_region")).alias("_best"))
    return users.drop("province", "city").join(best, users[number] == best["_number"], "left").select(
        *[c for c in users.columns if c not in ("province", "city")],
        F.col("_best._region.province").alias("province"), F.col("_best._region.city").alias("city"),
    )


def user_profile(
    users: DataFrame,
    logs: DataFrame,
    regions: DataFrame,
    as_of: date | str,
    how: str = "inner",
    intensity_cuts=rules.LOGIN_INTENSITY,
) -> DataFrame:
    """The user table: demographics, region, login labels.

    Users without any page view are left out unless ``how`` is ``left``.
    """
    joined = labelled_users(users).join(login_summary(logs), F.col("id") == F.col("user_id"), how)
    labelled = with_region(joined, regions).withColumns(
        {
            "log_recent": recency_band(days_since(as_of, "last_log")),
            "log_f": band(_intensity(), intensity_cuts),
        }
    )
    return labelled.select(*PROFILE_COLUMNS)
