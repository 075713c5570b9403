"""Find users and assemble what is known about them."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.functions import rules
from patronlens.sources.tables import BucketedTable

ANY = "none"  # fixed value: a search field left open


def where_equal(rows: DataFrame, **conditions) -> DataFrame:
    """Rows that meet all equalities; rows without a value never match."""
    tests = [F.col(name) == value for name, value in conditions.items()]
    return rows.filter(reduce(lambda a, b: a & b, tests)) if tests else rows


def search_users(profiles: DataFrame, age: str | None = None, job: str | None = None, gender: str | None = None) -> DataFrame:
    """Profiles by any of three attributes; an open field is no condition."""
    asked = {"age": age, "job": job, "gender": gender}
    return where_equal(profiles, **{k: v for k, v in asked.items() if v not in (None, ANY)})


def search_request(profiles: DataFrame, body: str) -> DataFrame:
    """Search with the JSON body of a search form."""
    asked = json.loads(body)
    return search_users(profiles, **{field: asked.get(field) for field in ("age", "job", "gender")})


def by_contact(rows: DataFrame, contact: str) -> DataFrame:
    """Rows of one e-mail address (has an @) or mobile number."""
    return where_equal(rows, **{"email" if "@" in contact else "mobile": contact})


def contact_index(spark: SparkSession, path: str, buckets: int = 64) -> BucketedTable:
    """The table (contact, id) below ``path``, in buckets by contact."""
    return BucketedTable(spark, path, "contact STRING, id BIGINT", "contact", buckets)


def contacts_of(users: DataFrame) -> DataFrame:
    """(contact, id): what each user can be found by, an e-mail address (has an @) and a mobile number."""
    return users.select(F.explode(_offers()).alias("contact"), "id")


def by_indexed_contact(rows: DataFrame, index: BucketedTable, contact: str) -> DataFrame:
    """Rows of one contact: one bucket of the index is read, then ``rows`` by id."""
    return rows.join(index.rows().where(F.col("contact") == contact).select("id"), "id", "left_semi")


def by_indexed_contacts(rows: DataFrame, index: BucketedTable, requests: DataFrame) -> DataFrame:
    """``by_contacts`` through the index: requests meet it where it lies, and users are met by id only."""
    asked = requests.select("contact").distinct()
    return rows.join(index.rows().join(asked, "contact"), "id").select(*rows.columns, "contact")


def _offers() -> Column:
    is_email = lambda c: F.contains(F.col(c), F.lit("@"))
    return F.array_compact(F.array(F.when(is_email("email"), F.col("email")), F.when(~is_email("mobile"), F.col("mobile"))))


def by_contacts(rows: DataFrame, requests: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """The same for a table of requests (column ``contact``): each is answered from its own column.

    Each user offers an e-mail and a mobile number, which are met by one equi-join. With
    ``users`` (id, email, mobile) the requests are resolved to ids there, and ``rows``, which
    may be wide, are met by id; else ``rows`` offer their own contacts. Equal
    requests are answered once.
    """
    offering = rows if users is None else users.select("id", "email", "mobile")
    found = offering.select("*", F.explode(_offers()).alias("contact")).join(requests.select("contact").distinct(), "contact")
    if users is not None:
        found = rows.join(found.select("id", "contact"), "id")
    return found.select(*rows.columns, "contact")


def by_id(rows: DataFrame, value, key: str = "memberId") -> DataFrame:
    return where_equal(rows, **{key: value})


def by_ids(rows: DataFrame, requests: DataFrame, key: str = "memberId") -> DataFrame:
    """Rows of the ids in ``requests`` (column ``wanted``).

    Repeated requests shrink to one before the shuffle, so a much-asked id is no hot key.
    """
    wanted = requests.select("wanted").distinct()
    return rows.join(wanted, F.col(key) == F.col("wanted"), "left_semi")


def as_json(rows: DataFrame) -> DataFrame:
    """Each row as one JSON text; columns without a value are left out."""
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("json"))


def customer_360(
    profiles: DataFrame,
    previews: DataFrame,
    preference: DataFrame,
    consumer: DataFrame,
    slots: DataFrame,
    titles: DataFrame | None = None,
) -> DataFrame:
    """One row per user with all that is known.

    ``previews`` are basket previews: at most one short entry per ISO week, so the
    nested list of a user is bounded however much the user bought.
    """
    week = F.struct("cycle", "count", "preview")
    baskets = previews.groupBy("id").agg(F.sort_array(F.collect_list(week)).alias("baskets"))
    keyed = lambda rows, key: rows.withColumnRenamed(key, "id")
    display = profiles.withColumn("province", F.coalesce(F.nullif(F.col("province"), F.lit("")), F.lit(rules.REGION_UNKNOWN)))
    display = display.withColumn("city", F.coalesce(F.nullif(F.col("city"), F.lit("")), F.col("province")))
    whole = (
        display.join(baskets, "id", "left")
        .join(keyed(preference, "memberId"), "id", "left")
        .join(keyed(consumer.drop("id"), "memberId"), "id", "left")
        .join(keyed(slots, "user_id"), "id", "left")
    )
    if titles is None:
        return whole
    return whole.join(titles.select("id", "thrift_title", "coupon_title"), "id", "left").fillna(
        rules.NO_TITLE, ["thrift_title", "coupon_title"]
    )
