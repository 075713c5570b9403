"""Collaborative filtering on page views and purchases."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patronlens.functions import rules, web
from patronlens.operators.lineage import new_folder, settle
from patronlens.operators.skew import split_join

FOLD_TOLERANCE = 1e-3  # of a user's largest factor: factors are 32-bit numbers


def product_ratings(logs: DataFrame) -> DataFrame:
    """Page views per user and product."""
    viewed = logs.select(F.col("global_user_id").alias("user_id"), web.product_id("loc_url").alias("product"))
    return viewed.filter(F.col("product").isNotNull()).groupBy("user_id", "product").agg(F.count("product").alias("rating"))


def fit(
    ratings: DataFrame,
    item: str,
    user: str = "user_id",
    rank: int = rules.ALS_RANK,
    iterations: int = rules.ALS_ITERATIONS,
    regularisation: float = rules.ALS_REGULARISATION,
    alpha: float = rules.ALS_ALPHA,
    seed: int = 0,
    blocks: int | None = None,
) -> ALSModel:
    """Implicit-feedback factors; rows without a user or item take no part.

    Users and items are spread over ``blocks`` blocks each, by default as many as the
    cluster runs tasks at once, as every block holds its share of all ratings.
    """
    blocks = blocks or max(2, ratings.sparkSession.sparkContext.defaultParallelism)
    estimator = ALS(
        numUserBlocks=blocks, numItemBlocks=blocks,
        userCol=user, itemCol=item, ratingCol="rating", rank=rank, maxIter=iterations,
        regParam=regularisation, alpha=alpha, implicitPrefs=True, coldStartStrategy="drop", seed=seed,
    ).setPredictionCol("predict")
    return estimator.fit(ratings.dropna(subset=[user, item]))


def save_model(model: ALSModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> ALSModel:
    return ALSModel.load(path)


def top_items(model: ALSModel, k: int, users: DataFrame | None = None) -> DataFrame:
    """The ``k`` best items per user: array of ids, and the same as comma text.

    ``users`` (with the model's user column) limits the scoring to those users.
    """
    user, item = model.getUserCol(), model.getItemCol()
    scored = model.recommendForAllUsers(k) if users is None else model.recommendForUserSubset(users, k)
    items = F.transform("recommendations", lambda r: r[item])
    return scored.select(F.col(user).cast("bigint").alias("id"), items.alias("items")).withColumn(
        "favorites", F.array_join(F.transform("items", lambda i: i.cast("string")), ",")
    )


def settled(model: ALSModel, spark: SparkSession) -> ALSModel:
    """The model saved to the shared folder and loaded again.

    The factors then outlive lost executors, and they come back in partitions sized by
    their bytes. Scoring pairs every partition of users with every partition of items,
    so the many blocks that suit the fit would mean far too many tasks.
    """
    path = new_folder(spark, "model")
    save_model(model, path)
    return load_model(path)


def dense_ids(rows: DataFrame, column: str) -> DataFrame:
    """(column, dense): every id with a number from 0 on, in order of the ids.

    The factorisation takes 32-bit ids only. The ids are written in ranges with the
    number of their range, so that numbering needs the counts of the few ranges and
    sorts each range by itself.
    """
    ids = rows.select(column).dropna().distinct().repartitionByRange(column)
    ids = settle(ids.withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ids.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    place = F.row_number().over(Window.partitionBy("_range").orderBy(column)) - 1
    return settle(
        ids.join(offsets, "_range").select(column, (F.col("_offset") + place).cast("int").alias("dense"))
    )


def train(ratings: DataFrame, item: str, user: str = "user_id", **options) -> tuple[ALSModel, DataFrame, DataFrame]:
    """A settled model for ids of any size or type, and its tables (user, dense) and (item, dense)."""
    ratings = settle(ratings)  # numbered twice and joined: computed once
    users, items = dense_ids(ratings, user), dense_ids(ratings, item)
    numbered = (
        ratings.join(users.withColumnRenamed("dense", "_user"), user)
        .join(items.withColumnRenamed("dense", "_item"), item)
        .select("_user", "_item", "rating")
    )
    return settled(fit(numbered, "_item", "_user", **options), ratings.sparkSession), users, items


def _named(model: ALSModel, users: DataFrame, items: DataFrame, item: str, k: int, user: str) -> DataFrame:
    """The best items of all users of the model, with the ids that the tables have for the numbers."""
    best = top_items(model, k).select(F.col("id").cast("int").alias("dense"), F.posexplode("items").alias("place", "_item"))
    named = best.join(items.withColumnRenamed("dense", "_item"), "_item").groupBy("dense").agg(
        F.sort_array(F.collect_list(F.struct("place", item))).alias("ranked")
    )
    return named.join(users, "dense").select(
        F.col(user).alias("id"), F.transform("ranked", lambda r: r[item]).alias("items")
    ).withColumn("favorites", F.array_join(F.transform("items", lambda i: i.cast("string")), ","))


def recommend(ratings: DataFrame, item: str, k: int, user: str = "user_id", **options) -> DataFrame:
    """The ``k`` best items per user, for ids of any size or type: (id, items, favorites)."""
    return _named(*train(ratings, item, user, **options), item, k, user)


def fold_in(
    model: ALSModel, ratings: DataFrame, regularisation: float = rules.ALS_REGULARISATION, alpha: float = rules.ALS_ALPHA
) -> ALSModel:
    """The model with factors for the users of ``ratings`` and no others, whether the fit has seen them or not.

    The item factors stay. A user's factors solve the normal equations that the last half step of the fit
    solves, so users of the fit with the ratings of the fit get their own factors back; ``regularisation`` (above zero) and ``alpha``
    are those of the fit. Ratings of items that the model does not know add nothing, and users
    without a rating above zero of a known item get no factors.

    Sums over a user's items merge, so a user with any share of the ratings is added up where they
    lie; an item with any share meets its one factor in a split join. The small systems are solved by whole Arrow batches.
    """
    spark, rank = ratings.sparkSession, model.rank
    user, item = model.getUserCol(), model.getItemCol()
    upper = [(i, j) for i in range(rank) for j in range(i, rank)]
    y = [F.col("features")[i].cast("double") for i in range(rank)]
    # Every item weighs one in the sum that all users share.
    shared = list(model.itemFactors.agg(*[F.sum(y[i] * y[j]).alias(f"p{i}_{j}") for i, j in upper]).first())

    known = ratings.dropna(subset=[user, item, "rating"]).select(user, item, "rating")
    met = split_join(known, model.itemFactors, item, "id")
    confidence, liked = alpha * F.abs("rating"), F.col("rating") > 0
    sums = met.groupBy(user).agg(
        *[F.sum(confidence * y[i] * y[j]).alias(f"p{i}_{j}") for i, j in upper],
        *[F.sum(F.when(liked, (1 + confidence) * y[i]).otherwise(0.0)).alias(f"t{i}") for i in range(rank)],
        F.count_if(liked).alias("liked"),
    ).where("liked > 0")
    rows, columns = np.triu_indices(rank)

    @F.pandas_udf("array<float>")
    def solve(products: pd.Series, target: pd.Series, liked: pd.Series) -> pd.Series:
        full = np.empty((len(products), rank, rank))
        full[:, rows, columns] = full[:, columns, rows] = np.stack(products.to_list()) + np.array(shared)
        full += liked.to_numpy()[:, None, None] * regularisation * np.eye(rank)
        found = np.linalg.solve(full, np.stack(target.to_list())[:, :, None])[:, :, 0]
        return pd.Series(list(found.astype("float32")))

    products, target = F.array(*[f"p{i}_{j}" for i, j in upper]), F.array(*[f"t{i}" for i in range(rank)])
    factors = sums.select(F.col(user).cast("int").alias("id"), solve(products, target, "liked").alias("features"))
    path = new_folder(spark, "model")
    save_model(model, path)
    factors.write.mode("overwrite").parquet(f"{path}/userFactors")
    return load_model(path)


def recommend_folded(
    model: ALSModel, items: DataFrame, ratings: DataFrame, item: str, k: int, user: str = "user_id", **options
) -> DataFrame:
    """``recommend`` for the users of ``ratings`` by a model of a former training; nothing is fitted.

    ``model`` and ``items`` are what ``train`` gave. Ids may be of any size or type. Users of whom the model knows no item get no list.
    """
    known = settle(ratings.join(items.withColumnRenamed("dense", "_item"), item).select(user, "_item", "rating"))
    users = dense_ids(known, user)
    numbered = known.join(users.withColumnRenamed("dense", "_user"), user).select("_user", "_item", "rating")
    return _named(fold_in(model, numbered, **options), users, items, item, k, user)


def fold_audit(ratings: DataFrame, item: str, k: int, user: str = "user_id") -> DataFrame:
    """``recommend_audit`` of folded lists, and ``strayed``: users of the fit who do not get their own factors back."""
    ratings = settle(ratings)
    model, users, items = train(ratings, item, user)
    numbered = ratings.join(users.withColumnRenamed("dense", "_user"), user).join(items.withColumnRenamed("dense", "_item"), item)
    again = fold_in(model, numbered).userFactors.withColumnRenamed("features", "folded")
    off = F.array_max(F.zip_with("features", "folded", lambda a, b: F.abs(a - b)))
    size = F.array_max(F.transform("features", lambda a: F.abs(a)))
    strayed = model.userFactors.join(again, "id", "left").agg(
        F.lit("strayed").alias("measure"), F.count_if(F.coalesce(off > FOLD_TOLERANCE * size, F.lit(True))).alias("n")
    )
    return recommend_audit(ratings, recommend_folded(model, items, ratings, item, k, user), item, k, user).unionByName(strayed)


def recommend_audit(ratings: DataFrame, best: DataFrame, item: str, k: int, user: str = "user_id") -> DataFrame:
    """Counts (measure, n) that hold whatever the factors: users, lists by length, and what must be zero."""
    rated = ratings.dropna(subset=[user, item])
    known = rated.select(F.col(item).alias("item")).distinct()
    shown = best.select("id", F.explode("items").alias("item"))
    unknown = shown.join(known, "item", "left_anti").agg(F.lit("unknown").alias("measure"), F.count(F.lit(1)).alias("n"))
    strangers = best.join(rated.select(F.col(user).alias("id")).distinct(), "id", "left_anti").agg(
        F.lit("strangers").alias("measure"), F.count(F.lit(1)).alias("n")
    )
    lists = best.agg(
        F.count(F.lit(1)).alias("lists"), F.count_distinct("id").alias("users"),
        F.min(F.size("items")).cast("bigint").alias("shortest"), F.max(F.size("items")).cast("bigint").alias("longest"),
        F.count_if(F.size(F.array_distinct("items")) < F.size("items")).alias("repeats"),
        F.count_if(F.array_join(F.transform("items", lambda i: i.cast("string")), ",") != F.col("favorites")).alias("misprinted"),
    )
    return lists.unpivot([], lists.columns, "measure", "n").unionByName(unknown).unionByName(strangers)
