"""Clustered customer segments with stable, ranked names."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.functions import rules
from patronlens.functions.labels import decode
from patronlens.operators.lineage import settle

LAYOUT = 16  # partitions that hold the distinct score vectors, whatever their number


def assemble(rows: DataFrame, columns: Sequence[str], output: str = "feature") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(rows)


def fit(
    rows: DataFrame,
    columns: Sequence[str],
    k: int,
    seed: int = rules.KMEANS_SEED,
    iterations: int = rules.KMEANS_ITERATIONS,
) -> KMeansModel:
    """k-means over the distinct vectors, each weighted by the number of rows it stands for.

    Equal rows pull a centre exactly as one row with their count as weight, so scored
    members shrink to their distinct vectors. These are laid out by their values in a
    fixed number of sorted partitions, which makes the outcome independent of how the
    input was partitioned, at every size.
    """
    vectors = rows.groupBy(*columns).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    vectors = vectors.repartition(LAYOUT, *columns).sortWithinPartitions(*columns)
    # The row solver also copes with fewer distinct vectors than clusters.
    estimator = KMeans(
        k=k, seed=seed, maxIter=iterations, featuresCol="feature", predictionCol="cluster",
        weightCol="weight", solver="row",
    )
    return estimator.fit(assemble(vectors, columns))


def _ordered(model: KMeansModel) -> list[tuple[int, list[float]]]:
    """Clusters from best to worst: highest sum of the centre first, then the centre itself."""
    centres = [(i, [float(x) for x in centre]) for i, centre in enumerate(model.clusterCenters())]
    return sorted(centres, key=lambda c: (-sum(c[1]), [-x for x in c[1]]))


def rank_clusters(model: KMeansModel, k: int) -> dict[int, int]:
    """Cluster id to value: ``k`` for the best, falling by one. Fewer clusters leave the low values out."""
    return {cluster: k - place for place, (cluster, _) in enumerate(_ordered(model))}


MOST_CLUSTERS = 12  # clusters that can be matched to those of a former training


def match_clusters(model: KMeansModel, former: DataFrame, columns: Sequence[str], k: int) -> dict[int, int]:
    """Cluster id to value: that of the centre of ``former`` it is matched to, by least total distance.

    ``former`` is a table as ``centers`` makes it, at most ``MOST_CLUSTERS`` rows. So clusters that trade places in
    the ranking, or whose centres move a little, keep their names. Clusters beyond the former ones take the
    values from ``k`` down that are left, in their ranking. Of equally good matches the one that gives better ranks higher values counts.
    """
    old = sorted(((r["value"], [float(r[c]) for c in columns]) for r in former.select("value", *columns).limit(MOST_CLUSTERS + 1).collect()), reverse=True)
    new = _ordered(model)
    if max(len(old), len(new)) > MOST_CLUSTERS:
        raise ValueError(f"at most {MOST_CLUSTERS} clusters can be matched")
    spare = [v for v in range(k, 0, -1) if v not in {value for value, _ in old}]
    places = [*old, *[(v, None) for v in spare[: max(0, len(new) - len(old))]]]
    # Least cost of the first clusters over each set of places taken, one cluster more at a time.
    least: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for _, centre in new:
        grown: dict[int, tuple[float, list[int]]] = {}
        for taken, (cost, chosen) in least.items():
            for i, (_, place) in enumerate(places):
                if not taken >> i & 1:
                    total = cost + (math.dist(centre, place) if place is not None else 0.0)
                    if taken | 1 << i not in grown or total < grown[taken | 1 << i][0]:
                        grown[taken | 1 << i] = (total, [*chosen, i])
        least = grown
    _, best = min(least.values(), key=lambda c: (c[0], c[1]))
    return {cluster: places[i][0] for (cluster, _), i in zip(new, best, strict=True)}


def centers(
    rows: DataFrame, model: KMeansModel, columns: Sequence[str], k: int, former: DataFrame | None = None
) -> DataFrame:
    """The ``k`` centres as a table, best first; named by rank or, with ``former``, after those of a former training."""
    values = rank_clusters(model, k) if former is None else match_clusters(model, former, columns, k)
    table = sorted(((values[cluster], *centre) for cluster, centre in _ordered(model)), reverse=True)
    schema = "value int, " + ", ".join(f"{c} double" for c in columns)
    return rows.sparkSession.createDataFrame(table, schema)


def kmeans_segment(
    scores: DataFrame, columns: Sequence[str], k: int, key: str = "memberId", former: DataFrame | None = None, **options
) -> DataFrame:
    """(key, value) where value ``k`` is the best-scoring cluster, or the one nearest to the ``former`` one of that value.

    Scores are settled first, so the orders behind them are read once and not again
    for the assignment.
    """
    scores = settle(scores)
    model = fit(scores, columns, k, **options)
    assigned = model.transform(assemble(scores, columns))
    return assigned.select(key, decode("cluster", rank_clusters(model, k) if former is None else match_clusters(model, former, columns, k)).alias("value"))


def segment_centers(scores: DataFrame, columns: Sequence[str], k: int, **options) -> DataFrame:
    return centers(scores, fit(scores, columns, k, **options), columns, k)


def segment_audit(scores: DataFrame, columns: Sequence[str], k: int, key: str = "memberId") -> DataFrame:
    """One row of counts that hold for every clustering: members, vectors, and what must be zero.

    ``unassigned`` members have no segment, ``repeated`` ones have two, ``misplaced`` ones are
    not at their nearest centre, ``unknown`` values are not from 1 to ``k``, ``unranked``
    centres have a higher sum than the one ranked above them.
    """
    scores = settle(scores)
    model = fit(scores, columns, k)
    ordered = _ordered(model)
    segments = kmeans_segment(scores, columns, k, key)
    near = F.array_min(F.array(*[_squares(columns, centre) for _, centre in ordered]))
    own = F.element_at(F.array(*[_squares(columns, centre) for _, centre in ordered]), (k + 1 - F.col("value")).cast("int"))
    joined = scores.join(segments, key, "left")
    drops = sum(sum(low) > sum(high) for (_, high), (_, low) in zip(ordered, ordered[1:], strict=False))
    return joined.agg(
        F.count(F.lit(1)).alias("members"),
        F.count_distinct(*[F.col(c) for c in columns]).alias("vectors"),
        F.count_if(F.col("value").isNull()).alias("unassigned"),
        (F.count(F.lit(1)) - F.count_distinct(key)).alias("repeated"),
        F.count_if(own > near + 1e-9).alias("misplaced"),
        F.count_if(~F.col("value").between(1, k)).alias("unknown"),
        F.lit(drops).cast("bigint").alias("unranked"),
    )


def _squares(columns: Sequence[str], centre: Sequence[float]) -> Column:
    parts = [(F.col(c) - F.lit(x)) * (F.col(c) - F.lit(x)) for c, x in zip(columns, centre, strict=True)]
    return sum(parts[1:], parts[0])


RFM_COLUMNS = ["recency", "frequency", "money"]
COUPON_COLUMNS = ["buy_coupon", "buy_card", "buy_activity"]
DISCOUNT_COLUMNS = ["colbuy", "coldis", "colavgdis"]


def rfm_segment(scores: DataFrame, k: int = rules.RFM_CLUSTERS) -> DataFrame:
    return kmeans_segment(scores, RFM_COLUMNS, k)


def coupon_segment(scores: DataFrame, k: int = rules.TITLE_CLUSTERS) -> DataFrame:
    return kmeans_segment(scores, COUPON_COLUMNS, k)


def discount_segment(scores: DataFrame, k: int = rules.TITLE_CLUSTERS) -> DataFrame:
    return kmeans_segment(scores, DISCOUNT_COLUMNS, k)


def user_titles(users: DataFrame, thrift: DataFrame, coupon: DataFrame, best: int = rules.TITLE_CLUSTERS) -> DataFrame:
    """Titles of users found in both segmentations; the best cluster of each earns its title."""
    title = lambda c, text: F.when(F.col(c) == best, text).otherwise(rules.NO_TITLE)
    joined = (
        users.select("id")
        .join(thrift.select(F.col("memberId").alias("id"), F.col("value").alias("thrift")), "id")
        .join(coupon.select(F.col("memberId").alias("id"), F.col("value").alias("coupon")), "id")
    )
    return joined.select(
        "id",
        F.col("id").cast("string").alias("memberId"),
        "thrift",
        "coupon",
        title("thrift", rules.THRIFT_TITLE).alias("thrift_title"),
        title("coupon", rules.COUPON_TITLE).alias("coupon_title"),
    )
