"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the table directory, ``BENCH_CPUS`` the number of local cores,
``BENCH_RUNS`` the number of timed runs per query after one untimed run,
``BENCH_QUERIES`` a comma list of names (``all`` for the whole catalogue).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from patronlens.plans.queries import QUERIES

HEADLINE = [
    "user_profile", "consumer_profile", "product_preference", "weekly_basket", "coupon_scores",
    "discount_scores", "rfm_scores", "rfm_segment", "user_titles", "browse_slots", "slot_by_job",
    "dwell_time", "browse_history", "purchase_history", "spend_by_city", "spend_by_job",
    "spend_by_zodiac", "value_by_age_gender", "brand_by_age", "product_ratings", "brand_ratings",
    "recommend_brands", "recommend_products", "lookup_profile", "customer_360",
]


def run(spark: SparkSession, name: str, directory: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE))
    names = list(QUERIES) if names == "all" else names.split(",")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, name, directory)
        seconds[name] = round(statistics.median(run(spark, name, directory) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": directory.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
