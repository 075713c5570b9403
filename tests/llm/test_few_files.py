"""Tables of few rows are written in few files, whatever the number of shuffle partitions."""

from pathlib import Path

import pytest

from patronlens.llm.common import connected_components
from patronlens.operators import lineage


@pytest.fixture
def finely(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "211")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_components_write_few_files(finely, monkeypatch):
    paths = []
    new = lineage.new_folder
    monkeypatch.setattr(lineage, "new_folder", lambda *a: paths.append(new(*a)) or paths[-1])
    monkeypatch.setattr(lineage, "FILES", 1)
    edges = finely.range(5_000).selectExpr("id AS a", "id - id % 5 AS b").where("a <> b").repartition(211, "a")
    rows = {r.node: r.component for r in connected_components(edges).collect()}
    assert rows == {i: i - i % 5 for i in range(5_000)}
    cores = finely.sparkContext.defaultParallelism
    assert len(paths) >= 3 and max(len(list(Path(p.removeprefix("file:")).glob("part-*"))) for p in paths) <= cores
