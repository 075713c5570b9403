"""Batches through one index give what one batch gives, and later ones meet a filled index."""

import pytest
from compare import SMALL

from patronlens.llm import exact_dedup as ed
from patronlens.llm.queries import QUERIES
from patronlens.operators.lineage import new_folder

ROWS = [(i, f"text {i % 13}") for i in range(60)] + [(None, "text 3"), (None, "alone"), (None, None), (7, "text 7"), (90, "")]


def decided(spark, rows, batches):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in ed.decide(docs, ed.new_index(spark, 4), batches).collect()), key=repr)


@pytest.mark.parametrize("batches", [2, 3])
def test_batches_change_no_row(spark, batches):
    assert decided(spark, ROWS, batches) == decided(spark, ROWS, 1)
    for rows in ([(None, "a"), (None, "a")], [(1, "a")], []):
        assert decided(spark, rows, batches) == decided(spark, rows, 1)


def test_query_joins_its_second_batch_to_a_filled_index(spark, monkeypatch):
    met, append = [], ed.DigestIndex.append

    def seen(index, groups):
        held, before = index.rows().count(), groups.count()
        out = append(index, groups)
        met.append((held, before - out.count()))
        return out

    monkeypatch.setattr(ed.DigestIndex, "append", seen)
    QUERIES["op5_exact_dedup"](spark, SMALL).count()
    assert len(met) == 2 and met[1][0] > 0 and met[1][1] > 0


def test_indexes_of_one_last_name_are_two(spark):
    a, b = (ed.DigestIndex(spark, f"{new_folder(spark, kind)}/idx", 4) for kind in ("one", "two"))
    docs = spark.createDataFrame([(1, "x"), (2, "y")], "doc_id long, text string")
    assert a.add(docs).count() == 2
    assert b.rows().count() == 0 and [r.kept for r in ed.decide(docs, b).collect()] == [True, True]
    with pytest.raises(ValueError, match="4 buckets"):
        ed.DigestIndex(spark, a.path, 8)


def test_deciding_does_not_move_the_index(spark, monkeypatch):
    plans, settle = [], ed.settle
    monkeypatch.setattr(ed, "settle", lambda rows: plans.append(rows._jdf.queryExecution().executedPlan().toString()) or settle(rows))
    index = ed.new_index(spark, 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for i in range(3):
            ed.decide(spark.createDataFrame([(10 * i + j, f"t{i} {j}") for j in range(5)], "doc_id long, text string"), index)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joined = [p for p in plans if index.table in p]
    assert len(joined) == 6 and all("Bucketed: true" in p for p in joined)
    for text in joined:
        lines = text.split("\n")
        at = next(i for i, line in enumerate(lines) if index.table in line)
        assert "Exchange" not in lines[at - 1] and "Exchange" not in lines[at - 2] and "Exchange" not in lines[at - 3]
