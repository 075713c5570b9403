from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql.utils import AnalysisException

from patronlens.sources import tables


def test_conform_types_text_tables(spark):
    raw = spark.createDataFrame(
        [
            ("1", "13822841013", "202", "2020-05-01 10:00:00", "1588327200", "0.50"),
            ("2", "x", "1", "not a time", "soon", "0.00"),
            ("3", None, None, None, None, "much"),
        ],
        "id string, memberId string, orderStatus string, modified string, finishTime string, orderAmount string",
    )
    typed = tables.conform(raw, "tbl_orders")
    assert typed.schema.simpleString() == tables.SCHEMAS["tbl_orders"].simpleString()
    rows = {r["id"]: r for r in typed.collect()}
    assert rows[1]["memberId"] == 13822841013
    assert rows[1]["finishTime"] == datetime(2020, 5, 1, 10)
    assert rows[1]["modified"] == datetime(2020, 5, 1, 10)
    assert rows[1]["orderAmount"] == Decimal("0.50") and rows[2]["orderAmount"] == Decimal("0.00")
    assert rows[2]["memberId"] is None and rows[2]["modified"] is None and rows[2]["finishTime"] is None
    assert rows[3]["orderAmount"] is None and rows[3]["giftCardAmount"] is None


def test_conform_users(spark):
    raw = spark.createDataFrame([("7", "1990-01-02 00:00:00", "0")], "id string, birthday string, registerTime string")
    row = tables.conform(raw, "tbl_users").first()
    assert row["birthday"] == date(1990, 1, 2) and row["registerTime"] == datetime(1970, 1, 1)


def test_read_takes_only_asked_columns(spark, tmp_path):
    raw = spark.createDataFrame([("1", "2", "ua", "/x", "2024-01-01 00:00:00")], "id string, global_user_id string, user_agent string, loc_url string, log_time string")
    tables.conform(raw, "tbl_logs").write.parquet(f"{tmp_path}/tbl_logs")
    frame = tables.read(spark, str(tmp_path), "tbl_logs", ["id", "loc_url"])
    assert frame.collect() == [(1, "/x")]
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint,loc_url:string>" in plan


def rows_at(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).collect())


def test_keyed_write(spark, tmp_path):
    path = f"{tmp_path}/t"
    frame = lambda *rows: spark.createDataFrame(list(rows), "k int, v string, at int")
    tables.write(frame((1, "old", 1), (1, "new", 2), (2, "x", 1)), path, "k", newest="at")
    assert rows_at(spark, path) == [(1, "new", 2), (2, "x", 1)]
    with pytest.raises(AnalysisException):
        tables.write(frame((3, "y", 1)), path, "k")
    tables.write(frame((2, "changed", 3), (4, "z", 3)), path, "k", mode="upsert")
    assert rows_at(spark, path) == [(1, "new", 2), (2, "changed", 3), (4, "z", 3)]
    for _ in range(2):  # appending a key again does not repeat it
        tables.write(frame((9, "more", 1)), path, "k", mode="append")
        assert len(rows_at(spark, path)) == 4
    tables.write(frame((5, "only", 1)), path, "k", mode="overwrite")
    assert rows_at(spark, path) == [(5, "only", 1)]
    assert not tables.table_exists(spark, path + ".old") and not tables.table_exists(spark, path + ".next")


def test_upsert_creates_a_missing_table(spark, tmp_path):
    tables.write(spark.createDataFrame([(1, "a")], "k int, v string"), f"{tmp_path}/new", "k", mode="upsert")
    assert rows_at(spark, f"{tmp_path}/new") == [(1, "a")]


def test_merge_by_key_with_two_keys(spark):
    now = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "k int, j int, v string")
    new = spark.createDataFrame([(1, 2, "c"), (2, 1, "d")], "k int, j int, v string")
    merged = tables.merge_by_key(now, new, ["k", "j"])
    assert sorted(map(tuple, merged.collect())) == [(1, 1, "a"), (1, 2, "c"), (2, 1, "d")]


def test_null_keys_are_one_key(spark, tmp_path):
    path = f"{tmp_path}/t"
    for v in ("x", "y"):
        tables.write(spark.createDataFrame([(None, v), (1, v)], "k int, v string"), path, "k", mode="upsert")
    assert sorted(map(tuple, spark.read.parquet(path).collect()), key=repr) == [(1, "y"), (None, "y")]


@pytest.mark.parametrize("death", ["before the swap", "between the renames", "before the delete", "after the delete"])
def test_an_upsert_that_dies_loses_nothing(spark, tmp_path, death):
    path = f"{tmp_path}/t"
    frame = lambda *rows: spark.createDataFrame(list(rows), "k int, v string")
    tables.write(frame((1, "a"), (2, "b")), path, "k")
    stop = {"before the swap": 0, "between the renames": 1, "before the delete": 2, "after the delete": 3}[death]
    done, steps = [], (tables._rename, tables._delete)

    def dying(step):
        def run(*arguments):
            if len(done) == stop:
                raise KeyboardInterrupt
            done.append(step)
            return step(*arguments)

        return run

    tables._rename, tables._delete = map(dying, steps)
    try:
        tables.write(frame((2, "c"), (3, "d")), path, "k", mode="upsert")
    except KeyboardInterrupt:
        pass
    finally:
        tables._rename, tables._delete = steps
    tables.write(frame((2, "c"), (3, "d")), path, "k", mode="upsert")
    assert rows_at(spark, path) == [(1, "a"), (2, "c"), (3, "d")]
    assert not tables.table_exists(spark, f"{path}.old")


def test_conform_keeps_all_decimals(spark):
    raw = spark.createDataFrame([("1", "0.004"), ("2", "12345678901234567890.1234567891")], "id string, couponAmount string")
    rows = {r["id"]: r["couponAmount"] for r in tables.conform(raw, "tbl_goods").collect()}
    assert rows == {1: Decimal("0.004"), 2: Decimal("12345678901234567890.1234567891")}


def test_view(spark):
    tables.register_view(spark.createDataFrame([(1, 7)], "memberId int, value int"), "consumer_rfm")
    assert spark.sql("SELECT value FROM consumer_rfm").first()[0] == 7


def test_export_passes_everything_to_the_writer():
    calls = {}

    class Writer:
        def mode(self, mode):
            calls["mode"] = mode
            return self

        def option(self, name, value):
            calls[name] = value
            return self

        def jdbc(self, url, table, properties):
            calls.update(url=url, table=table, properties=properties)

    class Frame:
        write = Writer()

    tables.export_jdbc(Frame(), "jdbc:db:x", "consumer_rfm", {"user": "u"}, mode="append", connections=3)
    assert calls == {
        "mode": "append", "numPartitions": 3, "batchsize": 10000, "url": "jdbc:db:x",
        "table": "consumer_rfm", "properties": {"user": "u"},
    }


def test_regions_from_json(spark):
    raw = spark.createDataFrame(
        [(1380000, '{"code":0,"data":{"province":"山东","city":"青岛","sp":"x"}}'), (1390000, '{"data":{"province":"北京","city":""}}'), (1, "oops")],
        "region_key int, body string",
    )
    got = {r["region_key"]: (r["province"], r["city"]) for r in tables.regions_from_json(raw).collect()}
    assert got == {"1380000": ("山东", "青岛"), "1390000": ("北京", ""), "1": (None, None)}


def test_bloom_filters_on_lookup_columns(spark, tmp_path):
    rows = spark.range(50000).selectExpr("id", "concat('u', id * 7919, '@x') AS email")
    tables.write(rows, f"{tmp_path}/plain", "id", unique=True)
    tables.write(rows, f"{tmp_path}/bloom", "id", unique=True, lookups=["email"])
    size = lambda name: sum(f.stat().st_size for f in (tmp_path / name).glob("*.parquet"))
    assert size("bloom") > size("plain")
    assert spark.read.parquet(f"{tmp_path}/bloom").filter("email = 'u7919@x'").collect() == [(1, "u7919@x")]


@pytest.mark.parametrize("mode", ["upsert", "append"])
@pytest.mark.parametrize("key, owner", [(["id", "cycle", "part"], "id"), (["user_id", "part"], "user_id"), (["memberId", "part"], "memberId")])
def test_a_list_that_shrinks_keeps_no_former_part(spark, tmp_path, mode, key, owner):
    path = f"{tmp_path}/lists"
    schema = ", ".join(f"{k} long" for k in key) + ", items array<string>"
    def lists(parts):
        """(owner, number of parts, mark of the run)."""
        rows = [(o, *[1] * (len(key) - 2), p, [mark]) for o, n, mark in parts for p in range(n)]
        return spark.createDataFrame(rows, schema)

    tables.write(lists([(1, 3, "old"), (2, 2, "old"), (None, 2, "old")]), path, key, mode, unique=True, owner=owner)
    tables.write(lists([(1, 1, "new"), (None, 1, "new"), (3, 1, "new")]), path, key, mode, unique=True, owner=owner)
    found = sorted((repr(r[0]), r["part"], r["items"][0]) for r in spark.read.parquet(path).collect())
    assert found == [("1", 0, "new"), ("2", 0, "old"), ("2", 1, "old"), ("3", 0, "new"), ("None", 0, "new")]
