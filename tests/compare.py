"""Run a query in Spark and its SQL in DuckDB and compare them as sorted rows."""

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def sql_rows(sql, directory):
    for table in TABLES:
        duckdb.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM '{directory}/{table}.parquet'")
    relation = duckdb.sql(sql)
    return relation.columns, relation.fetchall()


def spark_rows(frame):
    return frame.columns, [tuple(row) for row in frame.collect()]


def in_order(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def difference(frame, sql, directory):
    """None when equal, else a short description."""
    columns, ours = in_order(*spark_rows(frame))
    sql_columns, theirs = in_order(*sql_rows(sql, directory))
    if columns != sql_columns:
        return f"columns {columns} vs {sql_columns}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows vs {len(theirs)}"
    for mine, other in zip(ours, theirs, strict=True):
        if mine != other or [type(v) for v in mine] != [type(v) for v in other]:
            return f"{mine} vs {other}"
    return None if ours else "no rows"


SMALL = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
