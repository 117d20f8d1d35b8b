"""Run a registered query and its SQL form and compare the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def ordered(columns, rows):
    place = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in place) for r in rows), key=repr)


def spark_rows(df):
    return sorted(df.columns), ordered(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), ordered(columns, cursor.fetchall())


def difference(df, con, sql) -> str | None:
    """None when columns and all rows are equal, else the first difference."""
    left_columns, left = spark_rows(df)
    right_columns, right = sql_rows(con, sql)
    if left_columns != right_columns:
        return f"columns {left_columns} against {right_columns}"
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    for a, b in zip(left, right):
        if a != b or [type(v) for v in a] != [type(v) for v in b]:
            return f"{a} against {b}"
    return None
