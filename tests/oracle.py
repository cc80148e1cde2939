"""Compares a query with its SQL twin in DuckDB: columns, types by kind, and all rows."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


SPARK_TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
}


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return int(value)


def rows_of_spark(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(v) for v in r) for r in df.select(*names).collect())


def rows_of_duckdb(con, sql: str) -> tuple[list[str], Counter]:
    rel = con.sql(sql)
    order = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    rows = rel.fetchall()
    return [rel.columns[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None if both agree, else what differs."""
    rel = con.sql(sql)
    ours_types = {c: SPARK_TYPES.get(t, t) for c, t in df.dtypes}
    theirs_types = dict(zip(rel.columns, map(str, rel.types)))
    if ours_types != theirs_types:
        return f"types {ours_types} != {theirs_types}"
    names, ours = rows_of_spark(df)
    theirs_names, theirs = rows_of_duckdb(con, sql)
    if names != theirs_names:
        return f"columns {names} != {theirs_names}"
    if ours != theirs:
        return (
            f"{sum(ours.values())} rows != {sum(theirs.values())} rows; "
            f"only in Spark {list((ours - theirs).items())[:3]}; only in SQL {list((theirs - ours).items())[:3]}"
        )
    return None
