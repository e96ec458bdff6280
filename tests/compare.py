"""Run registered queries against their SQL in DuckDB and report differences."""

from __future__ import annotations

import glob
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else float(repr(value))
    if value is None or isinstance(value, (bool, int, str)):
        return value
    return value


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both results have the same columns and the same multiset of rows."""
    names = sorted(spark_df.columns)
    result = con.execute(sql)
    sql_names = [d[0] for d in result.description]
    if sorted(sql_names) != names:
        return f"columns {names} against {sorted(sql_names)}"
    order = [sql_names.index(n) for n in names]
    expected = sorted((tuple(_plain(r[i]) for i in order) for r in result.fetchall()), key=repr)
    rows = spark_df.select(*[f"`{n}`" for n in names]).collect()
    actual = sorted((tuple(_plain(v) for v in r) for r in rows), key=repr)
    if len(actual) != len(expected):
        return f"{len(actual)} rows against {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e or [type(v) for v in a] != [type(v) for v in e]:
            return f"{a} against {e}"
    return None
