"""Spark's rows against DuckDB's, whatever their order."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canon(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(float(value))
    if isinstance(value, (list, tuple)):
        return str([canon(v) for v in value])
    return str(value)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        con.execute(f"create view {name} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def same(df, con, sql: str) -> None:
    rows = con.sql(sql)
    wanted = [dict(zip(rows.columns, r, strict=True)) for r in rows.fetchall()]
    columns = sorted(df.columns)
    assert columns == sorted(rows.columns)
    ours = sorted(tuple(canon(v if not hasattr(v, "tolist") else v.tolist()) for v in row) for row in df.select(*columns).toLocalIterator())
    theirs = sorted(tuple(canon(r[c]) for c in columns) for r in wanted)
    assert ours == theirs
