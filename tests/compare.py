"""Spark result against DuckDB result, column by column, in any row order."""

from __future__ import annotations

import collections
import datetime
import glob
import os

import duckdb


TYPES = {"string": "VARCHAR", "int": "INTEGER"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _value(v):
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], collections.Counter(tuple(_value(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str | None:
    """None when the results are equal, else what differs."""
    mine = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    theirs = _rows([d[0] for d in result.description], result.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} against {theirs[0]}"
    if mine[1] != theirs[1]:
        here, there = mine[1] - theirs[1], theirs[1] - mine[1]
        return (f"{mine[0]}: {sum(mine[1].values())} rows against {sum(theirs[1].values())}; "
                f"only here {list(here)[:3]}, only there {list(there)[:3]}")
    kinds = {d[0]: str(d[1]) for d in con.execute(f"DESCRIBE {sql}").fetchall()}
    other = {f.name: (f.dataType.simpleString(), kinds[f.name]) for f in df.schema.fields
             if TYPES.get(f.dataType.simpleString(), f.dataType.simpleString().upper()) != kinds[f.name]}
    return f"types {other}" if other else None
