"""Order-insensitive comparison of a Spark result with DuckDB's."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{directory}/{name}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _key(row):
    return tuple((x is not None, str(type(x).__name__ in ("int", "float")), _text(x)) for x in row)


def _text(x):
    if isinstance(x, (int, float)) and not isinstance(x, bool):
        return f"{x:.4f}"
    return str(x)


def rows_spark(df):
    cols = sorted(df.columns)
    return cols, sorted(([_norm(v) for v in r] for r in df.select(*[f"`{c}`" for c in cols]).collect()), key=_key)


def rows_duck(con, sql):
    rel = con.sql(sql)
    cols = sorted(rel.columns)
    order = [rel.columns.index(c) for c in cols]
    return cols, sorted(([_norm(r[i]) for i in order] for r in rel.fetchall()), key=_key)


def difference(df, con, sql) -> str | None:
    """None when equal, else a short account of the first difference."""
    c1, a = rows_spark(df)
    c2, b = rows_duck(con, sql)
    if c1 != c2:
        return f"columns {c1} != {c2}"
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    for x, y in zip(a, b):
        for name, u, v in zip(c1, x, y):
            same = u == v or (
                isinstance(u, (int, float)) and isinstance(v, (int, float)) and math.isclose(u, v, rel_tol=0, abs_tol=1e-9)
            )
            if not same:
                return f"{name}: {u!r} != {v!r}\n  spark {dict(zip(c1, x))}\n  duck  {dict(zip(c1, y))}"
    return None
