"""Rows of a Spark query beside those of its SQL on DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os

import duckdb


def plain(x):
    """A value in the form that both engines give: floats to ten digits, times without zone, structs as tuples."""
    if isinstance(x, float):
        return "nan" if math.isnan(x) else float(f"{x:.10g}") + 0.0
    if isinstance(x, decimal.Decimal):
        return plain(float(x))
    if isinstance(x, dict):
        return tuple((k, plain(v)) for k, v in sorted(x.items(), key=lambda kv: str(kv[0])))
    if isinstance(x, (bytes, bytearray)):
        return bytes(x)
    if isinstance(x, dt.datetime):
        return x.replace(tzinfo=None)
    if hasattr(x, "asDict"):
        return plain(x.asDict())
    if isinstance(x, (list, tuple)):
        return [plain(v) for v in x]
    return x


def close(a, b) -> bool:
    if isinstance(a, (list, tuple)) and isinstance(b, (list, tuple)):
        return len(a) == len(b) and all(map(close, a, b))
    if isinstance(a, (int, float)) and isinstance(b, (int, float)) and not (isinstance(a, bool) or isinstance(b, bool)):
        return math.isclose(a, b, rel_tol=1e-8, abs_tol=1e-9)
    return a == b


def duck_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    found = con.execute(sql)
    return [c[0] for c in found.description], found.fetchall()


def ordered(columns: list[str], rows: list) -> list[list]:
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in at] for r in rows), key=lambda r: [str(v) for v in r])


def difference(df, sql: str, sf_dir: str) -> str:
    """What differs, or nothing."""
    columns, rows = duck_rows(sql, sf_dir)
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(columns)}"
    ours, theirs = ordered(df.columns, df.collect()), ordered(columns, rows)
    if len(ours) != len(theirs):
        return f"{len(ours)} and {len(theirs)} rows"
    return next((f"{a} and {b}" for a, b in zip(ours, theirs, strict=True) if not close(a, b)), "")
