"""Compares every query that has SQL with DuckDB over the same files."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb


def views(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.sql("SET TimeZone = 'UTC'")
    for f in sorted(os.listdir(folder)):
        if f.endswith(".parquet"):
            path = f"{folder}/{f}" + ("/*.parquet" if os.path.isdir(f"{folder}/{f}") else "")
            db.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{path}'")
    return db


def plain(x):
    if isinstance(x, bool) or x is None or isinstance(x, str):
        return x
    if isinstance(x, (float, decimal.Decimal)):
        return "nan" if math.isnan(x) else round(float(x), 6)
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    return x


def compare(df, db, sql: str) -> str | None:
    """What differs between a Spark result and a DuckDB result; None if nothing does."""
    names = sorted(df.columns)
    mine = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    rel = db.sql(sql)
    if sorted(rel.columns) != names:
        return f"columns {names} and {sorted(rel.columns)}"
    kinds = {c: str(t) for c, t in zip(rel.columns, rel.types, strict=True)}
    order = [rel.columns.index(c) for c in names]
    other = sorted((tuple(plain(r[i]) for i in order) for r in rel.fetchall()), key=repr)
    if len(mine) != len(other):
        return f"{len(mine)} rows and {len(other)}"
    for a, b in zip(mine, other, strict=True):
        if a != b:
            return f"row {a!r} and {b!r}"[:1500] + f" {kinds}"
    families = {"bigint": "int", "int": "int", "smallint": "int", "double": "float", "float": "float", "string": "str", "boolean": "bool"}
    duck = {"BIGINT": "int", "INTEGER": "int", "HUGEINT": "int", "DOUBLE": "float", "FLOAT": "float", "VARCHAR": "str", "BOOLEAN": "bool"}
    for c, t in df.dtypes:
        x, y = families.get(t), duck.get(kinds[c])
        if x and y and x != y:
            return f"type of {c}: {t} and {kinds[c]}"
    return None
