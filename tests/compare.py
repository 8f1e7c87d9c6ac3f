"""Run a registered query in Spark and its SQL in DuckDB, compare all values."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark, sf_dir: str, name: str, fn, sql: str, db) -> str | None:
    """None when equal, else a short description."""
    df = fn(spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    cursor = db.execute(sql)
    theirs_columns = [d[0] for d in cursor.description]
    theirs = rows_of(theirs_columns, cursor.fetchall())
    if sorted(df.columns) != sorted(theirs_columns):
        return f"columns {sorted(df.columns)} vs {sorted(theirs_columns)}"
    if ours == theirs:
        return None
    left, right = set(ours) - set(theirs), set(theirs) - set(ours)
    return f"rows {len(ours)} vs {len(theirs)}; {len(left)}/{len(right)} differ: {list(left)[:2]} vs {list(right)[:2]}"
