"""Compare registered queries with their SQL on the same tables."""

from __future__ import annotations

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(sf_dir, name)}.parquet'")
    return connection


def rows_of(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(df, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a DataFrame and a SQL result: columns, row count, types, values."""
    ours = [tuple(r) for r in df.collect()]
    result = connection.execute(sql)
    theirs_names = [d[0] for d in result.description]
    theirs = result.fetchall()
    if sorted(df.columns) != sorted(theirs_names):
        return [f"columns {sorted(df.columns)} vs {sorted(theirs_names)}"]
    if len(ours) != len(theirs):
        return [f"rows {len(ours)} vs {len(theirs)}"]
    a, b = rows_of(df.columns, ours), rows_of(theirs_names, theirs)
    problems = [f"{x!r:.300} vs {y!r:.300}" for x, y in zip(a, b) if x != y or list(map(type, x)) != list(map(type, y))]
    return [f"{len(problems)} rows differ"] + problems[:3] if problems else []
