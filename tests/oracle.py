"""Compares a query with its SQL, value by value."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def cell(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, float):
        return str(int(value)) if math.isfinite(value) and value == int(value) else repr(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


KINDS = {"bigint": "integer", "int": "integer", "double": "double", "string": "varchar", "boolean": "boolean"}


def kinds(connection, df, sql: str) -> tuple[dict, dict]:
    """Column kinds here and in SQL; integers of any width are one kind."""
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    want = {r[0]: "integer" if str(r[1]) in ("BIGINT", "INTEGER") else str(r[1]).lower() for r in described}
    return {name: KINDS.get(kind, kind) for name, kind in df.dtypes}, want


def difference(connection, df, sql: str) -> str | None:
    """None if both give the same rows, else what differs."""
    here, there = kinds(connection, df, sql)
    if here != there:
        return f"column kinds {here}, expected {there}"
    want = connection.execute(sql)
    names, expected = rows_of([c[0] for c in want.description], want.fetchall())
    got_names, got = rows_of(df.columns, df.collect())
    if names != got_names:
        return f"columns {got_names}, expected {names}"
    if got == expected:
        return None
    only, lost = sorted(set(got) - set(expected))[:3], sorted(set(expected) - set(got))[:3]
    return f"{len(got)} rows, expected {len(expected)}; only here {only}; missing {lost}"
