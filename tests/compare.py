"""Side-by-side comparison of a registered query and its SQL."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return value if value is None else str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(shaped, key=lambda r: tuple((c is None, c or "") for c in r))


def difference(df, db, sql: str) -> str | None:
    """None when both give the same columns and rows, else what differs."""
    left_columns, left = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(sql)
    right_columns, right = _rows([d[0] for d in result.description], result.fetchall())
    if left_columns != right_columns:
        return f"columns {left_columns} != {right_columns}"
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)} rows"
    for ours, theirs in zip(left, right):
        if ours != theirs:
            cells = [
                f"{c}: {a} != {b}" for c, a, b in zip(left_columns, ours, theirs) if a != b
            ]
            wrong = sum(a != b for a, b in zip(left, right))
            return f"{wrong} rows differ, first: {'; '.join(cells)}"
    return None
