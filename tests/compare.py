"""Order-insensitive comparison of a Spark result with its SQL statement."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    # repr keeps 1 and 1.0 apart, so types have to agree as well as values.
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str | None:
    """None when both sides agree, else a short account of how they differ."""
    spark_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    sql_rows = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = _rows(df.columns, spark_rows), _rows(names, sql_rows)
    if a == b:
        return None
    only_a, only_b = set(a) - set(b), set(b) - set(a)
    return f"rows {len(a)} vs {len(b)}; columns {sorted(names)}; spark only {sorted(only_a)[:3]}; sql only {sorted(only_b)[:3]}"
