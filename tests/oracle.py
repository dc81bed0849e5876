"""Compare a registered query with its SQL on the same test tables."""

from __future__ import annotations

from datetime import datetime

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    return f"{type(value).__name__}:{value}"


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(connection, sql):
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    wide = [d[0] for d in cursor.description if str(d[1]).upper() in ("HUGEINT", "UHUGEINT")]
    assert not wide, f"128-bit columns: {wide}"
    return _rows(names, cursor.fetchall())


def difference(df, connection, sql):
    """None when equal, otherwise a short account of what differs."""
    names, rows = spark_rows(df)
    want_names, want = sql_rows(connection, sql)
    if names != want_names:
        return f"columns {names} instead of {want_names}"
    if rows == want:
        return None
    extra = [r for r in rows if r not in set(want)][:2]
    lacking = [r for r in want if r not in set(rows)][:2]
    return f"{len(rows)} rows instead of {len(want)}; extra {extra}; lacking {lacking}"
