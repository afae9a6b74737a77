"""Compare a registered query with its SQL twin: columns, types and every value."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
    "double": "DOUBLE",
}


def open_duckdb(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir, f"{table}.parquet")
        files = path / "*.parquet" if path.is_dir() else path
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{files}')")
    return connection


def difference(df, connection, sql) -> tuple[int, str | None]:
    """Spark row count, and what differs from the SQL result (None when nothing does)."""
    rows, columns = df.collect(), df.columns
    cursor = connection.execute(sql)
    names = [item[0] for item in cursor.description]
    if sorted(names) != sorted(columns):
        return len(rows), f"columns {sorted(columns)} != {sorted(names)}"
    types = {item[0]: str(item[1]) for item in cursor.description}
    odd = [(n, t, types[n]) for n, t in df.dtypes if TYPES.get(t) != types[n]]
    if odd:
        return len(rows), f"types {odd}"
    order = [names.index(name) for name in columns]
    expected = Counter(tuple(row[i] for i in order) for row in cursor.fetchall())
    actual = Counter(tuple(row) for row in rows)
    if actual == expected:
        return len(rows), None
    missing, extra = list((expected - actual).items())[:2], list((actual - expected).items())[:2]
    return len(rows), (
        f"rows {actual.total()} != {expected.total()} or values differ: "
        f"missing {str(missing)[:1500]} extra {str(extra)[:1500]}"
    )
