"""Run a named query and its checking SQL side by side and compare all rows."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return round(value, 6) + 0.0
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    if hasattr(value, "as_tuple"):  # Decimal
        return round(float(value), 6)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    out = [tuple(float(v) if isinstance(v, int) and not isinstance(v, bool) else v for v in r)
           for r in out]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(spark_frame, connection, sql):
    """None if equal, else a short description."""
    names = spark_frame.columns
    ours = rows_of(names, [tuple(r) for r in spark_frame.collect()])
    cursor = connection.execute(sql)
    other_names = [d[0] for d in cursor.description]
    other = rows_of(other_names, cursor.fetchall())
    if sorted(names) != sorted(other_names):
        return f"columns {sorted(names)} != {sorted(other_names)}"
    if len(ours) != len(other):
        return f"rows {len(ours)} != {len(other)}; ours {ours[:2]} other {other[:2]}"
    for a, b in zip(ours, other):
        if a != b:
            bad = sum(x != y for x, y in zip(ours, other))
            return f"{bad} of {len(ours)} rows differ; columns {sorted(names)}: {a} != {b}"
    return None
