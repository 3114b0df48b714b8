"""Compare a Spark result with the result of its SQL, columns by name, rows in any order."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def differences(spark_df, connection, sql: str) -> str:
    """'' when both agree."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} <> {sorted(names)}"
    ordered = sorted(names)
    positions = [names.index(n) for n in ordered]
    want = Counter(tuple(plain(row[i]) for i in positions) for row in expected)
    got = Counter(tuple(plain(v) for v in row) for row in spark_df.select(*[f"`{n}`" for n in ordered]).collect())
    if want == got:
        return ""
    return (
        f"{sum(got.values())} rows <> {sum(want.values())} rows\n{ordered}\n"
        f"only spark: {list((got - want).items())[:3]}\nonly sql: {list((want - got).items())[:3]}"
    )
