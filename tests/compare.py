"""Compare registered queries with their SQL in DuckDB, exactly."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(folder: str):
    import duckdb

    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def norm(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (int, Decimal)):
        return float(value) if abs(value) < 2**53 else int(value)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    return value


def kind(value) -> str:
    for name, types in (("bool", bool), ("num", (int, float, Decimal)), ("ts", datetime), ("date", date), ("str", str)):
        if isinstance(value, types):
            return name
    return "null"


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((kind(r[i]), norm(r[i])) for i in order) for r in rows)


def differences(spark_df, db, sql: str) -> list[str]:
    """Empty when column names and the multiset of rows agree."""
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    actual = spark_df.collect()
    problems = []
    if sorted(names) != sorted(spark_df.columns):
        problems.append(f"columns {sorted(set(names) ^ set(spark_df.columns))}")
        return problems
    left, right = bag(spark_df.columns, actual), bag(names, expected)
    if left != right:
        only_spark, only_sql = list((left - right).items())[:2], list((right - left).items())[:2]
        problems.append(f"rows {len(actual)} / {len(expected)}; spark {only_spark}; sql {only_sql}")
    return problems
