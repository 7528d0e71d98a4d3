"""Run a registered query and its oracle on the same tables and compare them as multisets."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}")
    return v


def _types(rows):
    """Python type of each column's values, bool, int, float and str told apart."""
    kinds = {}
    for row in rows:
        for name, v in row:
            if v is not None:
                kinds.setdefault(name, set()).add(type(v).__name__)
    return kinds


def rows_of_spark(df):
    names = sorted(df.columns)
    return names, [tuple((n, _value(r[n])) for n in names) for r in df.collect()]


def rows_of_sql(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(names)
    rows = []
    for r in cursor.fetchall():
        named = dict(zip(names, r, strict=True))
        rows.append(tuple((n, _value(named[n])) for n in order))
    return order, rows


def differences(df, con, sql) -> str | None:
    """None when both sides agree in column names, value types, row count and values."""
    spark_names, spark_rows = rows_of_spark(df)
    sql_names, sql_rows = rows_of_sql(con, sql)
    if spark_names != sql_names:
        return f"columns {spark_names} != {sql_names}"
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} != {len(sql_rows)}"
    if _types(spark_rows) != _types(sql_rows):
        return f"types {_types(spark_rows)} != {_types(sql_rows)}"
    left, right = Counter(spark_rows), Counter(sql_rows)
    if left != right:
        extra, missing = list((left - right).items())[:2], list((right - left).items())[:2]
        return f"values differ: only Spark {extra}; only SQL {missing}"
    return None
