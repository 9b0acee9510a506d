"""Order-free comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value: object) -> object:
    """One spelling per value; doubles must agree to the last digits that matter."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(names: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def _kind(type_name: str) -> str:
    name = type_name.lower()
    if name in ("bigint", "long", "hugeint", "integer", "int"):
        return name if name == "hugeint" else {"long": "bigint", "integer": "int"}.get(name, name)
    return {"varchar": "string", "timestamp_ntz": "timestamp", "timestamp with time zone": "timestamp"}.get(name, name)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, list[str]]:
    """Number of Spark rows and what differs from the SQL result."""
    spark_rows = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    other_rows = cursor.fetchall()
    found = []
    if sorted(df.columns) != sorted(names):
        found.append(f"columns differ: {sorted(set(df.columns) ^ set(names))}")
        return len(spark_rows), found
    types = {r[0]: _kind(r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    for name, kind in df.dtypes:
        if _kind(kind) != types[name]:
            found.append(f"type of {name}: {kind} against {types[name]}")
    left, right = _rows(df.columns, spark_rows), _rows(names, other_rows)
    if left != right:
        found.append(f"rows: {len(spark_rows)} against {len(other_rows)}")
        found += [f"only here: {r}" for r in list((left - right).elements())[:3]]
        found += [f"only there: {r}" for r in list((right - left).elements())[:3]]
    return len(spark_rows), found
