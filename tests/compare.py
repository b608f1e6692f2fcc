"""Compare a named query with its SQL: columns, kinds of types, row multiset."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


# How DuckDB names Spark's types.
_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (datetime.datetime, decimal.Decimal)):
        return str(value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple((type(row[i]).__name__, _plain(row[i])) for i in order) for row in rows]
    return sorted(shaped, key=repr)


def result_types(connection, sql: str):
    return connection.execute(f"SELECT column_name, column_type FROM (DESCRIBE {sql})").fetchall()


def differences(spark_frame, connection, sql: str) -> list[str]:
    """Empty if both give the same; else what differs, with samples."""
    result = connection.execute(sql)
    sql_columns = [d[0] for d in result.description]
    expected = _rows(sql_columns, result.fetchall())
    actual = _rows(spark_frame.columns, [tuple(r) for r in spark_frame.collect()])
    found = []
    sql_types = {d[0]: str(d[1]) for d in result_types(connection, sql)}
    for name, kind in spark_frame.dtypes:
        if _TYPES.get(kind, kind.upper()) != sql_types.get(name):
            found.append(f"type of {name}: {kind} != {sql_types.get(name)}")
    if sorted(spark_frame.columns) != sorted(sql_columns):
        found.append(f"columns {sorted(spark_frame.columns)} != {sorted(sql_columns)}")
    if len(actual) != len(expected):
        found.append(f"rows {len(actual)} != {len(expected)}")
    if actual != expected:
        extra, missing = set(actual) - set(expected), set(expected) - set(actual)
        found.append(f"only Spark: {sorted(extra, key=repr)[:2]}; only SQL: {sorted(missing, key=repr)[:2]}")
    return found
