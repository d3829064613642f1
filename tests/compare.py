"""Result comparison: same columns, same types in kind, same rows in any order."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame


def _plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def _rows(columns: dict[str, list]) -> Counter:
    names = sorted(columns)
    return Counter(tuple(_plain(value) for value in row) for row in zip(*[columns[name] for name in names]))


def _read(table: pa.Table) -> tuple[list[str], Counter]:
    types = sorted(f"{field.name} {str(field.type).removeprefix('large_')}" for field in table.schema)
    return types, _rows(table.to_pydict())


def spark_rows(df: DataFrame) -> tuple[list[str], Counter]:
    return _read(df.toArrow())


def duck_rows(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    return _read(connection.sql(sql).to_arrow_table())


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        connection.sql(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def difference(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None."""
    spark_columns, actual = spark_rows(df)
    duck_columns, expected = duck_rows(connection, sql)
    if spark_columns != duck_columns:
        return f"columns {spark_columns} != {duck_columns}"
    if actual != expected:
        missing, extra = expected - actual, actual - expected
        return (
            f"{sum(actual.values())} rows against {sum(expected.values())}; "
            f"missing {list(missing.items())[:3]}; extra {list(extra.items())[:3]}"
        )
    return None
