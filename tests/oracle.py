"""Run a query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

import glob
import os
from decimal import Decimal

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is not None, str(v)) for v in row)


def rows_of(columns: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    """Columns by name and rows in a fixed order; values stay exact."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(r[i] for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=_key)


_FAMILY = {
    "bigint": "integer", "int": "integer", "integer": "integer", "smallint": "integer",
    "double": "double", "string": "text", "varchar": "text", "boolean": "boolean",
}


def family(name: str) -> str:
    name = name.lower()
    return name if name.startswith("decimal") else _FAMILY.get(name, name)


def compare(spark_df, con, sql: str) -> str | None:
    """None if both give the same, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: family(str(d[1])) for d in result.description}
    expected = rows_of(names, result.fetchall())
    actual = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if expected[0] != actual[0]:
        return f"columns {actual[0]} instead of {expected[0]}"
    spark_types = {n: family(t) for n, t in spark_df.dtypes}
    if spark_types != types:
        return f"types {spark_types} instead of {types}"
    if len(expected[1]) != len(actual[1]):
        return f"{len(actual[1])} rows instead of {len(expected[1])}"
    for a, e in zip(actual[1], expected[1]):
        if any(_differ(x, y) for x, y in zip(a, e)):
            return f"{a} instead of {e}"
    return None


def _differ(a, b) -> bool:
    if isinstance(a, (Decimal, float)) and isinstance(b, (Decimal, float)):
        return a != b and not (a != a and b != b)
    return a != b
