"""Parquet, catalogue and JDBC tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet folder; a folder that is missing or empty is an error."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Table of the session's catalogue."""
    return spark.table(name)


@dataclass(frozen=True)
class JdbcServer:
    """Where a database is; all values come from the caller."""

    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None

    def options(self) -> dict[str, str]:
        values = {"url": self.url, "user": self.user, "password": self.password, "driver": self.driver}
        return {k: v for k, v in values.items() if v is not None}


@dataclass(frozen=True)
class JdbcRanges:
    """Parallel read: ``partitions`` ranges of a numeric column."""

    column: str
    lower: int
    upper: int
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


def jdbc_read_options(server: JdbcServer, table: str, ranges: JdbcRanges | None = None,
                      fetch_size: int = 100_000) -> dict[str, str]:
    """Reader options; rows arrive in blocks of ``fetch_size``, never as a whole."""
    options = {**server.options(), "dbtable": table, "fetchsize": str(fetch_size)}
    return {**options, **ranges.options()} if ranges else options


def read_jdbc(spark: SparkSession, server: JdbcServer, table: str,
              columns: Sequence[str] | None = None, ranges: JdbcRanges | None = None,
              fetch_size: int = 100_000) -> DataFrame:
    """Database table. Projections and filters on the result run in the database."""
    options = jdbc_read_options(server, table, ranges, fetch_size)
    df = spark.read.format("jdbc").options(**options).load()
    return df.select(*columns) if columns else df
