"""CSV reader with an explicit schema and null tokens."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import null_tokens_to_null, parse_boolean
from tablewright.sources.records import has_line_breaks, read_records

EMPTY_ONLY: tuple[str, ...] = ("",)

# The text that pandas reads as missing by default.
PANDAS_TOKENS: tuple[str, ...] = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Header row and inferred types. Inference costs a pass of its own."""
    return spark.read.csv(path, header=True, inferSchema=True)


def _decoded(c: str) -> Column:
    """Plain file name; the reader's metadata is URL-encoded but leaves plus signs alone."""
    return F.url_decode(F.replace(F.col(c), F.lit("+"), F.lit("%2B")))


def read_csv_text(spark: SparkSession, path: str | list[str], names: Sequence[str],
                  glob: str = "*.csv", multi_line: bool | None = False) -> DataFrame:
    """All columns as text plus ``source_file`` and ``source_path``.

    A header that does not match ``names`` is an error. ``multi_line`` allows line breaks in
    quoted values; files are split over tasks all the same. None looks for such values first.
    """
    if multi_line is None:
        multi_line = has_line_breaks(spark, path, glob)
    if multi_line:
        return read_records(spark, path, names, glob).select(
            *names, F.element_at(F.split(_decoded("file"), "/"), -1).alias("source_file"), _decoded("file").alias("source_path")
        )
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("pathGlobFilter", glob)
        .csv(path)
    )
    return df.select(
        "*",
        _decoded("_metadata.file_name").alias("source_file"),
        _decoded("_metadata.file_path").alias("source_path"),
    )


def _typed_column(field: T.StructField, null_tokens: Sequence[str]) -> Column:
    value = null_tokens_to_null(field.name, null_tokens)
    if isinstance(field.dataType, T.BooleanType):
        return parse_boolean(value)
    if isinstance(field.dataType, T.IntegralType):
        # A whole number may be written with decimals, as of a column that had gaps.
        text = F.regexp_replace(F.trim(value), r"^([+-]?[0-9]+)\.0*$", "$1")
        return text.try_cast(field.dataType)
    if not isinstance(field.dataType, T.StringType):
        return F.trim(value).try_cast(field.dataType)
    return value


def typed(df: DataFrame, schema: T.StructType,
          null_tokens: Sequence[str] = EMPTY_ONLY) -> DataFrame:
    """Text columns as the types of ``schema``; text that does not fit becomes null."""
    return df.withColumns({field.name: _typed_column(field, null_tokens) for field in schema.fields})


def _unfit(field: T.StructField, null_tokens: Sequence[str], value: Column) -> Column:
    """True if there is text in the column and ``value``, the same in the column's type, is null."""
    return null_tokens_to_null(field.name, null_tokens).isNotNull() & value.isNull()


def _parsed_fields(schema: T.StructType) -> list[T.StructField]:
    return [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]


def unreadable(schema: T.StructType, null_tokens: Sequence[str] = EMPTY_ONLY) -> Column:
    """Of a row of text columns, an array of the ``(column, text)`` that do not fit their types."""
    none = F.array().cast("array<struct<column: string, text: string>>")
    cells = [
        F.when(
            _unfit(field, null_tokens, _typed_column(field, null_tokens)),
            F.array(F.struct(F.lit(field.name).alias("column"), F.col(field.name).alias("text"))),
        ).otherwise(none)
        for field in _parsed_fields(schema)
    ]
    return F.concat(none, *cells)


def text_profile(landed: DataFrame, schema: T.StructType,
                 null_tokens: Sequence[str] = EMPTY_ONLY) -> DataFrame:
    """Per ``source_file`` the missing values of each column, ``nulls``, and ``unreadable``.

    Missing are the null tokens; text that is there but does not fit its type is unreadable. Only
    columns with such text are in the second map.
    """
    names = schema.fieldNames()
    both = typed(
        landed.select("source_file", *names, *[null_tokens_to_null(c, null_tokens).alias(f"__{c}") for c in names]),
        schema, null_tokens,
    )
    counted = both.groupBy("source_file").agg(
        *[F.count_if(F.col(f"__{c}").isNull()).alias(f"__null_{i}") for i, c in enumerate(names)],
        *[F.count_if(F.col(f"__{c}").isNotNull() & F.col(c).isNull()).alias(f"__bad_{i}") for i, c in enumerate(names)],
    )
    nulls = F.create_map(*[x for i, c in enumerate(names) for x in (F.lit(c), F.col(f"__null_{i}"))])
    bad = F.create_map(*[x for i, c in enumerate(names) for x in (F.lit(c), F.col(f"__bad_{i}"))])
    return counted.select(
        "source_file", nulls.alias("nulls"), F.map_filter(bad, lambda _, n: n > 0).alias("unreadable")
    )


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType,
             null_tokens: Sequence[str] = EMPTY_ONLY, multi_line: bool | None = False,
             glob: str = "*.csv") -> DataFrame:
    """Typed CSV scan, exactly the columns of ``schema``."""
    text = read_csv_text(spark, path, schema.fieldNames(), glob, multi_line)
    return typed(text, schema, null_tokens).select(*schema.fieldNames())


class UnreadableError(ValueError):
    """Values of a source do not fit their types."""


class Quarantine:
    """Typed rows of a CSV source, and an account of those with values that do not fit.

    ``rows`` has the columns of ``schema``. The action that writes them also counts the rows with
    unreadable values, so a clean source is read once; :meth:`settle` is called after it. Every
    value is parsed once there; which of a row's values do not fit is asked only after it.
    ``on_unreadable``: ``fail`` and ``quarantine`` leave such rows out of ``rows``, ``null`` keeps
    them with nulls.
    """

    def __init__(self, text: DataFrame, schema: T.StructType,
                 null_tokens: Sequence[str] = EMPTY_ONLY, on_unreadable: str = "fail") -> None:
        if on_unreadable not in ("fail", "quarantine", "null"):
            raise ValueError(f"on_unreadable: {on_unreadable}")
        self.on_unreadable, self.seen = on_unreadable, Observation()
        self.text, self.schema, self.null_tokens = text, schema, null_tokens
        self.names = schema.fieldNames()
        place = {f.name: f"__typed_{i}" for i, f in enumerate(schema.fields)}
        values = text.withColumns({place[f.name]: _typed_column(f, null_tokens) for f in schema.fields})
        unfit = [_unfit(f, null_tokens, F.col(place[f.name])) for f in _parsed_fields(schema)]
        marked = values.withColumn("__rejected", reduce(or_, unfit, F.lit(False)))
        watched = marked.observe(self.seen, F.count_if("__rejected").alias("rejected"))
        if on_unreadable != "null":
            watched = watched.where(~F.col("__rejected"))
        self.rows = watched.select(*[F.col(place[n]).alias(n) for n in self.names])

    def rejected(self) -> DataFrame:
        """One row per unreadable value: ``source_file, source_path, column, text`` and the ``row`` as JSON."""
        row = F.to_json(F.struct(*self.names), {"ignoreNullFields": "false"})
        cells = self.text.withColumn("__cells", unreadable(self.schema, self.null_tokens))
        return cells.where(F.size("__cells") > 0).select(
            "source_file", "source_path", F.explode("__cells").alias("cell"), row.alias("row")
        ).select("source_file", "source_path", "cell.column", "cell.text", "row")

    def settle(self, path: str) -> DataFrame:
        """Write the rejected values to ``path``, replacing earlier ones, and return them.

        An error with ``fail``, after they are written. The source is read again only if the first
        action met such values.
        """
        rejected = self.rejected()
        if not self.seen.get["rejected"]:
            rejected = rejected.sparkSession.createDataFrame([], rejected.schema)
        rejected.write.mode("overwrite").parquet(path)
        written = rejected.sparkSession.read.schema(rejected.schema).parquet(path)
        if self.seen.get["rejected"] and self.on_unreadable == "fail":
            counts = {r["column"]: r["count"] for r in written.groupBy("column").count().collect()}
            raise UnreadableError(f"unreadable values by column: {counts}; see {path}")
        return written
