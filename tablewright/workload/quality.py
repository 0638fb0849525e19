"""Profiles and rule checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import map_total
from tablewright.operators.quality import (
    duplicate_rows,
    key_violations,
    null_profile,
    null_total,
    profile,
    row_counts,
)
from tablewright.operators.rollup import Rollup, mean, rollup, row_count
from tablewright.sinks.contracts import Contract, Field, apply_contract, contract_violations
from tablewright.sources.csv import PANDAS_TOKENS, read_csv_text, typed
from tablewright.sources.manifest import file_manifest
from tablewright.session import workspace
from tablewright.workload.tables import LABELLED, Query, half_up, labelled_documents, table

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def row_counts_all(spark: SparkSession, folder: str) -> DataFrame:
    return row_counts({name: table(spark, folder, name) for name in TABLES})


def null_profile_documents(spark: SparkSession, folder: str) -> DataFrame:
    return null_profile(labelled_documents(spark, folder))


def null_total_documents(spark: SparkSession, folder: str) -> DataFrame:
    return null_total(labelled_documents(spark, folder))


def duplicate_count(spark: SparkSession, folder: str) -> DataFrame:
    rows = labelled_documents(spark, folder)
    return duplicate_rows(rows.select("text", "lang", "n_chars", "quality"))


def profile_by_source(spark: SparkSession, folder: str) -> DataFrame:
    rows = labelled_documents(spark, folder).select(
        "source", "text", "lang", "n_chars", "quality", "toxic"
    )
    measured = profile(rows, ["source"])
    return measured.select(
        "source", "rows", F.size("columns").cast("long").alias("n_columns"),
        F.col("nulls")["quality"].alias("null_quality"), map_total("nulls").alias("null_total"),
        "duplicates",
    )


def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Part names, which repeat; one of them is made null."""
    parts = table(spark, folder, "part")
    name = F.when(F.col("p_name") != "small ring", F.col("p_name"))
    return key_violations(parts.select(name.alias("p_name")), "p_name")


_CONTRACT = Contract("supplier_stats", "supplier", (
    Field("supplier", T.StringType(), 100),
    Field("total_lines", T.IntegerType()),
    Field("avg_quantity", T.DecimalType(6, 2)),
    Field("avg_price", T.DecimalType(12, 2)),
))


def _supplier_stats(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    stats = rollup(lines, Rollup("by_supplier", "l_suppkey", (
        row_count("total_lines"), mean("avg_quantity", "l_quantity"),
        mean("avg_price", "l_extendedprice"),
    )))
    return stats.withColumn("supplier", F.concat(F.lit("Supplier "), F.col("l_suppkey").cast("string")))


def mart_contract(spark: SparkSession, folder: str) -> DataFrame:
    return apply_contract(_supplier_stats(spark, folder), _CONTRACT)


def precision_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines against a contract that many of them break."""
    narrow = Contract("lines", "l_orderkey", (
        Field("l_extendedprice", T.DecimalType(6, 2)),
        Field("l_quantity", T.DecimalType(6, 2)),
        Field("ship_text", T.StringType(), 8),
    ))
    lines = table(spark, folder, "lineitem")
    text = F.concat(F.lit("line "), F.col("l_quantity").cast("string"))
    return contract_violations(lines.withColumn("ship_text", text), narrow)


def manifest_of_tables(spark: SparkSession, folder: str) -> DataFrame:
    return file_manifest(spark, folder, "*.parquet").select("file", "bytes", "size_mb", "md5")


def profile_log(spark: SparkSession, folder: str) -> DataFrame:
    """Customers and suppliers as CSV files with gaps, profiled per kind."""
    path = workspace(spark)
    schema = T.StructType([
        T.StructField("name", T.StringType()), T.StructField("nation", T.IntegerType()),
        T.StructField("balance", T.DoubleType()),
    ])
    for prefix, name in (("c", "customer"), ("s", "supplier")):
        rows = table(spark, folder, name).select(
            F.when(F.col(f"{prefix}_nationkey") == 3, F.lit("NA"))
            .otherwise(F.concat(F.lit("n"), F.col(f"{prefix}_nationkey").cast("string"))).alias("name"),
            F.when(F.col(f"{prefix}_nationkey") != 5, F.col(f"{prefix}_nationkey")).alias("nation"),
            F.round(f"{prefix}_acctbal", -3).alias("balance"),
        )
        rows.write.option("header", True).csv(f"{path}/{name}")
    text = read_csv_text(spark, [f"{path}/customer", f"{path}/supplier"], schema.fieldNames())
    kind = F.element_at(F.split("source_path", "/"), -2)
    rows = typed(text, schema, PANDAS_TOKENS).select(kind.alias("kind"), *schema.fieldNames())
    measured = profile(rows, ["kind"])
    return measured.select(
        "kind", "rows", F.concat_ws(",", "columns").alias("columns"),
        F.col("nulls")["name"].alias("null_name"), F.col("nulls")["nation"].alias("null_nation"),
        map_total("nulls").alias("null_total"), "duplicates",
    )


def _kind_sql(kind: str, prefix: str) -> str:
    return f"""
            SELECT '{kind}' AS kind, nullif({prefix}_nationkey, 3) AS name,
                nullif({prefix}_nationkey, 5) AS nation,
                CAST(round(CAST({prefix}_acctbal AS DECIMAL(18,2)), -3) AS DOUBLE) AS balance
            FROM {kind}"""


QUERIES = {
    "row_counts": Query(row_counts_all, " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS \"rows\" FROM {t}" for t in TABLES)),
    "null_profile": Query(null_profile_documents, f"WITH {LABELLED} " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls FROM labelled"
        for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"))),
    "null_total": Query(null_total_documents, f"""
        WITH {LABELLED}
        SELECT count(*) FILTER (quality IS NULL) + count(*) FILTER (toxic IS NULL) AS null_total
        FROM labelled"""),
    "duplicate_count": Query(duplicate_count, f"""
        WITH {LABELLED}, distinct_rows AS (
            SELECT DISTINCT text, lang, n_chars, quality FROM labelled
        )
        SELECT (SELECT count(*) FROM labelled) AS "rows",
            (SELECT count(*) FROM labelled) - (SELECT count(*) FROM distinct_rows) AS duplicates
        """),
    "profile_by_source": Query(profile_by_source, f"""
        WITH {LABELLED}, distinct_rows AS (
            SELECT source, text, lang, n_chars, quality, toxic, count(*) AS copies
            FROM labelled GROUP BY ALL
        )
        SELECT source, CAST(sum(copies) AS BIGINT) AS "rows", CAST(5 AS BIGINT) AS n_columns,
            CAST(sum(CASE WHEN quality IS NULL THEN copies ELSE 0 END) AS BIGINT) AS null_quality,
            CAST(sum(CASE WHEN quality IS NULL THEN copies ELSE 0 END)
                + sum(CASE WHEN toxic IS NULL THEN copies ELSE 0 END) AS BIGINT) AS null_total,
            CAST(sum(copies - 1) AS BIGINT) AS duplicates
        FROM distinct_rows GROUP BY source"""),
    "key_violations": Query(duplicate_keys, """
        SELECT nullif(p_name, 'small ring') AS p_name, count(*) AS copies
        FROM part GROUP BY 1 HAVING count(*) > 1 OR nullif(p_name, 'small ring') IS NULL"""),
    "mart_contract": Query(mart_contract, f"""
        SELECT 'Supplier ' || l_suppkey AS supplier, CAST(count(*) AS INTEGER) AS total_lines,
            CAST({half_up('avg(l_quantity)')} AS DECIMAL(6,2)) AS avg_quantity,
            CAST({half_up('avg(l_extendedprice)')} AS DECIMAL(12,2)) AS avg_price
        FROM lineitem GROUP BY l_suppkey"""),
    "precision_violations": Query(precision_violations, """
        SELECT 'l_extendedprice' AS "column", count(*) FILTER (l_extendedprice >= 9999.995) AS violations
        FROM lineitem
        UNION ALL SELECT 'l_quantity', count(*) FILTER (l_quantity >= 9999.995) FROM lineitem
        UNION ALL SELECT 'ship_text', count(*) FILTER (l_quantity >= 10) FROM lineitem"""),
    "file_manifest": Query(manifest_of_tables, None),
    "profile_log": Query(profile_log, f"""
        WITH all_rows AS ({_kind_sql('customer', 'c')} UNION ALL {_kind_sql('supplier', 's')}),
        distinct_rows AS (
            SELECT kind, name, nation, balance, count(*) AS copies FROM all_rows GROUP BY ALL
        )
        SELECT kind, CAST(sum(copies) AS BIGINT) AS "rows", 'name,nation,balance' AS columns,
            CAST(sum(CASE WHEN name IS NULL THEN copies ELSE 0 END) AS BIGINT) AS null_name,
            CAST(sum(CASE WHEN nation IS NULL THEN copies ELSE 0 END) AS BIGINT) AS null_nation,
            CAST(sum(CASE WHEN name IS NULL THEN copies ELSE 0 END)
                + sum(CASE WHEN nation IS NULL THEN copies ELSE 0 END) AS BIGINT) AS null_total,
            CAST(sum(copies - 1) AS BIGINT) AS duplicates
        FROM distinct_rows GROUP BY kind"""),
}
