"""Rollups and enrichment with group statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions import band, deviation
from tablewright.operators.enrich import enrich_in_buckets, enrich_with_group_stats
from tablewright.operators.rollup import (
    Rollup,
    count_true,
    mean,
    rollup,
    rollups_in_one_pass,
    row_count,
    stacked_rollup,
    stddev,
)
from tablewright.workload.tables import Query, half_up, table


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with the columns that the rollups need."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linestatus", "l_returnflag", "l_quantity",
        "l_extendedprice", "l_tax", "l_discount",
        (F.col("l_returnflag") == "R").alias("returned"),
        band("l_discount", [(0.07, "high"), (0.04, "medium")], "low").alias("discount_band"),
        band("l_tax", [(0.02, "small"), (0.05, "middle")], "large", at_least=False).alias("tax_tier"),
    )


_LINES = """
    lines AS (
        SELECT l_orderkey, l_partkey, l_suppkey, l_linestatus, l_returnflag, l_quantity,
            l_extendedprice, l_tax, l_discount, l_returnflag = 'R' AS returned,
            CASE WHEN l_discount >= 0.07::DOUBLE THEN 'high'
                WHEN l_discount >= 0.04::DOUBLE THEN 'medium' ELSE 'low' END AS discount_band,
            CASE WHEN l_tax <= 0.02::DOUBLE THEN 'small'
                WHEN l_tax <= 0.05::DOUBLE THEN 'middle' ELSE 'large' END AS tax_tier
        FROM lineitem
    )"""

_METRICS = (
    row_count("total"), mean("avg_quantity", "l_quantity"),
    mean("avg_price", "l_extendedprice"), count_true("returned_lines", "returned"),
)
_METRICS_SQL = f"""count(*) AS total, {half_up('avg(l_quantity)')} AS avg_quantity,
            {half_up('avg(l_extendedprice)')} AS avg_price,
            CAST(sum(CASE WHEN returned THEN 1 ELSE 0 END) AS BIGINT) AS returned_lines"""


def rollup_provider(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    grouped = rollup(_lines(spark, folder), Rollup("by_supplier", "l_suppkey", _METRICS))
    named = grouped.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    return named.select("s_name", *[m.name for m in _METRICS])


def _single(key: str, *metrics):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return rollup(_lines(spark, folder), Rollup(f"by_{key}", key, metrics))

    return run


def _shared_scan(keys: tuple[str, ...]):
    """Rollups by several keys from one aggregate, below each other."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        tables = rollups_in_one_pass(_lines(spark, folder), [Rollup(k, k, _METRICS) for k in keys])
        return reduce(DataFrame.unionByName, [
            grouped.select(
                F.lit(key).alias("rollup"), F.col(key).cast("string").alias("key"),
                *[m.name for m in _METRICS],
            ) for key, grouped in tables.items()
        ])

    return run


_FEW = ("l_suppkey", "l_linestatus", "discount_band", "tax_tier")
# Nearly every line has a combination of its own.
_MANY = ("l_orderkey", "l_partkey", "l_suppkey", "discount_band")


def rollup_stacked(spark: SparkSession, folder: str) -> DataFrame:
    return stacked_rollup(_lines(spark, folder), _FEW, _METRICS)


def _stacked_sql(keys: tuple[str, ...]) -> str:
    return "WITH " + _LINES + " UNION ALL ".join(
        f"""
        SELECT '{key}' AS rollup, CAST({key} AS VARCHAR) AS key, {_METRICS_SQL}
        FROM lines GROUP BY {key}"""
        for key in keys
    )


def _keyed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines whose supplier may be null."""
    supplier = F.when(F.col("l_suppkey") != 7, F.col("l_suppkey"))
    return table(spark, folder, "lineitem").select(
        supplier.alias("supplier"), "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )


_STATS = (
    mean("supplier_avg", "l_quantity"), row_count("supplier_lines"),
    stddev("supplier_stddev", "l_quantity"), mean("supplier_avg_price", "l_extendedprice"),
)


def enrich_group_stats(spark: SparkSession, folder: str) -> DataFrame:
    rows = enrich_with_group_stats(_keyed_lines(spark, folder), "supplier", _STATS)
    return rows.withColumn("vs_supplier_avg", deviation("l_quantity", "supplier_avg"))


_PART_STATS = (mean("part_avg", "l_quantity"), row_count("part_lines"), stddev("part_stddev", "l_quantity"))


def _skewed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines by part; one part holds a third of the rows, some have none."""
    part = F.when(F.col("l_quantity") > 33, F.lit(-1)).when(F.col("l_partkey") != 7, F.col("l_partkey"))
    return table(spark, folder, "lineitem").select(
        part.cast("long").alias("part"), "l_orderkey", "l_linenumber", "l_quantity"
    )


def enrich_in_place(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics and join over one table with buckets by part."""
    joined = enrich_in_buckets(_skewed_lines(spark, folder), "part", _PART_STATS)
    return joined.withColumn("vs_part_avg", deviation("l_quantity", "part_avg"))


def enrich_split_join(spark: SparkSession, folder: str) -> DataFrame:
    """The path for statistics that are too large to broadcast; one key holds a third of the rows."""
    joined = enrich_with_group_stats(_skewed_lines(spark, folder), "part", _PART_STATS, max_broadcast_bytes=0)
    return joined.withColumn("vs_part_avg", deviation("l_quantity", "part_avg"))


_ENRICHED_SQL = f"""
        WITH keyed AS (
            SELECT nullif(l_suppkey, 7) AS supplier, l_orderkey, l_linenumber, l_quantity,
                l_extendedprice
            FROM lineitem
        ), stats AS (
            SELECT supplier, {half_up('avg(l_quantity)')} AS supplier_avg,
                count(*) AS supplier_lines,
                {half_up('stddev_samp(l_quantity)', 4)} AS supplier_stddev,
                {half_up('avg(l_extendedprice)')} AS supplier_avg_price
            FROM keyed GROUP BY supplier
        )
        SELECT k.*, s.supplier_avg, s.supplier_lines, s.supplier_stddev, s.supplier_avg_price,
            {half_up('l_quantity - supplier_avg')} AS vs_supplier_avg
        FROM keyed k LEFT JOIN stats s ON k.supplier = s.supplier"""

_SPLIT_SQL = f"""
        WITH keyed AS (
            SELECT CASE WHEN l_quantity > 33 THEN -1 WHEN l_partkey <> 7 THEN l_partkey END AS part,
                l_orderkey, l_linenumber, l_quantity
            FROM lineitem
        ), stats AS (
            SELECT part, {half_up('avg(l_quantity)')} AS part_avg, count(*) AS part_lines,
                {half_up('stddev_samp(l_quantity)', 4)} AS part_stddev
            FROM keyed GROUP BY part
        )
        SELECT k.*, s.part_avg, s.part_lines, s.part_stddev,
            {half_up('l_quantity - part_avg')} AS vs_part_avg
        FROM keyed k LEFT JOIN stats s ON k.part = s.part"""

QUERIES = {
    "rollup_provider": Query(rollup_provider, f"""
        WITH {_LINES}
        SELECT s_name, {_METRICS_SQL}
        FROM lines JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_name"""),
    "rollup_type": Query(
        _single("l_linestatus", row_count("total"), mean("avg_quantity", "l_quantity"),
                mean("avg_price", "l_extendedprice", 0)), f"""
        WITH {_LINES}
        SELECT l_linestatus, count(*) AS total, {half_up('avg(l_quantity)')} AS avg_quantity,
            {half_up('avg(l_extendedprice)', 0)} AS avg_price
        FROM lines GROUP BY l_linestatus"""),
    "rollup_level": Query(
        _single("l_returnflag", row_count("total"), mean("avg_quantity", "l_quantity"),
                mean("avg_price", "l_extendedprice")), f"""
        WITH {_LINES}
        SELECT l_returnflag, count(*) AS total, {half_up('avg(l_quantity)')} AS avg_quantity,
            {half_up('avg(l_extendedprice)')} AS avg_price
        FROM lines GROUP BY l_returnflag"""),
    "rollup_band": Query(
        _single("discount_band", row_count("total"), mean("avg_price", "l_extendedprice")), f"""
        WITH {_LINES}
        SELECT discount_band, count(*) AS total, {half_up('avg(l_extendedprice)')} AS avg_price
        FROM lines GROUP BY discount_band"""),
    "rollup_tier": Query(
        _single("tax_tier", row_count("total"), mean("avg_quantity", "l_quantity")), f"""
        WITH {_LINES}
        SELECT tax_tier, count(*) AS total, {half_up('avg(l_quantity)')} AS avg_quantity
        FROM lines GROUP BY tax_tier"""),
    "rollups_shared_scan": Query(_shared_scan(_FEW), _stacked_sql(_FEW)),
    "rollups_grouping_sets": Query(_shared_scan(_MANY), _stacked_sql(_MANY)),
    "rollup_stacked": Query(rollup_stacked, _stacked_sql(_FEW)),
    "enrich_group_stats": Query(enrich_group_stats, _ENRICHED_SQL),
    "enrich_split_join": Query(enrich_split_join, _SPLIT_SQL),
    "enrich_in_place": Query(enrich_in_place, _SPLIT_SQL),
}
