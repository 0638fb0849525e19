"""Cleaning, bands, flags, scores, filters and ordered output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions import (
    all_true,
    band,
    case_weight,
    clean_text,
    fill_number,
    fill_text,
    is_not_sentinel,
    round_number,
    weighted_gap,
)
from tablewright.operators.clean import distinct_rows, normalise, require_values
from tablewright.operators.ids import dense_id
from tablewright.operators.ordering import first_rows, ranked, stable_sample, top_k
from tablewright.operators.rollup import Rollup, mean, rollup, row_count
from tablewright.workload.tables import LABELLED, Query, half_up, labelled_documents, table


def normalize_text(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part")
    padded = parts.select(
        "p_partkey", F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("p_name"),
        F.lower("p_type").alias("p_type"), "p_brand",
    )
    return padded.withColumns({c: clean_text(c) for c in ("p_name", "p_type", "p_brand")})


def normalize_documents(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return normalise(documents, text=["lang", "source"], numbers=["n_chars"])


def round_numbers(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return lines.select(
        "l_orderkey", "l_linenumber",
        round_number("l_extendedprice", 1).alias("price_1"),
        round_number("l_extendedprice", 0).alias("price_0"),
        round_number("l_discount", 1).alias("discount_1"),
    )


def fill_nulls(spark: SparkSession, folder: str) -> DataFrame:
    rows = labelled_documents(spark, folder)
    return rows.select(
        "doc_id",
        fill_text("quality", "No Label").alias("quality"),
        fill_number(F.col("toxic").cast("double"), 0.0).alias("toxic"),
    )


def dedup_rows(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("text", "lang", "n_chars")
    return distinct_rows(normalise(documents, text=["lang"])).select(
        F.md5("text").alias("text_md5"), "lang", "n_chars"
    )


def band_descending(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    level = band("l_discount", [(0.08, "high"), (0.04, "medium")], "low")
    return lines.select("l_orderkey", "l_linenumber", "l_discount", level.alias("level"))


def band_ascending(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    tax = F.when(F.col("l_tax") != 0.05, F.col("l_tax"))
    tier = band(tax, [(0.02, "small"), (0.06, "middle")], "large", at_least=False)
    return lines.select("l_orderkey", "l_linenumber", tax.alias("tax"), tier.alias("tier"))


def band_four(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    tier = band("l_quantity", [(40, "mega"), (25, "high"), (10, "mid")], "standard")
    return lines.select("l_orderkey", "l_linenumber", "l_quantity", tier.alias("tier"))


def flag_sentinel(spark: SparkSession, folder: str) -> DataFrame:
    rows = labelled_documents(spark, folder)
    filled = fill_text("quality", "No Label")
    return rows.select("doc_id", is_not_sentinel(filled, "No Label").alias("has_label"))


def flag_all(spark: SparkSession, folder: str) -> DataFrame:
    rows = labelled_documents(spark, folder)
    good, safe = F.col("quality") == 1, F.col("toxic") == 0
    return rows.select("doc_id", all_true(good, safe).alias("usable"))


WEIGHTS = {"1-URGENT": 4, "2-HIGH": 3, "3-MEDIUM": 2}


def weighted_score(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    weight = case_weight("o_orderpriority", WEIGHTS, 1)
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "o_orderpriority",
        weighted_gap(100 * F.col("l_discount"), 100, weight).alias("score"),
    )


def not_null_filter(spark: SparkSession, folder: str) -> DataFrame:
    rows = labelled_documents(spark, folder)
    return require_values(rows, ["quality", "toxic"], ["doc_id", "lang", "quality", "toxic"])


def row_id_dense(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select("c_name", "c_acctbal", "c_custkey")
    return dense_id(customers, ["c_custkey"])


def _supplier_groups(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    price = F.when(F.col("l_suppkey") != 3, F.col("l_extendedprice"))
    return rollup(
        lines.select("l_suppkey", price.alias("price")),
        Rollup("by_supplier", "l_suppkey", (row_count("lines"), mean("avg_price", "price"))),
    )


def top_k_groups(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(_supplier_groups(spark, folder), "lines", 10, "l_suppkey")


def top_k_nulls_first(spark: SparkSession, folder: str) -> DataFrame:
    groups = _supplier_groups(spark, folder)
    return top_k(groups, "avg_price", 5, "l_suppkey", nulls_first=True)


def first_rows_sorted(spark: SparkSession, folder: str) -> DataFrame:
    return first_rows(ranked(_supplier_groups(spark, folder), "lines", "l_suppkey"), 20)


def bounded_sample(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return stable_sample(orders, 1000, ["o_orderkey"], seed=42)


def per_group_sample(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return stable_sample(orders, 300, ["o_orderkey"], seed=42, by="o_orderpriority")


_GROUPS = f"""
    groups AS (
        SELECT l_suppkey, count(*) AS lines,
            {half_up('avg(CASE WHEN l_suppkey <> 3 THEN l_extendedprice END)')} AS avg_price
        FROM lineitem GROUP BY l_suppkey
    )"""

QUERIES = {
    "normalize_text": Query(normalize_text, """
        SELECT p_partkey, trim(upper('  ' || p_name || ' ')) AS p_name,
            trim(upper(lower(p_type))) AS p_type, trim(upper(p_brand)) AS p_brand
        FROM part"""),
    "normalize_documents": Query(normalize_documents, """
        SELECT doc_id, text, trim(upper(lang)) AS lang, trim(upper(source)) AS source,
            round(CAST(n_chars AS DOUBLE), 2) AS n_chars
        FROM documents"""),
    "round_numbers": Query(round_numbers, f"""
        SELECT l_orderkey, l_linenumber, {half_up('l_extendedprice', 1)} AS price_1,
            {half_up('l_extendedprice', 0)} AS price_0, {half_up('l_discount', 1)} AS discount_1
        FROM lineitem"""),
    "fill_nulls": Query(fill_nulls, f"""
        WITH {LABELLED}
        SELECT doc_id, coalesce(CAST(quality AS VARCHAR), 'No Label') AS quality,
            coalesce(CAST(toxic AS DOUBLE), 0.0) AS toxic
        FROM labelled"""),
    "dedup_rows": Query(dedup_rows, """
        WITH distinct_text AS (
            SELECT DISTINCT text, trim(upper(lang)) AS lang, n_chars
            FROM documents
        )
        SELECT md5(text) AS text_md5, lang, n_chars FROM distinct_text"""),
    "band_descending": Query(band_descending, """
        SELECT l_orderkey, l_linenumber, l_discount,
            CASE WHEN l_discount >= 0.08::DOUBLE THEN 'high'
                WHEN l_discount >= 0.04::DOUBLE THEN 'medium' ELSE 'low' END AS level
        FROM lineitem"""),
    "band_ascending": Query(band_ascending, """
        SELECT l_orderkey, l_linenumber, nullif(l_tax, 0.05::DOUBLE) AS tax,
            CASE WHEN nullif(l_tax, 0.05::DOUBLE) <= 0.02::DOUBLE THEN 'small'
                WHEN nullif(l_tax, 0.05::DOUBLE) <= 0.06::DOUBLE THEN 'middle'
                ELSE 'large' END AS tier
        FROM lineitem"""),
    "band_four": Query(band_four, """
        SELECT l_orderkey, l_linenumber, l_quantity,
            CASE WHEN l_quantity >= 40 THEN 'mega' WHEN l_quantity >= 25 THEN 'high'
                WHEN l_quantity >= 10 THEN 'mid' ELSE 'standard' END AS tier
        FROM lineitem"""),
    "flag_sentinel": Query(flag_sentinel, f"""
        WITH {LABELLED} SELECT doc_id, quality IS NOT NULL AS has_label FROM labelled"""),
    "flag_all": Query(flag_all, f"""
        WITH {LABELLED}
        SELECT doc_id, coalesce(quality = 1 AND toxic = 0, false) AS usable FROM labelled"""),
    "weighted_score": Query(weighted_score, f"""
        SELECT l_orderkey, l_linenumber, o_orderpriority,
            {half_up('''(100 - 100 * l_discount) * CASE o_orderpriority WHEN '1-URGENT' THEN 4
                WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 2 ELSE 1 END''')} AS score
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "not_null_filter": Query(not_null_filter, f"""
        WITH {LABELLED}
        SELECT doc_id, lang, quality, toxic FROM labelled
        WHERE quality IS NOT NULL AND toxic IS NOT NULL"""),
    "row_id_dense": Query(row_id_dense, """
        SELECT row_number() OVER (ORDER BY c_custkey) AS id, c_name, c_acctbal, c_custkey
        FROM customer"""),
    "top_k_groups": Query(top_k_groups, f"""
        WITH {_GROUPS} SELECT * FROM groups ORDER BY lines DESC, l_suppkey LIMIT 10"""),
    "top_k_nulls_first": Query(top_k_nulls_first, f"""
        WITH {_GROUPS}
        SELECT * FROM groups ORDER BY avg_price DESC NULLS FIRST, l_suppkey LIMIT 5"""),
    "first_rows_sorted": Query(first_rows_sorted, f"""
        WITH {_GROUPS} SELECT * FROM groups ORDER BY lines DESC, l_suppkey LIMIT 20"""),
    "bounded_sample": Query(bounded_sample, """
        SELECT o_orderkey, o_totalprice FROM orders
        ORDER BY md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), '42')) LIMIT 1000"""),
    "per_group_sample": Query(per_group_sample, """
        SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_orderpriority
            ORDER BY md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), '42'))) <= 300"""),
}
