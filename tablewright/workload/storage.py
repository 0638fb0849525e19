"""Write a table, read it back: the rows must be the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.rollup import Rollup, mean, rollup, row_count
from tablewright.session import materialise, session_settings, workspace
from tablewright.sinks.files import export_counted, export_csv, write_parquet, write_table
from tablewright.sources.csv import read_csv, read_csv_inferred, read_csv_text
from tablewright.sources.manifest import file_manifest
from tablewright.sources.tables import read_parquet, read_table
from tablewright.workload.tables import LABELLED, Query, half_up, labelled_documents, table


def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines through a sharded CSV export; some values are null."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")).alias("l_returnflag"),
        F.when(F.col("l_quantity") != 7, F.col("l_quantity")).alias("l_quantity"),
    )
    path = workspace(spark)
    export_csv(lines, path)
    return read_csv(spark, path, lines.schema)


def csv_inferred(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select("p_name", "p_size", "p_retailprice")
    path = workspace(spark)
    export_csv(parts, path, rows_per_file=500)
    return read_csv_inferred(spark, path)


def csv_line_breaks(spark: SparkSession, folder: str) -> DataFrame:
    """Documents through CSV whose values hold line breaks, quotes and commas, read in small ranges."""
    documents = table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.concat_ws("\n", F.lit('says "so", then'), "lang", F.lit(""), "source").alias("note"),
        F.concat(F.lit("text: "), F.col("text"), F.lit("\n.")).alias("text"),
    )
    path = workspace(spark)
    export_csv(documents, path)
    with session_settings(spark, {"spark.sql.files.maxPartitionBytes": "256k", "spark.sql.files.openCostInBytes": "64k"}):
        read = read_csv_text(spark, path, documents.columns, multi_line=None)
        return materialise(read.select(*documents.columns), "read")


def file_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """Size and MD5 of text files, one per priority, of the sorted orders."""
    path = workspace(spark)
    line = F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus", "o_orderpriority")
    rows = table(spark, folder, "orders").select("o_orderpriority", "o_orderkey", line.alias("line"))
    rows.repartition("o_orderpriority").sortWithinPartitions("o_orderpriority", "o_orderkey").select("o_orderpriority", "line").write.partitionBy("o_orderpriority").text(path)
    priority = F.url_decode(F.regexp_extract("path", "o_orderpriority=([^/]*)/", 1))
    return file_manifest(spark, path, "*.txt").select(priority.alias("priority"), "bytes", "md5")


def csv_report(spark: SparkSession, folder: str) -> DataFrame:
    """A rollup as one CSV file."""
    report = rollup(table(spark, folder, "part"), Rollup("by_brand", "p_brand", (
        row_count("parts"), mean("avg_price", "p_retailprice"),
    )))
    path = workspace(spark)
    export_csv(report, path, single_file=True)
    read = read_csv(spark, path, report.schema)
    return read.withColumn("one_file", F.lit(len(read.inputFiles()) == 1))


def csv_null_marker(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of documents with the null marker of a bulk load."""
    rows = labelled_documents(spark, folder).select("doc_id", "lang", "quality")
    path = workspace(spark)
    export_csv(rows, path, null_value="\\N")
    return read_csv(spark, path, rows.schema, null_tokens=["\\N"])


def export_running_total(spark: SparkSession, folder: str) -> DataFrame:
    """Every step of an export's running total, counted while it was written."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return export_counted(lines, workspace(spark), 12, F.pmod("l_orderkey", F.lit(12)), rows_per_file=100_000)


def parquet_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Events overwritten, then appended to: a scan of all part files."""
    events = table(spark, folder, "events").select("event_id", "event_type", "value")
    path = workspace(spark)
    write_parquet(events.where(F.col("event_id") % 2 == 1), path)
    write_parquet(events.where(F.col("event_id") % 2 == 0), path)
    write_parquet(events.where(F.col("event_id") % 2 == 1), path, "append")
    return read_parquet(spark, path)


def catalog_table(spark: SparkSession, folder: str) -> DataFrame:
    name = "tablewright_customers"
    write_table(table(spark, folder, "customer"), name, workspace(spark))
    return read_table(spark, name)


QUERIES = {
    "csv_line_breaks": Query(csv_line_breaks, """
        SELECT CAST(doc_id AS VARCHAR) AS doc_id,
            concat_ws(chr(10), 'says "so", then', lang, '', source) AS note,
            'text: ' || text || chr(10) || '.' AS text
        FROM documents"""),
    "file_hashes": Query(file_hashes, """
        WITH lines AS (SELECT o_orderpriority AS priority, o_orderkey, concat_ws('|', o_orderkey, o_orderstatus, o_orderpriority) || chr(10) AS line FROM orders),
        files AS (SELECT priority, string_agg(line, '' ORDER BY o_orderkey) AS content FROM lines GROUP BY priority)
        SELECT priority, CAST(strlen(content) AS BIGINT) AS bytes, md5(content) AS md5 FROM files"""),
    "csv_round_trip": Query(csv_round_trip, """
        SELECT l_orderkey, l_linenumber, l_extendedprice, nullif(l_returnflag, 'A') AS l_returnflag,
            nullif(l_quantity, 7) AS l_quantity
        FROM lineitem"""),
    "csv_inferred": Query(csv_inferred, "SELECT p_name, p_size, p_retailprice FROM part"),
    "csv_report": Query(csv_report, f"""
        SELECT p_brand, count(*) AS parts, {half_up('avg(p_retailprice)')} AS avg_price,
            true AS one_file
        FROM part GROUP BY p_brand"""),
    "csv_null_marker": Query(csv_null_marker, f"""
        WITH {LABELLED} SELECT doc_id, lang, quality FROM labelled"""),
    "export_running_total": Query(export_running_total, """
        SELECT CAST(step AS INTEGER) AS step, count(l_orderkey) AS "rows",
            CAST(sum(count(l_orderkey)) OVER (ORDER BY step) AS BIGINT) AS total
        FROM range(12) AS steps(step) LEFT JOIN lineitem ON l_orderkey % 12 = step GROUP BY step"""),
    "parquet_parts": Query(parquet_parts, "SELECT event_id, event_type, value FROM events"),
    "catalog_table": Query(catalog_table, "SELECT * FROM customer"),
}
