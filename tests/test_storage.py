"""Readers, writers, manifest and increments."""

import hashlib
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.session import (
    materialise,
    scratch_tables,
    shuffle_partitions,
    session_settings,
    sized_shuffles,
    split_bytes,
    workspace,
)
from tablewright.sinks.files import export_counted, export_csv, export_progress, jdbc_write_options, write_json, write_table
from tablewright.sources.csv import PANDAS_TOKENS, read_csv, read_csv_text
from tablewright.sources.manifest import file_manifest, folder_bytes
from tablewright.sources.tables import (
    JdbcRanges,
    JdbcServer,
    jdbc_read_options,
    read_parquet,
    read_table,
)
from tablewright.streaming import (
    BATCH,
    process_increments,
    progress,
    read_increments,
    recorded_progress,
    stage_increments,
)

SCHEMA = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("n", T.IntegerType()),
    T.StructField("x", T.DoubleType()), T.StructField("b", T.BooleanType()),
])


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_csv_types_and_tokens(spark, tmp_path):
    write(f"{tmp_path}/in/a.csv", 'name,n,x,b\n"say ""hi"", you",1,1.5,True\nNA,,nan,no\nNone,x,NA,maybe\n')
    rows = read_csv(spark, f"{tmp_path}/in", SCHEMA).collect()
    assert rows[0] == ('say "hi", you', 1, 1.5, True)
    assert rows[1][0] == "NA" and rows[1][1] is None and rows[1][3] is False
    assert rows[2][1] is None and rows[2][3] is None
    like_pandas = read_csv(spark, f"{tmp_path}/in", SCHEMA, PANDAS_TOKENS).collect()
    assert [r["name"] for r in like_pandas] == ['say "hi", you', None, None]
    assert [r["x"] for r in like_pandas] == [1.5, None, None]


def test_csv_header_must_match(spark, tmp_path):
    write(f"{tmp_path}/in/a.csv", "name,x,n,b\na,1,1,True\n")
    with pytest.raises(Exception):
        read_csv(spark, f"{tmp_path}/in", SCHEMA).collect()


def test_csv_reads_only_csv_files_and_names_them(spark, tmp_path):
    write(f"{tmp_path}/in/a b+c.csv", "name,n,x,b\na,1,1,True\n")
    write(f"{tmp_path}/in/notes.txt", "name,n,x,b\nz,1,1,True\n")
    rows = read_csv_text(spark, f"{tmp_path}/in", SCHEMA.fieldNames()).collect()
    assert [(r["name"], r["source_file"]) for r in rows] == [("a", "a b+c.csv")]


def test_quoted_line_breaks_need_multi_line(spark, tmp_path):
    write(f"{tmp_path}/in/a.csv", 'name,n,x,b\n"two\nlines",1,1,True\n')
    assert read_csv(spark, f"{tmp_path}/in", SCHEMA, multi_line=True).first()["name"] == "two\nlines"


def test_manifest_of_small_and_large_files(spark, tmp_path):
    write(f"{tmp_path}/in/a b.csv", "x\n" * 700_000)
    write(f"{tmp_path}/in/c.csv", "y\n")
    rows = {r["file"]: r for r in file_manifest(spark, f"{tmp_path}/in").collect()}
    for name, row in rows.items():
        content = open(f"{tmp_path}/in/{name}", "rb").read()
        assert row["bytes"] == len(content) and row["md5"] == hashlib.md5(content).hexdigest()
    assert set(rows) == {"a b.csv", "c.csv"} and rows["a b.csv"]["size_mb"] == 1.34


def test_single_file_export(spark, tmp_path):
    df = spark.range(100).repartition(8).withColumn("t", F.lit(" a,b "))
    export_csv(df, f"{tmp_path}/out", single_file=True)
    files = [f for f in os.listdir(f"{tmp_path}/out") if f.endswith(".csv")]
    assert len(files) == 1
    assert open(f"{tmp_path}/out/{files[0]}").readline() == "id,t\n"
    back = read_csv(spark, f"{tmp_path}/out", df.schema)
    assert back.count() == 100 and back.first()["t"] == " a,b "


def test_a_large_report_is_exported_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tablewright.sinks.files.SINGLE_FILE_BYTES", 100)
    export_csv(spark.range(0, 100, 1, 4), f"{tmp_path}/out", single_file=True)
    assert len([f for f in os.listdir(f"{tmp_path}/out") if f.endswith(".csv")]) == 4
    assert spark.read.csv(f"{tmp_path}/out", header=True).count() == 100


def test_sharded_export_has_a_header_per_file(spark, tmp_path):
    export_csv(spark.range(100).coalesce(1), f"{tmp_path}/out", rows_per_file=30)
    files = [f for f in os.listdir(f"{tmp_path}/out") if f.endswith(".csv")]
    assert len(files) == 4
    steps = export_progress(spark, f"{tmp_path}/out", ["id"]).orderBy("part").collect()
    assert [r["rows"] for r in steps] == [30, 30, 30, 10] and steps[-1]["total"] == 100
    assert all(open(f"{tmp_path}/out/{f}").readline() == "id\n" for f in files)


def test_export_counts_while_it_writes(spark, tmp_path):
    rows = spark.range(0, 100, 1, 7)
    counted = export_counted(rows, f"{tmp_path}/out", 3)
    read = export_progress(spark, f"{tmp_path}/out", ["id"])
    steps = counted.orderBy("step").collect()
    assert [r["step"] for r in steps] == [0, 1, 2] and steps[-1]["total"] == 100
    assert sum(r["rows"] for r in steps) == read.agg(F.sum("rows")).first()[0]
    by_value = export_counted(rows, f"{tmp_path}/out", 4, F.when(F.col("id") < 10, 0).otherwise(2)).orderBy("step")
    assert [tuple(r) for r in by_value.collect()] == [(0, 10, 10), (1, 0, 10), (2, 90, 100), (3, 0, 100)]
    assert [tuple(r) for r in export_counted(spark.createDataFrame([], "id long"), f"{tmp_path}/out", 1).collect()] == [(0, 0, 0)]
    with pytest.raises(ValueError, match="no step"):
        export_counted(rows, f"{tmp_path}/out", 4, F.col("id"))
    with pytest.raises(ValueError, match="steps"):
        export_counted(rows, f"{tmp_path}/out", 0)


def test_json_replaces_the_previous_log(spark, tmp_path):
    for n in (3, 2):
        write_json(spark.range(n), f"{tmp_path}/log")
    assert spark.read.json(f"{tmp_path}/log").count() == 2


def test_missing_parquet_is_an_error(spark, tmp_path):
    with pytest.raises(Exception):
        read_parquet(spark, f"{tmp_path}/none")


def test_table_is_recreated(spark, tmp_path):
    write_table(spark.range(3), "some_table", f"{tmp_path}/t")
    write_table(spark.range(2).withColumn("x", F.lit(1)), "some_table", f"{tmp_path}/t2")
    assert read_table(spark, "some_table").columns == ["id", "x"]
    assert read_table(spark, "some_table").count() == 2
    spark.sql("DROP TABLE some_table")


def test_jdbc_options():
    server = JdbcServer("jdbc:postgresql://host:5432/db", "reader", "secret", "org.postgresql.Driver")
    assert "secret" not in repr(server)
    options = jdbc_read_options(server, "games", JdbcRanges("id", 1, 1_200_000, 12), 100_000)
    assert options == {
        "url": "jdbc:postgresql://host:5432/db", "user": "reader", "password": "secret",
        "driver": "org.postgresql.Driver", "dbtable": "games", "fetchsize": "100000",
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "1200000", "numPartitions": "12",
    }
    written = jdbc_write_options(JdbcServer("jdbc:x"), "t", 500, 4, "k varchar(3)")
    assert written == {"url": "jdbc:x", "dbtable": "t", "batchsize": "500", "numPartitions": "4", "createTableColumnTypes": "k varchar(3)"}


class FakeSession:
    """Settings and master of a session that the test cannot start."""

    def __init__(self, master, settings):
        self.sparkContext = SimpleNamespace(master=master)
        self.conf = settings


def test_workspace_follows_the_session():
    shared = FakeSession("spark://host:7077", {"spark.checkpoint.dir": "hdfs://store/work/"})
    assert workspace(shared).startswith("hdfs://store/work/tablewright-")
    assert workspace(shared) != workspace(shared)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace(FakeSession("spark://host:7077", {}))


def test_scratch_tables_are_deleted(spark):
    with scratch_tables(spark):
        inside = materialise(spark.range(3))
        folder = inside.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)
    outside = materialise(spark.range(3))
    assert outside.count() == 3


def test_scans_and_shuffles_are_sized_by_the_input(spark):
    tera = 1024**4
    assert shuffle_partitions(10, 8) == 8
    assert shuffle_partitions(tera, 200) == 4096
    assert shuffle_partitions(100 * tera, 200) == 32_768
    assert split_bytes(tera, 128 * 1024**2) == 128 * 1024**2
    assert split_bytes(100 * tera, 128 * 1024**2) > 1024**3
    names = [
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
        "spark.sql.files.maxPartitionBytes",
    ]
    before = [spark.conf.get(n, None) for n in names]
    with sized_shuffles(spark, tera):
        assert spark.conf.get(names[0]) == "4096"
    with sized_shuffles(spark, 100 * tera):
        assert spark.conf.get(names[1]) == "1099511628b"
    assert [spark.conf.get(n, None) for n in names] == before


def test_folder_bytes(spark, tmp_path):
    write(f"{tmp_path}/in/a.csv", "12345")
    write(f"{tmp_path}/in/b.txt", "1234567")
    assert folder_bytes(spark, f"{tmp_path}/in", "*.csv") == 5
    assert folder_bytes(spark, f"{tmp_path}/in", "*.json") == 0


def test_materialise_keeps_schema_and_rows(spark):
    df = materialise(spark.range(5).withColumn("t", F.lit(None).cast("string")))
    assert df.schema.simpleString() == "struct<id:bigint,t:string>" and df.count() == 5
    assert materialise(spark.range(0)).count() == 0


def double(df):
    return df.select((F.col("v") * 2).alias("v"), BATCH)


@pytest.mark.parametrize("limits", [{}, {"files_per_trigger": 1}, {"bytes_per_trigger": 1000}])
def test_restart_adds_nothing_and_new_files_are_added_once(spark, tmp_path, limits):
    feed, target = f"{tmp_path}/feed", f"{tmp_path}/out"
    schema = stage_increments(spark.range(1000).toDF("v"), feed, 5)
    for _ in range(2):
        process_increments(spark, feed, schema, target, double, **limits)
        assert read_increments(spark, target).count() == 1000
    stage_increments(spark.range(1000, 1100).toDF("v"), feed, 5)
    process_increments(spark, feed, schema, target, double, **limits)
    output = read_increments(spark, target)
    assert sorted(r["v"] for r in output.collect()) == [2 * i for i in range(1100)]
    steps = progress(output).orderBy("batch").collect()
    assert [r["batch"] for r in steps] == [0, 1, 2, 3, 4]
    assert steps[-1]["output_rows"] == 1100 and {r["status"] for r in steps} == {"processed"}
    assert sum(r["input_rows"] for r in steps) == 1100


def test_progress_comes_from_the_runs_also_after_one_was_cut_short(spark, tmp_path):
    feed, target = f"{tmp_path}/feed", f"{tmp_path}/out"
    schema = stage_increments(spark.range(1000).toDF("v"), feed, 5)

    def run(transform=double):
        return process_increments(spark, feed, schema, target, transform, files_per_trigger=1, increments=5)

    def equal():
        output = progress(read_increments(spark, target)).orderBy("batch").collect()
        return recorded_progress(spark, target).orderBy("batch").collect() == output

    assert recorded_progress(spark, target).count() == 0
    for _ in range(2):
        run()
        assert equal()
    stage_increments(spark.range(1000, 1100).toDF("v"), feed, 5)
    run()
    assert equal() and recorded_progress(spark, target).agg(F.max("output_rows")).first()[0] == 1100

    # The rows of this run reach the output for a part only: one value cannot be divided.
    stage_increments(spark.range(1100, 1200).toDF("v"), feed, 5)
    with session_settings(spark, {"spark.sql.ansi.enabled": "true"}), pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        run(lambda df: double(df.withColumn("v", (F.col("v") / F.when(F.col("v") == 1150, 0).otherwise(1)).cast("long"))))
    with pytest.raises(RuntimeError, match="cut short"):
        recorded_progress(spark, target)
    run()
    assert equal() and recorded_progress(spark, target).agg(F.max("output_rows")).first()[0] == 1200
    stage_increments(spark.range(1200, 1250).toDF("v"), feed, 5)
    run()
    assert equal()


def test_runs_that_did_not_count_are_counted_later(spark, tmp_path):
    feed, target = f"{tmp_path}/feed", f"{tmp_path}/out"
    schema = stage_increments(spark.range(100).toDF("v"), feed, 3)
    process_increments(spark, feed, schema, target, double)
    # Increment 2 has no counter of its own.
    process_increments(spark, feed, schema, target, double, increments=2)
    stage_increments(spark.range(100, 200).toDF("v"), feed, 3)
    process_increments(spark, feed, schema, target, double, increments=2)
    steps = recorded_progress(spark, target).orderBy("batch").collect()
    assert steps == progress(read_increments(spark, target)).orderBy("batch").collect()
    assert steps[-1]["output_rows"] == 200
