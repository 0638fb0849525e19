"""CSV with line breaks inside values cut into ranges, rejected values, digests of files."""

import csv
import hashlib
import io
import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.plans import games, jobs
from tablewright.session import session_settings
from tablewright.sources import manifest, records
from tablewright.sources.csv import Quarantine, UnreadableError, read_csv_text
from tablewright.sources.manifest import file_digests, file_manifest
from test_jobs import NAMES, game, write_games

SPLIT = "spark.sql.files.maxPartitionBytes"
OPEN = "spark.sql.files.openCostInBytes"


def write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())


def quoted(rows, line_end="\n"):
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator=line_end, quoting=csv.QUOTE_MINIMAL).writerows(rows)
    return out.getvalue()


HARD = [
    ("a", "b"), ("1", "plain"), ("2", "two\nlines"), ("3", 'say "hi",\n\n"you"\n'), ("4", ""), ("x,y", '"'), ("5", "\n"),
    ("6", 'é\n漢"'), ("seven\n\n\nseven", "7"), ("8", ",\n,"), ("9", "end"),
]


def rows_of(df):
    return sorted((r["a"] or "", r["b"] or "") for r in df.collect())


@pytest.mark.parametrize("line_end, sizes", [("\n", [1, 3, 16, 60, 1 << 20]), ("\r\n", [1, 16])])
def test_cuts_at_every_byte(spark, tmp_path, line_end, sizes):
    text = quoted(HARD, line_end)
    write(f"{tmp_path}/in/a.csv", text)
    write(f"{tmp_path}/in/b.csv", quoted([("a", "b"), ("one", "file\nmore")], line_end))
    want = sorted([*HARD[1:], ("one", "file\nmore")])
    for size in sizes:
        with session_settings(spark, {SPLIT: str(size), OPEN: "1", "spark.sql.files.minPartitionNum": "200"}):
            df = read_csv_text(spark, f"{tmp_path}/in", ["a", "b"], multi_line=True)
            if size < 16:
                assert df.rdd.getNumPartitions() > 30
            assert rows_of(df) == want, size


def test_random_files_in_small_ranges(spark, tmp_path):
    source = random.Random(5)
    want = []
    for f in range(4):
        rows = [("".join(source.choices('ab ,"\n\r', k=source.randrange(1, 9))).strip() + "z", "".join(source.choices('xy,"\n', k=source.randrange(0, 30))) + "z") for _ in range(150)]
        want += rows
        write(f"{tmp_path}/in/{f}.csv", quoted([("a", "b"), *rows], source.choice(["\n", "\r\n"])))
    with session_settings(spark, {SPLIT: "256", OPEN: "1", "spark.sql.files.minPartitionNum": "60"}):
        assert rows_of(read_csv_text(spark, f"{tmp_path}/in", ["a", "b"], multi_line=True)) == sorted(want)


def test_line_breaks_are_looked_for(spark, tmp_path):
    write(f"{tmp_path}/in/a.csv", quoted([("a", "b"), ("1", 'x ""')]))
    assert not records.has_line_breaks(spark, f"{tmp_path}/in")
    write(f"{tmp_path}/in/b.csv", quoted([("a", "b"), ("2", "y\ny")]))
    assert records.has_line_breaks(spark, f"{tmp_path}/in")
    df = read_csv_text(spark, f"{tmp_path}/in", ["a", "b"], multi_line=None)
    assert rows_of(df) == [("1", 'x ""'), ("2", "y\ny")]
    assert {r["source_file"] for r in df.collect()} == {"a.csv", "b.csv"}


def test_wrong_quotes_headers_and_too_long_values(spark, tmp_path, monkeypatch):
    write(f"{tmp_path}/open/a.csv", 'a,b\n1,"never closed\n2,x\n')
    with pytest.raises(ValueError, match="without an end"):
        read_csv_text(spark, f"{tmp_path}/open", ["a", "b"], multi_line=True)
    write(f"{tmp_path}/head/a.csv", 'b,a\n1,"x\ny"\n')
    with pytest.raises(Exception, match="header"):
        read_csv_text(spark, f"{tmp_path}/head", ["a", "b"], multi_line=True).collect()
    monkeypatch.setattr(records, "MOST_CHARS", 20)
    write(f"{tmp_path}/long/a.csv", 'a,b\n1,"' + "xx\n" * 50 + '"\n')
    with session_settings(spark, {SPLIT: "32", OPEN: "1", "spark.sql.files.minPartitionNum": "5"}), pytest.raises(Exception, match="longer than"):
        read_csv_text(spark, f"{tmp_path}/long", ["a", "b"], multi_line=True).collect()


def test_no_file_and_only_a_header(spark, tmp_path):
    write(f"{tmp_path}/in/a.csv", "a,b\n")
    write(f"{tmp_path}/in/b.csv", "")
    assert read_csv_text(spark, f"{tmp_path}/in", ["a", "b"], multi_line=True).collect() == []
    os.makedirs(f"{tmp_path}/none")
    assert read_csv_text(spark, f"{tmp_path}/none", ["a", "b"], multi_line=True).collect() == []


# ---- rejected values

SCHEMA = T.StructType([T.StructField("s", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("x", T.DoubleType()), T.StructField("b", T.BooleanType())])
DIRTY = "s,n,x,b\nok,1,1.5,true\nbad,one,2.5,maybe\nnull,NA,,\nfine,2.0,nan,no\nlast,9999999999,x,yes\n"


def test_rejected_values(spark, tmp_path):
    write(f"{tmp_path}/in/a.csv", DIRTY)
    text = read_csv_text(spark, f"{tmp_path}/in", SCHEMA.fieldNames())
    for how, kept in (("quarantine", {"ok", None, "fine"}), ("null", {"ok", "bad", None, "fine", "last"}), ("fail", {"ok", None, "fine"})):
        checked = Quarantine(text, SCHEMA, ("NA", "null", ""), how)
        assert {r["s"] for r in checked.rows.collect()} == kept
        if how == "fail":
            with pytest.raises(UnreadableError, match="'n': 2"):
                checked.settle(f"{tmp_path}/rejected")
            continue
        found = checked.settle(f"{tmp_path}/rejected").collect()
        assert {(r["source_file"], r["column"], r["text"]) for r in found} == {
            ("a.csv", "n", "one"), ("a.csv", "b", "maybe"), ("a.csv", "n", "9999999999"), ("a.csv", "x", "x")}
        assert '"s":"bad","n":"one","x":"2.5","b":"maybe"' in [r["row"] for r in found if r["text"] == "one"][0]
    clean = Quarantine(text.where("s IN ('ok', 'fine')"), SCHEMA)
    assert clean.rows.count() == 2 and clean.settle(f"{tmp_path}/none").collect() == []
    with pytest.raises(ValueError):
        Quarantine(text, SCHEMA, on_unreadable="drop")


def test_jobs_fail_on_unreadable_values_by_default(spark, tmp_path):
    write_games(f"{tmp_path}/in/games.csv", [game(), game(game="Two\nlines, and \"more\"", rtp="97"), game(game="Bad", rtp="high", release_year="soon")])
    layout = jobs.Layout(f"{tmp_path}/out")
    for job, rejected in ((jobs.load_raw, ("raw", "rejected")), (jobs.batch, ("curated", "rejected"))):
        with pytest.raises(UnreadableError, match="rtp"):
            job(spark, f"{tmp_path}/in", layout)
        assert spark.read.parquet(layout.path(*rejected)).count() == 2
    assert not os.path.exists(layout.path("raw", "table")) and not os.path.exists(layout.path("processed"))
    raw = jobs.load_raw(spark, f"{tmp_path}/in", layout, on_unreadable="quarantine")
    assert {r["game"] for r in raw.collect()} == {"Book", 'Two\nlines, and "more"'}
    tables = jobs.batch(spark, f"{tmp_path}/in", layout, on_unreadable="null")
    assert {(r["game"], r["rtp"]) for r in tables["processed"].collect()} == {("BOOK", 96.5), ('TWO\nLINES, AND "MORE"', 97.0), ("BAD", None)}
    record = jobs.ingest(spark, f"{tmp_path}/in", layout).first()
    assert (record["rows"], record["unreadable"]) == (3, {"rtp": 1, "release_year": 1})


# ---- digests

FILES = {
    "empty.csv": b"", "line.csv": b"x", "ends.csv": b"x\n", "two.csv": b"\n\n", "breaks.csv": b"a\r\nb\rc\n\nd", "mark.csv": b"\xef\xbb\xbfa,b\n1,2\n",
    "mark only.csv": b"\xef\xbb\xbf", "bytes+%20.csv": bytes(random.Random(1).randrange(256) for _ in range(300_000)), "long.csv": b"y" * 3_000_000 + b"\nz",
}


def test_digests_of_any_bytes(spark, tmp_path):
    for name, data in FILES.items():
        write(f"{tmp_path}/in/{name}", data)
    write(f"{tmp_path}/in/other.txt", b"no")
    rows = file_manifest(spark, f"{tmp_path}/in").collect()
    assert {r["file"]: (r["bytes"], r["md5"]) for r in rows} == {n: (len(d), hashlib.md5(d).hexdigest()) for n, d in FILES.items() if d}
    os.makedirs(f"{tmp_path}/none")
    assert file_digests(spark, f"{tmp_path}/none").collect() == []


def test_large_files_go_from_task_to_task(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(manifest, "PART_BYTES", 50_000)
    files = {
        "a [b]{c}*+%20.csv": bytes(random.Random(1).randrange(256) for _ in range(130_000)), "long.csv": b"y" * 120_000 + b"\nz\n",
        "mark.csv": b"\xef\xbb\xbf" + b"1,2\r\n" * 20_000, "breaks.csv": b"\n" * 100_001, "edge.csv": b"x" * 49_999 + b"\n" + b"z" * 50_000,
        "even.csv": b"123456789\n" * 10_000, "as large.csv": b"1\n" * 25_000, "small.csv": b"x",
    }
    for name, data in files.items():
        write(f"{tmp_path}/in/part=1/{name}", data)
    rows = file_digests(spark, f"{tmp_path}/in").collect()
    assert {r["path"].split("/")[-1]: (r["bytes"], r["md5"]) for r in rows} == {n: (len(d), hashlib.md5(d).hexdigest()) for n, d in files.items()}


def test_a_file_is_one_stream_of_batches(spark, tmp_path, monkeypatch):
    """No task holds a file: its lines come in batches, and every task has one file."""
    for i in range(3):
        write(f"{tmp_path}/in/{i}.csv", b"%d,0123456789\n" % i * 100_000)
    before = spark.conf.get(SPLIT)
    rows = file_digests(spark, f"{tmp_path}/in").collect()
    assert spark.conf.get(SPLIT) == before
    assert {r["md5"] for r in rows} == {hashlib.md5(b"%d,0123456789\n" % i * 100_000).hexdigest() for i in range(3)}


def test_rejected_flag_and_cells_agree(spark, tmp_path):
    """Each value is parsed once in the pass that counts, and no array is made of a row's cells there."""
    write(f"{tmp_path}/in/a.csv", DIRTY)
    text = read_csv_text(spark, f"{tmp_path}/in", SCHEMA.fieldNames())
    checked = Quarantine(text, SCHEMA, ("NA", "null", ""), "quarantine")
    plan = checked.rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("try_cast") == 3 and "struct(column" not in plan and "filter(" not in plan
    kept, cells = {r["s"] for r in checked.rows.collect()}, checked.rejected().collect()
    assert kept == {"ok", None, "fine"}
    assert {json.loads(r["row"])["s"] for r in cells} == {"bad", "last"} and len(cells) == 4
    words = T.StructType([T.StructField(c, T.StringType()) for c in SCHEMA.fieldNames()])
    only_text = Quarantine(text, words)
    assert only_text.rows.count() == 5 and only_text.rejected().collect() == []


def test_measured_lines(spark, tmp_path):
    write(f"{tmp_path}/in/a.csv", quoted([("a", "b"), ("1", 'x ""')]))
    size = os.path.getsize(f"{tmp_path}/in/a.csv")
    assert records.measured_lines(spark, f"{tmp_path}/in") == (2, size - 2, False)
    write(f"{tmp_path}/in/b.csv", quoted([("a", "b"), ("2", "é\ny")]))
    size += os.path.getsize(f"{tmp_path}/in/b.csv")
    assert records.measured_lines(spark, f"{tmp_path}/in") == (5, size - 5, True)
    os.makedirs(f"{tmp_path}/none")
    assert records.measured_lines(spark, f"{tmp_path}/none") == (0, 0, False)
