"""Operators against brute force on small tables, skewed keys included."""

import hashlib
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import deviation
from tablewright.operators.clean import distinct_rows, distinct_rows_in_buckets, normalise, require_values
from tablewright.operators.enrich import attach_stats, enrich, enrich_in_buckets, enrich_with_group_stats
from tablewright.operators import lookups
from tablewright.operators.ids import dense_id, running_total, slice_of, surrogate_id
from tablewright.operators.ordering import ranked, stable_sample, top_k
from tablewright.operators.quality import (
    duplicate_rows,
    key_violations,
    null_profile,
    null_total,
    profile,
    row_counts,
    same_rows,
)
from tablewright.operators.rollup import (
    Rollup,
    combination_share,
    count_true,
    mean,
    rollup,
    rollups_in_one_pass,
    row_count,
    stacked_rollup,
    stddev,
)
from tablewright.operators.sizing import measured_bytes
from tablewright.sinks.contracts import Contract, Field, apply_contract, contract_violations

QUIET = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def skewed(spark, n=3000):
    """A third of the rows has one key; some keys are null."""
    random.seed(7)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{random.randrange(200)}"
        rows.append((key, i, round(random.random() * 100, 2), i % 7 == 0))
    return spark.createDataFrame(rows, "k string, i int, x double, flag boolean").repartition(8)


def test_twins_collapse_after_normalising(spark):
    rows = [(" Book ", 96.001, None, 1), ("BOOK", 96.004, "No Jackpot", 1), ("BOOK", 96.01, "Mini", 1)]
    df = spark.createDataFrame(rows, "game string, rtp double, jackpot string, n int")
    clean = distinct_rows(normalise(df, ["game"], ["rtp"], {"jackpot": "No Jackpot"}))
    assert tuples(clean) == [("BOOK", 96.0, "No Jackpot", 1), ("BOOK", 96.01, "Mini", 1)]


def test_fill_comes_after_rounding(spark):
    df = spark.createDataFrame([(None,), (1.005,)], "m double")
    assert tuples(normalise(df, numbers=["m"], number_fill={"m": 0.0})) == [(0.0,), (1.01,)]


@QUIET
@given(st.lists(st.tuples(st.sampled_from(["a", "A ", None, "b"]), st.sampled_from([1.0, 1.001, None])), max_size=30))
def test_dedup_is_idempotent(spark, rows):
    df = distinct_rows(normalise(spark.createDataFrame(rows, "t string, x double"), ["t"], ["x"]))
    once = tuples(df)
    assert once == tuples(distinct_rows(df)) and len(once) == len(set(once))


def test_require_values_reaches_the_scan(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    df = require_values(lines, ["l_tax", "l_discount"], ["l_tax"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(l_tax)" in plan and "IsNotNull(l_discount)" in plan
    assert "l_comment" not in plan and "l_extendedprice" not in plan


METRICS = (row_count("n"), mean("avg_x", "x"), count_true("flags", "flag"))


def test_null_key_is_a_group(spark):
    grouped = {r["k"]: r for r in rollup(skewed(spark), Rollup("r", "k", METRICS)).collect()}
    assert grouped[None]["n"] > 0
    assert sum(r["n"] for r in grouped.values()) == 3000


def test_rollups_from_one_pass_equal_single_rollups(spark):
    df = skewed(spark).withColumn("j", F.col("i") % 4)
    specs = [Rollup("by_k", "k", METRICS), Rollup("by_j", "j", (row_count("rows"), mean("m", "x", 1)))]
    shared = rollups_in_one_pass(df, specs)
    for spec in specs:
        assert tuples(shared[spec.name]) == tuples(rollup(df, spec))
        assert shared[spec.name].schema.simpleString() == rollup(df, spec).schema.simpleString()
    stacked = stacked_rollup(df, ["k", "j"], METRICS)
    assert stacked.where("rollup = 'j'").agg(F.sum("n")).first()[0] == 3000


@pytest.mark.parametrize("share", [0.0, 1.0])
def test_both_plans_of_shared_rollups_are_equal(spark, share):
    df = skewed(spark).withColumn("j", F.when(F.col("i") % 4 > 0, F.col("i") % 4))
    specs = [Rollup("by_k", "k", METRICS), Rollup("by_i", "i", METRICS), Rollup("by_j", "j", METRICS), Rollup("again", "k", (row_count("rows"),))]
    shared = rollups_in_one_pass(df, specs, share)
    for spec in specs:
        single = rollup(df, spec)
        assert tuples(shared[spec.name]) == tuples(single)
        assert shared[spec.name].schema.simpleString() == single.schema.simpleString()
    assert ("__level" in shared["by_i"]._jdf.queryExecution().toString()) == (share == 0.0)
    assert all(t.isEmpty() for t in rollups_in_one_pass(df.limit(0), specs, share).values())


def test_share_of_key_combinations(spark):
    df = skewed(spark)
    assert combination_share(df, ["i"]) > 0.9 and combination_share(df, ["k"]) < 0.25
    pairs = spark.createDataFrame([(None, "x"), ("x", None)] * 50, "a string, b string")
    assert combination_share(pairs, ["a", "b"]) == 0.02 and combination_share(pairs.limit(0), ["a"]) == 0


def test_mean_of_missing_values(spark):
    df = spark.createDataFrame([("a", None), ("a", 2.0), ("b", None)], "k string, x double")
    spec = Rollup("r", "k", (row_count("n"), mean("m", "x")))
    assert tuples(rollup(df, spec)) == [("a", 2, 2.0), ("b", 1, None)]
    assert tuples(rollups_in_one_pass(df, [spec])["r"]) == [("a", 2, 2.0), ("b", 1, None)]


def test_stddev_needs_rows(spark):
    with pytest.raises(ValueError):
        rollups_in_one_pass(skewed(spark), [Rollup("r", "k", (stddev("s", "x"),))])
    df = spark.createDataFrame([("a", 1.0)], "k string, x double")
    assert tuples(rollup(df, Rollup("r", "k", (stddev("s", "x"),)))) == [("a", None)]


STATS = (row_count("n"), mean("avg_x", "x"), stddev("sd_x", "x"))


def expected_enrichment(df):
    stats = {r["k"]: (r["n"], r["avg_x"], r["sd_x"]) for r in rollup(df, Rollup("s", "k", STATS)).collect()}
    stats[None] = (None, None, None)
    return sorted(((r["k"], r["i"], r["x"], r["flag"], *stats[r["k"]]) for r in df.collect()), key=str)


def test_enrichment_conserves_rows_and_leaves_null_keys(spark):
    df = skewed(spark)
    enriched = enrich_with_group_stats(df, "k", STATS)
    assert enriched.columns == ["k", "i", "x", "flag", "n", "avg_x", "sd_x"]
    assert tuples(enriched) == expected_enrichment(df)
    assert "BroadcastHashJoin" in enriched._jdf.queryExecution().executedPlan().toString()
    assert same_rows(df, enriched)


def test_split_join_equals_broadcast_join(spark):
    df = skewed(spark)
    stats = rollup(df, Rollup("s", "k", STATS))
    split = attach_stats(df, stats, "k", "n", max_broadcast_bytes=0)
    assert split.columns == ["k", "i", "x", "flag", "n", "avg_x", "sd_x"]
    assert tuples(split) == expected_enrichment(df)


def test_split_join_with_no_hot_key(spark):
    rows = [(f"k{i}", i) for i in range(2500)]
    df = spark.createDataFrame(rows, "k string, i int")
    stats = rollup(df, Rollup("s", "k", (row_count("n"),)))
    split = attach_stats(df, stats, "k", "n", max_broadcast_bytes=0)
    assert split.count() == 2500 and split.agg(F.sum("n")).first()[0] == 2500


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("buckets", [1, 3, 64])
def test_buckets_equal_the_broadcast_join(spark, buckets):
    df = skewed(spark)
    rows = enrich_in_buckets(df, "k", STATS, buckets)
    assert rows.columns == ["k", "i", "x", "flag", "n", "avg_x", "sd_x"]
    assert tuples(rows) == expected_enrichment(df)
    assert shuffles(rows) == 0


def test_buckets_of_light_keys_of_null_keys_and_of_no_rows(spark):
    df = spark.createDataFrame([(f"k{i % 900}", i) for i in range(2500)], "k string, i int")
    light = enrich_in_buckets(df, "k", (row_count("n"),))
    assert light.count() == 2500 and light.agg(F.sum("n")).first()[0] == 700 * 9 + 200 * 4
    assert shuffles(light) == 0 and "Bucketed: true" in light._jdf.queryExecution().toString()
    empty = spark.createDataFrame([(None, 1), (None, 1)], "k string, i int")
    assert tuples(enrich_in_buckets(empty, "k", (row_count("n"),))) == [(None, 1, None), (None, 1, None)]
    assert enrich_in_buckets(df.limit(0), "k", (row_count("n"),)).count() == 0


def test_enrichment_chooses_by_the_number_of_keys(spark):
    df = skewed(spark)
    for limit, bucketed in ((10**6, False), (0, True)):
        rows = enrich(df, "k", STATS, limit)
        assert tuples(rows) == expected_enrichment(df)
        assert ("Bucketed: true" in rows._jdf.queryExecution().toString()) == bucketed


def test_enrichment_asks_for_a_count(spark):
    with pytest.raises(ValueError):
        enrich_with_group_stats(skewed(spark), "k", (mean("avg_x", "x"),))


def test_deviation_after_enrichment(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 3.0)], "k string, x double")
    rows = enrich_with_group_stats(df, "k", STATS).withColumn("d", deviation("x", "avg_x"))
    assert tuples(rows.select("x", "d")) == [(1.0, -0.5), (2.0, 0.5), (3.0, None)]


def test_measured_bytes_grow_with_text(spark):
    rows, short = measured_bytes(spark.createDataFrame([("a", 1)] * 10, "t string, n int"))
    _, long = measured_bytes(spark.createDataFrame([("a" * 1000, 1)] * 10, "t string, n int"))
    assert rows == 10 and long - short == 9990
    assert measured_bytes(spark.createDataFrame([], "t string")) == (0, 0)


def test_ranked_orders_nulls_and_ties(spark):
    rows = [("a", 1.0), ("b", None), ("c", 2.0), ("d", 2.0), (None, 2.0)]
    df = spark.createDataFrame(rows, "k string, m double")
    assert [r["k"] for r in ranked(df, "m", "k").collect()] == [None, "c", "d", "a", "b"]
    assert [r["k"] for r in top_k(df, "m", 2, "k", nulls_first=True).collect()] == ["b", None]


def digest(*parts, seed=42):
    return hashlib.md5("|".join([*(str(p) for p in parts), str(seed)]).encode()).hexdigest()


@pytest.mark.parametrize("n", [1, 10, 2999, 3000, 5000])
def test_sample_equals_sorting_all_rows(spark, n):
    df = skewed(spark)
    expected = sorted(range(3000), key=digest)[:n]
    got = stable_sample(df, n, ["i"])
    assert sorted(r["i"] for r in got.collect()) == sorted(expected)
    assert got.columns == df.columns


def test_sample_per_group_equals_sorting_each_group(spark):
    df = skewed(spark)
    groups = {}
    for r in df.collect():
        groups.setdefault(r["k"], []).append(r["i"])
    expected = sorted(i for ids in groups.values() for i in sorted(ids, key=digest)[:20])
    assert sorted(r["i"] for r in stable_sample(df, 20, ["i"], by="k").collect()) == expected


@pytest.mark.parametrize("by", [None, "k"])
def test_selection_in_several_rounds(spark, monkeypatch, by):
    """With buckets that count as small only at one row, digits are told apart round by round."""
    from tablewright.operators import ordering

    monkeypatch.setattr(ordering, "ROUND_DIGITS", 1)
    monkeypatch.setattr(ordering, "SMALL_BUCKET", 1)
    df = spark.range(3000).select(F.col("id").alias("i"), F.when(F.col("id") % 10 < 8, "hot").when(F.col("id") % 10 == 8, "cold").alias("k"))
    df = df.unionByName(df.where("i < 5")).repartition(4)
    rows = [(r["i"], r["k"]) for r in df.collect()]
    digest = lambda i: hashlib.md5(f"{i}|42".encode()).hexdigest()
    for n in (1, 7, 301):
        groups = {k for _, k in rows} if by else {None}
        want = [x for g in groups for x in sorted((i for i, k in rows if not by or k == g), key=digest)[:n]]
        assert sorted(r["i"] for r in stable_sample(df, n, ["i"], by=by).collect()) == sorted(want)


def test_sample_of_nothing(spark):
    empty = spark.createDataFrame([], "i long, k string")
    assert stable_sample(empty, 5, ["i"]).collect() == [] and stable_sample(empty, 5, ["i"], by="k").collect() == []
    assert stable_sample(spark.range(5), 0).collect() == []


def test_sample_of_equal_rows(spark):
    df = spark.createDataFrame([("same", 1)] * 500 + [("other", i) for i in range(20)], "t string, i int")
    assert stable_sample(df, 100).count() == 100
    assert stable_sample(df, 1000).count() == 520
    assert stable_sample(df, 30, by="t").groupBy("t").count().orderBy("t").collect() == [("other", 20), ("same", 30)]


def test_sample_does_not_depend_on_partitions(spark):
    df = skewed(spark)
    assert tuples(stable_sample(df.repartition(3), 50)) == tuples(stable_sample(df.coalesce(1), 50))
    assert tuples(stable_sample(df, 50, seed=1)) != tuples(stable_sample(df, 50, seed=2))


def test_surrogate_ids_are_unique(spark):
    df = surrogate_id(skewed(spark))
    assert df.columns[0] == "id"
    assert df.agg(F.countDistinct("id"), F.min("id")).first() == (3000, 1)


def test_dense_ids_follow_the_order(spark):
    df = dense_id(skewed(spark), [F.desc("i")])
    assert sorted((r["id"], r["i"]) for r in df.collect()) == [(j + 1, 2999 - j) for j in range(3000)]
    scan = dense_id(skewed(spark))
    assert sorted(r["id"] for r in scan.collect()) == list(range(1, 3001))


def test_slices_partition_the_rows(spark):
    df = skewed(spark).withColumn("s", slice_of(5, "k", "i"))
    again = skewed(spark).repartition(3).withColumn("s", slice_of(5, "k", "i"))
    assert tuples(df) == tuples(again)
    counts = {r["s"]: r["count"] for r in df.groupBy("s").count().collect()}
    assert set(counts) == {0, 1, 2, 3, 4} and sum(counts.values()) == 3000
    negative = spark.createDataFrame([(-7,)], "i int").select(slice_of(5, "i", integer=True))
    assert negative.first()[0] == 3


def test_running_total_ends_at_total(spark):
    df = spark.createDataFrame([(2, 5), (0, 3), (1, 4)], "b int, n int")
    assert tuples(running_total(df, "b", "n", "t")) == [(0, 3, 3), (1, 4, 7), (2, 5, 12)]


def test_profile_counts(spark):
    rows = [("f", "a", 1.0), ("f", "a", 1.0), ("f", None, None), ("f", None, None), ("f", None, float("nan")), ("g", "a", 1.0)]
    df = spark.createDataFrame(rows, "file string, t string, x double")
    got = {r["file"]: r for r in profile(df, ["file"]).collect()}
    assert (got["f"]["rows"], got["f"]["duplicates"]) == (5, 2)
    assert got["f"]["nulls"] == {"t": 3, "x": 3} and got["f"]["columns"] == ["t", "x"]
    assert (got["g"]["rows"], got["g"]["duplicates"]) == (1, 0)
    whole = profile(df.drop("file")).first()
    assert (whole["rows"], whole["duplicates"], whole["nulls"]) == (6, 3, {"t": 3, "x": 3})
    assert tuples(null_profile(df)) == [("file", 0), ("t", 3), ("x", 3)]
    assert null_total(df).first()[0] == 6
    assert duplicate_rows(df).first() == (6, 2)
    assert duplicate_rows(df.limit(0)).first() == (0, 0)


@pytest.mark.parametrize("most_files", [lookups.MOST_FILES, 0])
def test_lookups_in_buckets(spark, monkeypatch, most_files):
    """Hot, null and unknown keys, and a lookup with a repeated key; no row is shuffled in buckets."""
    monkeypatch.setattr(lookups, "MOST_FILES", most_files)
    df = skewed(spark)
    wide = spark.createDataFrame([(f"k{i}", f"name {i}") for i in range(0, 200, 2)] + [("hot", "a"), ("hot", "b"), (None, "none")], "n string, name string")
    number = spark.createDataFrame([(i, i % 5) for i in range(0, 3000, 3)], "j int, five int")
    want = tuples(df.join(wide, F.col("k") == F.col("n")).join(number, F.col("i") == F.col("j")).select("k", "i", "x", "name", "five"))
    pairs = [lookups.Lookup("k", wide, "n"), lookups.Lookup("i", number, "j")]
    got = lookups.join_lookups(df, pairs, max_broadcast_bytes=1, buckets=4).select("k", "i", "x", "name", "five")
    assert tuples(got) == want and len(want) > 1000
    assert tuples(lookups.join_lookups(df, pairs).select("k", "i", "x", "name", "five")) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("Exchange" in plan) == (most_files == 0)
    other = lookups.Lookup("i", number.withColumn("j", F.col("j").cast("long")), "j")
    assert tuples(lookups.join_lookups(df, [pairs[0], other], 1, 4).select("k", "i", "x", "name", "five")) == want


def test_heavy_keys_are_spread(spark):
    df = skewed(spark)
    rows = lookups._join_in_buckets(df, lookups.Lookup("k", df.select(F.col("k").alias("n")).distinct(), "n"), 4, [df.select(F.xxhash64(F.lit("hot"))).first()[0]])
    sizes = [len(part) for part in rows.where("k = 'hot'").rdd.glom().collect()]
    assert sum(sizes) == 1000 and len(sizes) == 4 and min(sizes) > 100


def test_profile_tells_nulls_apart_and_shuffles_no_values(spark):
    nan = float("nan")
    rows = [(None, "a", None, 0.0), ("a", None, None, -0.0), (None, "a", None, -0.0), ("a", None, nan, 0.0), ("a", None, nan, -0.0), ("", "a", None, 0.0), (None, "a", 0.0, None)]
    df = spark.createDataFrame(rows, "s string, t string, x double, y double")
    r = profile(df).first()
    assert (r["rows"], r["duplicates"]) == (7, 2) == tuple(duplicate_rows(df).first())
    assert r["nulls"] == {"s": 3, "t": 3, "x": 6, "y": 1}
    whole = profile(df.withColumn("m", F.create_map("t", "x")).where("t IS NOT NULL")).first()
    assert (whole["rows"], whole["duplicates"]) == (4, 1)
    wide = spark.range(20_000).select(F.lit("f").alias("f"), F.sha2(F.col("id").cast("string"), 512).alias("value"))
    profiled = profile(wide, ["f"]).select("rows", "duplicates")
    plan = profiled._jdf.queryExecution().executedPlan().toString()
    assert not any("value#" in line for line in plan.splitlines() if "hashpartitioning" in line)
    assert profiled.first() == (20_000, 0)


def test_profile_of_a_hot_copy(spark):
    df = spark.createDataFrame([("x", None)] * 1000 + [(str(i), "y") for i in range(500)], "a string, b string")
    r = profile(df.repartition(8)).first()
    assert (r["rows"], r["duplicates"], r["nulls"]) == (1500, 999, {"a": 0, "b": 1000})


def test_published_profile_adds_up(spark):
    """The null cells of the published profile are the sum over its columns."""
    nulls = spark.createDataFrame([({"jackpot": 1_071_543, "max_multiplier": 213_814, "game": 0},)], "nulls map<string,long>")
    from tablewright.functions import map_total

    assert nulls.select(map_total("nulls")).first()[0] == 1_285_357


def test_row_counts_and_keys(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "k string")
    assert tuples(row_counts({"one": df, "two": df.limit(1)})) == [("one", 4), ("two", 1)]
    assert tuples(key_violations(df, "k")) == [("a", 2), (None, 1)]
    assert not same_rows(df, df.limit(2))


CONTRACT = Contract("t", "k", (
    Field("k", T.StringType(), 3), Field("n", T.IntegerType()), Field("r", T.DecimalType(6, 2)),
))


def test_contract_casts_and_orders(spark):
    df = spark.createDataFrame([(12.345, "abc", 7), (None, None, None)], "r double, k string, n long")
    out = apply_contract(df, CONTRACT)
    assert out.dtypes == [("k", "string"), ("n", "int"), ("r", "decimal(6,2)")]
    assert [str(v) for v in out.where("k is not null").first()] == ["abc", "7", "12.35"]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("row", [(12345.678, "a", 1), (1.0, "abcd", 1), (1.0, "a", 2**40)])
def test_contract_fails_on_a_value_that_does_not_fit(spark, row, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([row], "r double, k string, n long")
        with pytest.raises(Exception, match="does not fit"):
            apply_contract(df, CONTRACT).collect()
        assert sum(r["violations"] for r in contract_violations(df, CONTRACT).collect()) == 1
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


@pytest.mark.parametrize("hot", [0, 4000])
def test_distinct_rows_in_buckets(spark, hot):
    """Nulls, both zeros and NaN count as they do in a plain dedup, also beside a row that fills buckets."""
    values = [None, 0.0, -0.0, float("nan"), 1.5]
    rows = [(f"k{i % 37}" if i % 5 else None, None if i % 7 == 0 else i % 3, values[i % 5]) for i in range(3000)]
    rows += [("hot", 1, 2.0)] * hot
    df = spark.createDataFrame(rows, "__row string, b int, c double").repartition(5)
    got = distinct_rows_in_buckets(df, shuffled_bytes=0, buckets=3)
    assert got.columns == df.columns
    key = lambda r: str(r).replace("-0.0", "0.0")
    assert sorted(map(key, got.collect())) == sorted(map(key, distinct_rows(df).collect()))
    assert sorted(map(key, distinct_rows_in_buckets(df).collect())) == sorted(map(key, got.collect()))
    assert distinct_rows_in_buckets(df.limit(0)).collect() == []


def test_distinct_rows_in_buckets_shuffles_only_heavy_rows(spark, tmp_path):
    """Rows go into buckets once; only the copies of a heavy row meet by a shuffle, one row per task."""
    df = spark.range(20_000).selectExpr("id % 15000 AS a", "CAST(id % 15000 AS string) AS b").unionByName(
        spark.range(20_000).selectExpr("CAST(-1 AS bigint) AS a", "'x' AS b"))
    got = distinct_rows_in_buckets(df, shuffled_bytes=0, buckets=4)
    assert got.count() == 15_001
    plan = got._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    light = plan.split("Union")[1]
    assert light.count("Exchange") == 1 and "Bucketed: true" in plan
