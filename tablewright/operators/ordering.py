"""Sorted reports, top-k and stable random samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewright.operators.enrich import attach_stats
from tablewright.session import materialise


# Hexadecimal digits that one round of the selection tells apart: 65,536 counters a group.
ROUND_DIGITS = 4
# A bucket of so few rows, or of as many as are wanted, is small enough to be sorted.
SMALL_BUCKET = 10_000


def ranked(df: DataFrame, metric: str, tie: str, nulls_first: bool = False) -> DataFrame:
    """Descending by ``metric``; equal metrics ascend by ``tie``."""
    down = F.desc_nulls_first(metric) if nulls_first else F.desc_nulls_last(metric)
    return df.orderBy(down, F.asc_nulls_first(tie))


def top_k(df: DataFrame, metric: str, k: int, tie: str, nulls_first: bool = False) -> DataFrame:
    """The first ``k`` rows of :func:`ranked`; every task keeps only ``k`` rows."""
    return ranked(df, metric, tie, nulls_first).limit(k)


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """Any ``n`` rows, for a look at a table."""
    return df.limit(n)


def sample_digest(identity: Sequence[str], seed: int) -> Column:
    """Random-looking text that depends only on the row's identity and the seed."""
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in identity], F.lit(str(seed))))


def _selected(tagged: DataFrame, n: int, grouped: bool) -> DataFrame:
    """Rows up to the bucket of digests that holds the ``n``-th smallest of their group.

    A radix selection: every round counts the rows of the bucket found so far by the next digits
    of their digest, and so finds a bucket 65,536 times smaller. It ends when the bucket of every
    group is small or holds one digest only: one round up to 10^8 rows, two up to 10^13.
    """
    state = None
    depth = 0
    mark = F.xxhash64("__digest")  # numbers are aggregated by hash, text only by sorting
    while True:
        depth += ROUND_DIGITS
        rows = tagged
        if state is not None:
            rows = _with_limits(tagged, state, grouped).where(~F.col("__done") & F.col("__digest").startswith(F.col("__last")))
            rows = rows.select("__group", "__digest")
        counts = rows.groupBy("__group", F.substring("__digest", 1, depth).alias("__bucket")).agg(
            F.count("*").alias("__n"), F.min(mark).alias("__low"), F.max(mark).alias("__high"))
        if state is None:
            counts = counts.withColumn("__need", F.lit(n))
        elif not grouped:
            counts = counts.withColumn("__need", F.lit(state["__need"]))
        else:
            counts = counts.join(state.select("__group", "__need"), "__group")
        # At most 65,536 rows a group.
        along = Window.partitionBy("__group").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
        reached = counts.withColumn("__earlier", F.coalesce(F.sum("__n").over(along), F.lit(0))).groupBy("__group").agg(
            F.max(F.when(F.col("__earlier") < F.col("__need"), F.struct("__bucket", "__n", "__low", "__high", (F.col("__need") - F.col("__earlier")).alias("__need")))).alias("x"),
            F.sum("__n").alias("__size"),
        )
        small = (F.col("x.__n") <= max(n, SMALL_BUCKET)) | (F.col("x.__low") == F.col("x.__high"))
        found = reached.select("__group", F.col("x.__bucket").alias("__last"), F.col("x.__need").alias("__need"), small.alias("__done"), "__size")
        if not grouped:  # one row, or none of an empty table
            state = found.first()
            if state is None:
                return tagged.limit(0)
            if depth >= 32 or state["__done"]:
                break
            continue
        if state is not None:
            known = state.select("__group", F.col("__size").alias("__all"), F.col("__last").alias("__old"), F.col("__need").alias("__left"), F.col("__done").alias("__was"))
            found = known.join(found.drop("__size"), "__group", "left").select(
                "__group", F.coalesce("__last", "__old").alias("__last"), F.coalesce("__need", "__left").alias("__need"),
                F.coalesce("__done", "__was").alias("__done"), F.col("__all").alias("__size"))
        state = materialise(found, "sample_limits")
        if depth >= 32 or state.where("NOT __done").isEmpty():
            break
    near = _with_limits(tagged, state, grouped)
    # A prefix that ends a round earlier than others is compared over its own length.
    return near.where(F.substr("__digest", F.lit(1), F.length("__last")) <= F.col("__last")).select(*tagged.columns)


def _with_limits(tagged: DataFrame, state: DataFrame | Row, grouped: bool) -> DataFrame:
    if grouped:
        return attach_stats(tagged, state.select("__group", "__last", "__done", "__size"), "__group", "__size")
    return tagged.withColumn("__last", F.lit(state["__last"])).withColumn("__done", F.lit(state["__done"]))


def stable_sample(df: DataFrame, n: int, identity: Sequence[str] | None = None,
                  seed: int = 42, by: str | None = None) -> DataFrame:
    """Random sample of ``n`` rows, or of ``n`` rows per value of ``by``.

    The sample is the ``n`` rows with the smallest digest, so it does not depend on the
    partitioning. ``df`` is read once in every round of :func:`_selected` and once at the end, so
    pass a written table.

    Only rows up to the bucket in which ``n`` are reached go on: ``n`` rows and one small bucket,
    not ``n`` rows from every task. Equal rows are then counted, not sorted, so a hot group of
    copies is one row.
    """
    names = df.columns
    if n < 1:
        return df.limit(0)
    tagged = df.withColumn("__digest", sample_digest(identity or names, seed))
    group = F.lit("all") if by is None else F.coalesce(
        F.concat(F.lit("="), F.col(by).cast("string")), F.lit("null")
    )
    near = _selected(tagged.withColumn("__group", group), n, by is not None)

    ordered = Window.partitionBy("__group").orderBy("__digest", *names)
    before = F.coalesce(
        F.sum("__copies").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    return (
        near.groupBy("__group", "__digest", *names).agg(F.count("*").alias("__copies"))
        .withColumn("__before", before)
        .where(F.col("__before") < n)
        .withColumn("__take", F.least(F.col("__copies"), F.lit(n) - F.col("__before")))
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__take").cast("int"))))
        .select(*names)
    )
