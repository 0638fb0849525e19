"""How filters interact in every order of application.

A document is a mask of the filters that it fails. What happens to one document of a mask in every
order and at every step is one big integer, whose fields hold 0 or 1 for each (order, step); sums
of such integers, weighted by the documents of each mask, hold the counts of all steps at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import Store
from tablewright.session import ship_with_tasks

# Bits of a field: every count of rows is below 2^63, so no field overflows into the next.
FIELD = 64
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
# Tasks over which the rows without an id are spread when labels are joined.
SPREAD = 1024


class Fields:
    """Packed outcomes of every mask in every order of the filters ``letters``."""

    def __init__(self, letters: str) -> None:
        self.letters = letters
        self.orders = ["".join(p) for p in permutations(sorted(letters))]
        bit = {c: 1 << i for i, c in enumerate(letters)}
        self.kept, self.removed, self.redundant = [], [], []
        for mask in range(1 << len(letters)):
            fields: tuple[list[int], list[int], list[int]] = ([], [], [])
            for order in self.orders:
                gone = False
                for c in order:
                    fails = bool(mask & bit[c])
                    fields[1].append(fails and not gone)
                    fields[2].append(fails and gone)
                    gone = gone or fails
                    fields[0].append(not gone)
            for packed, outcome in zip((self.kept, self.removed, self.redundant), fields):
                packed.append(sum(1 << FIELD * i for i, x in enumerate(outcome) if x))
        self.size = len(self.orders) * len(letters)

    def unpack(self, packed: int) -> list[int]:
        data = packed.to_bytes(self.size * FIELD // 8, "little")
        return [int.from_bytes(data[i : i + FIELD // 8], "little") for i in range(0, len(data), FIELD // 8)]

    def rows(self, masks: Sequence[tuple[int, int, int, int]]) -> Iterator[tuple[str, int, tuple[int, ...]]]:
        """``(order, step, counts)`` of one part; ``masks`` has rows (mask, documents, good, toxic)."""
        kept = removed = redundant = good = toxic = 0
        alone = dict.fromkeys(self.letters, 0)
        for mask, n, g, t in masks:
            kept += n * self.kept[mask]
            removed += n * self.removed[mask]
            redundant += n * self.redundant[mask]
            good += g * self.removed[mask]
            toxic += t * self.removed[mask]
            if mask and not mask & (mask - 1):
                alone[self.letters[mask.bit_length() - 1]] += n
        columns = [self.unpack(x) for x in (kept, removed, redundant, good, toxic)]
        steps = [(order, step, c) for order in self.orders for step, c in enumerate(order, 1)]
        shapley = dict.fromkeys(self.letters, 0)
        for (_, _, c), n in zip(steps, columns[1]):
            shapley[c] += n
        for (order, step, c), k, r, x, g, t in zip(steps, *columns):
            yield order, step, (k, r, x, alone[c], g, t, shapley[c])


def audit(rows: DataFrame, letters: str, part: str = "part") -> DataFrame:
    """Counts of every step of every order of filters, for each part.

    ``rows`` has ``part``, ``mask`` (bit i: fails the filter ``letters[i]``), ``n`` (documents),
    ``good`` and ``toxic`` (of those). One row per part, ``filter_order`` and ``step``, zeros
    included; a null part is the empty one. Rows are summed by part and mask before they move, so a
    part of any size is at most 2^filters rows. An empty table gives no rows.
    """
    fields = Fields(letters)
    sums = rows.groupBy(F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col("mask").cast("int").alias("mask")).agg(
        *(F.sum(c).cast("bigint").alias(c) for c in ("n", "good", "toxic")))
    parts = sums.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, masks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out = list(fields.rows([(m["mask"], m["n"], m["good"], m["toxic"]) for m in masks]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(out), pa.string()), pa.array([o for o, _, _ in out]), pa.array([s for _, s, _ in out], pa.int32()),
                     *(pa.array(c, pa.int64()) for c in zip(*(counts for _, _, counts in out)))],
                    names=["part", "filter_order", "step", *COUNTS],
                )

    return parts.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in COUNTS))


def text_filters(text: Column) -> dict[str, Column]:
    """The conditions under which a text fails; null is the empty text.

    A: under 200 words; B: less than half of the words are different; C: more than 2 % of the
    characters are A-Z; D: a character of ``#$%&*|``. Words are runs without ASCII white space.
    """
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, r"[ \t-\r]+"), "")
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals > 2 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def document_masks(documents: DataFrame, labels: DataFrame, store: Store | None = None) -> DataFrame:
    """``part``, ``mask``, ``n``, ``good``, ``toxic`` for :func:`audit`, over ``doc_id, text, source``.

    Filters A to D are :func:`text_filters`; E fails a document whose text is also that of a smaller
    ``doc_id`` anywhere in the table. Rows of one id and text do not fail each other, and a row
    without an id neither fails E nor makes another fail. A document with several labels is good
    (toxic) if one of them says so; one without an id or label is neither. Texts are compared by
    their SHA-256. Equal rows are counted before they move, so copies gather nowhere.
    """
    tests = text_filters(F.col("text"))
    bits = sum((test.cast("int") * (1 << i) for i, test in enumerate(tests.values())), F.lit(0))
    rows = documents.select(
        F.col("doc_id").alias("id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), bits.alias("mask"),
        F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)).alias("h"),
    ).groupBy("h", "mask", "part", "id").agg(F.count("*").alias("n"))
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        *(F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(k) for c, k in (("quality", "good"), ("toxic", "toxic")))
    ).withColumn("s", F.lit(0))
    spread = F.when(F.col("id").isNull(), F.crc32("h") % SPREAD).otherwise(0).cast("int")
    marked = rows.withColumn("s", spread).join(marks, ["id", "s"], "left").select(
        "h", "mask", "part", "id", "n", *(F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("good", "toxic")))
    # Of each text and part: how many, and how many of them have the smallest id.
    some = (store or Store(documents.sparkSession)).put(marked.groupBy("h", "mask", "part", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
        F.min("id").alias("least"), F.min_by("n", "id").alias("at_least")), "masks")
    first = some.groupBy("h").agg(F.min("least").alias("first"))
    same = some.join(first, "h")
    free = F.col("nameless") + F.when(F.col("least") == F.col("first"), F.col("at_least")).otherwise(0)
    last = 1 << len(tests)
    split = F.explode(F.array(F.struct(F.col("mask"), free.alias("n")), F.struct((F.col("mask") + last).alias("mask"), (F.col("n") - free).alias("n"))))
    return same.select("part", "good", "toxic", split.alias("x")).where("x.n > 0").select(
        "part", "x.mask", "x.n", *((F.col(c) * F.col("x.n")).alias(c) for c in ("good", "toxic")))


ship_with_tasks(__name__)
