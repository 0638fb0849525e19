"""A corpus of documents through filters and dedup to token ids; every stage reads what the last one wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import decontaminate, jaccard, pieces, suffixes, toxicity
from tablewright.llm.common import Store, free_name, numbered
from tablewright.llm.queries import TOKENIZER, TOXIC_FROM, TOXIC_FOLDS, TOXIC_HELD, held_out


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold.

    The model learns from the labels outside of the held-out fold. Rows without an id or a text
    are scored like any other; repeated rows stay repeated.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels.where(~held_out(TOXIC_FOLDS, TOXIC_HELD)))
    score = free_name(docs, "__score")
    return toxicity.mark(docs, model, score).where(F.col(score) < TOXIC_FROM).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the row with the smallest id; one without an id only if none has one.

    Rows are compared by their text alone, so different texts of one id, or without an id, all stay.
    Of rows with the same smallest id, one is taken by a hash of all columns. Rows without words have
    no copies and stay.
    """
    row = free_name(docs, "__row")
    rows = numbered(docs, Store(spark), row)
    groups = jaccard.join(rows.select(F.col(row).alias("doc_id"), "text")).select(F.col("doc_id").alias(row), "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64(*docs.columns), F.col(row).alias("row"))
    first = groups.join(rows.select(row, order.alias("o")), row).groupBy("component_id").agg(F.min("o").alias("o"))
    return rows.join(first.select(F.col("o.row").alias(row)), row, "left_semi").select(*docs.columns)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of long strings that occur earlier; documents left empty stay, empty."""
    return suffixes.deduplicate(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``lang``, ``source`` and the token ids of every document that is left."""
    kept = docs.select("doc_id", "lang", "source", "text")
    return pieces.encode(kept, pieces.Vocabulary.load(TOKENIZER))


STAGES = [
    ("toxicity", without_toxic),
    ("ngram_jaccard_join", one_of_each_group),
    ("suffix_array_dedup", without_repeats),
    ("benchmark_decontamination", without_benchmark),
    ("sentencepiece", tokens),
]

# The stages learn a model, walk suffix arrays and search a lattice: none of it is SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each is written as Parquet and read again."""
    store = Store(spark)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        documents = store.put(stage(spark, documents, sf_dir), name)
    return documents
