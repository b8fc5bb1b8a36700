"""A training corpus from the ``documents`` table: five stages, each written as
Parquet and read again as the documents of the next.

Every stage treats null, empty and repeated rows as its operator's docstring
says; columns beyond those of ``documents`` are dropped at the start.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import bpe, jaccard_join, line_dedup, mixing, shared, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
MIX_BUDGET_PERCENT = 90     # of the tokens that reach the mixing stage
MIX_EPOCHS = 1              # every document at most once
TOKENIZER = "word_bpe_49k.json"


def _remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    shared.lean_workers(spark)
    docs = docs.select(*COLUMNS)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.train(docs, labels))


def _dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go; a document that lost all its lines goes too."""
    out = line_dedup.line_dedup(docs)
    return (out.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
            .withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long"))
                        .otherwise(F.col("n_chars")))
            .select(*COLUMNS))


def _one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-duplicates by five-word shingles at 0.8: of each group the document
    with the smallest id stays (rows without an id come last).  Rows are told
    apart by their place in the table, so of repeated rows one stays, and two
    texts under one id are two documents.  Texts without words all stay.
    ``docs`` is a stored table: both scans number its rows alike."""
    shared.lean_workers(spark)
    rows = docs.withColumn("_row", F.monotonically_increasing_id())
    groups = jaccard_join.jaccard_join(rows.select(F.col("_row").alias("doc_id"), "text"), k=5, percent=80)
    places = shared.written(
        rows.select("_row", F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "_row").alias("place"))
        .join(groups.select(F.col("doc_id").alias("_row"), "component_id"), "_row"), "near-duplicate-places")
    first = places.groupBy("component_id").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1")
    gone = shared.written(places.join(first, "component_id").where("place != first").select("_row"),
                          "near-duplicates")
    return rows.join(gone, "_row", "left_anti").select(*COLUMNS)


def _mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights."""
    mixed = mixing.mix(docs, budget_percent=MIX_BUDGET_PERCENT, max_epochs=MIX_EPOCHS)
    return mixed.select(*COLUMNS)


def _tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids."""
    shared.lean_workers(spark)
    return bpe.encode(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", _remove_toxic),
    ("line_dedup", _dedup_lines),
    ("jaccard_join", _one_of_each),
    ("mixing", _mix),
    ("bpe", _tokens),
]

# A trained classifier, near-duplicates of whole texts and BPE are not
# expressible in SQL; tests/llm holds run() against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus: ``documents`` through all stages."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = shared.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
