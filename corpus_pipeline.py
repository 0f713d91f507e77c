"""The corpus pipeline: toxicity, near duplicates, secrets, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before left; all but the
last return the columns of ``documents``. ``run`` writes each stage's rows as Parquet to the
shared folder and reads them again for the next. ``ORACLE_SQL`` is None, as SQL can't express the stages;
the tests hold them against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from graniteloom.llm import jaccard, mixing, packing, secrets, toxicity
from graniteloom.llm.common import Scratch, documents

#: Documents whose score is at least this are rejected (the query's own threshold reports, it doesn't discard).
REJECT = 0.5


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity machine doesn't reject; it learns from the labelled rows that aren't held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~toxicity.held_out())
    model = toxicity.fit(*toxicity.training_rows(docs, labels, "doc_id", "text", "toxic"))
    free = "score"
    while free in docs.columns:
        free += "_"
    return toxicity.score(docs, model, into=free).where(F.col(free) < REJECT).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of every group of near duplicates."""
    return jaccard.deduplicated(docs)


def secrets_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark, the count of characters brought up to date."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxic_out),
    ("near_duplicates", near_copies_out),
    ("secrets", secrets_out),
    ("source_mixing", mixed),
    ("packing", packed),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    rows, scratch = documents(spark, sf_dir), Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        rows = scratch.keep(stage(spark, rows, sf_dir), name)
    return STAGES[-1][1](spark, rows, sf_dir)
