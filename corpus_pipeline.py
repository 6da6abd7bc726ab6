"""Corpus pipeline: documents to a training mix, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents. All but the
last return the columns of ``documents``.

Nulls and edge cases are those of the operators: documents without words go
in the first stage, as do all that fail its policy; of a class of near
duplicates (and of repeated rows) one row stays; unlike texts under one doc_id,
or under null ids, are judged each by itself in every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from postlens.llm.common import read_table
from postlens.llm.op3_mixing import mix_documents
from postlens.llm.op4_probminhash import keep_one
from postlens.llm.op5_secrets import redact
from postlens.llm.op6_quality_rules import keep_clean
from postlens.llm.op9_decontaminate import drop_leaks
from postlens.session import delete_path, new_scratch_dir


# Rows in an Arrow batch: texts are long, and a batch is held several times.
BATCH_ROWS = 1024


def _small_batches(spark: SparkSession) -> None:
    """Batches of BATCH_ROWS rows at most for the session's jobs from here on, as a
    stage's plan runs when its result is written."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the production policy keeps."""
    _small_batches(spark)
    return keep_clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return keep_one(spark, docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark question."""
    _small_batches(spark)
    return drop_leaks(spark, docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind."""
    return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix with their epochs, tokens and texts taken."""
    _small_batches(spark)
    return mix_documents(spark, docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("decontaminate", decontaminate),
    ("secrets", secrets),
    ("mixing", mixing),
]

# ProbMinHash and template matching can't be written in SQL: tested against
# brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table.

    A stage's folder goes when the next one is written; the last one stays,
    as the result is read from it.
    """
    docs = read_table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        path = new_scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete_path(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
