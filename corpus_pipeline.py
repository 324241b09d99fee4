"""Corpus pipeline: quality selection, exact and near deduplication, benchmark
decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; every stage but the
last returns the columns of ``documents``.  Between stages the rows are written as
Parquet and read again, so a stage neither repeats its predecessors' work nor holds
their lineage.  Stages work on what the stages before them kept; tables besides
``documents`` (labels, benchmark) come from ``sf_dir``."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from forgeline.llm import decontaminate, exact_dedup, importance, jaccard_join, packing
from forgeline.llm.common import read
from forgeline.session import ensure_checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return importance.keep_selected(docs, read(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    return exact_dedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays."""
    return jaccard_join.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark items go."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, placed in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality),
    ("exact_dedup", exact),
    ("ngram_jaccard_join", near),
    ("benchmark_decontamination", decontaminated),
    ("best_fit_packing", packed),
]
ORACLE_SQL = None  # the classifier and the tokenizer have no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    rows = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, rows, sf_dir).write.parquet(path)
        rows = spark.read.parquet(path)
    return rows
