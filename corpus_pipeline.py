"""Cleaning a corpus into training sequences: five stages over ``documents``.

Each stage calls one operator of ``tripstream.llm``; its result is written as Parquet
and read back as the next stage's documents. All but the last return the columns of
``documents``; the last returns the packed pieces.

Defined cases: a document with a null, empty or letterless text has no language and goes in
the first stage; a null lang, source or n_chars is carried as it is (n_chars follows a text
that was redacted); a null doc_id is an id like any other; rows that are equal, or copies, are
one after the second stage; texts of any length are read whole; further columns of
``documents`` are carried to the last stage whatever their names; an empty table of documents
gives no pieces, an empty benchmark removes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstream.llm import decontaminate, language, packing, pii, simhash
from tripstream.llm.common import staged, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose language stays in doubt, go."""
    return language.kept(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return simhash.survivors(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts gives way to its kind in brackets; n_chars follows the text."""
    return pii.redacted(docs).withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their sequence and offset."""
    return packing.pack(docs)


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("decontaminate", drop_benchmark_leaks),
    ("personal_data", redact_personal_data),
    ("packing", pack),
]

#: tokenizing and the fitted models are beyond SQL; tests/llm/test_pipeline.py has a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
