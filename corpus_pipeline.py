"""The training-data pipeline: documents through language ID, near-dedup, secret scans, mixing and packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each result as Parquet to the shared
folder and reads it back as the next stage's docs. All but the last return the columns of documents. What a stage makes of
nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names is said in cuewise.llm.stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cuewise.llm import stages
from cuewise.llm.common import read, scratch, table
from cuewise.llm.queries import tokenizer_path


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents without a language go, a missing lang is filled in."""
    return stages.language(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: one document of each group of near copies stays."""
    return stages.near_dedup(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: secrets give way to a mark."""
    return stages.secret_scan(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: each document as many times as the mix takes it."""
    return stages.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: the pieces of all sequences."""
    return stages.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", dedup_stage),
    ("secret_scans", secrets_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch(spark) as keep:  # what a stage has written beside its result goes
            docs = keep(table(stage(spark, docs, sf_dir), name))
    return docs


#: Classification, shingles and token ids are not expressible in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None
