"""Corpus pipeline: documents in, packed training sequences out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyframe.llm import stages
from tallyframe.llm.frames import stage, table

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", stages.keep_known_languages),
    ("order_minhash", stages.keep_one_of_each_group),
    ("suffix_dedup", stages.remove_repeated_passages),
    ("decontamination", stages.remove_benchmark_documents),
    ("packing", stages.pack_sequences),
]

#: Model fitting, sketches and packing have no SQL form; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
    return docs
