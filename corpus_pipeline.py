"""The corpus pipeline: language, quality, near-duplicates, mix, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulcra.llm.apportion import mixed_documents
from pulcra.llm.language_mixture import keep_identified
from pulcra.llm.line_frequency import remove_common_lines_rejects
from pulcra.llm.near_text import keep_first
from pulcra.llm.packing import pack_documents
from pulcra.operators.lookup import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identified language go."""
    return keep_identified(spark, docs)


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that too many others hold go, and documents that fail the rules or consist of such lines."""
    return remove_common_lines_rejects(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as much of them, as their source's share of the mix asks for."""
    return mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids, placed in sequences."""
    return pack_documents(docs)


STAGES = [
    ("language", identify_language),
    ("quality", filter_quality),
    ("near_duplicates", drop_near_duplicates),
    ("mix", mix_sources),
    ("packing", pack),
]

# The stages hash, encode and fit models: no SQL of another engine gives their rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
