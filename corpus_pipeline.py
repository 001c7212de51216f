"""From raw documents to packed training sequences, stage by stage.

Defined results: null ids and repeated ids are rows like any other, told apart by their texts;
null and empty texts have no language and end at the first stage; an empty table gives no
rows; other columns go along to the stage before packing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewire.llm.common import table
from tidewire.llm.decontaminate import clean_documents
from tidewire.llm.exact_dedup import drop_index, fresh_index, kept_documents
from tidewire.llm.language_id import identified_documents
from tidewire.llm.ngram_join import one_of_each_group
from tidewire.llm.packing import placed_pieces
from tidewire.plans.durable import durable


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: no letters, or no dictionary fits better."""
    return identified_documents(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each text."""
    index = fresh_index(spark)
    kept = kept_documents(docs, index)
    drop_index(index)  # decisions are stored by now
    return kept


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of similar texts."""
    return one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts documents into pieces and places them in sequences."""
    return placed_pieces(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("ngram_join", ngram_join),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Dictionaries, edit distances and tokenizers have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is a table in the shared folder before the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
