"""The corpus pipeline: stages over the documents, each written as Parquet and read again as the next one's input.

Defined cases: a null, empty or short text fails the quality rules and goes; rows without a doc_id stay, as no component can name them, and are mixed like others; of rows that repeat a
doc_id one stays; a null source is a source; further columns pass through to the last stage, which returns its own columns; an empty table gives no rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from recordloom.llm import mixing, ngram_join, pieces, quality
from recordloom.llm.common import documents, release, stored
from recordloom.llm.queries import tokenizer_file


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the production policy keeps."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares word shingles, the one of the smallest id."""
    return ngram_join.one_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document."""
    return pieces.encode_documents(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources", source_mix),
    ("SentencePiece", encoded),
]

#: The duels of the mix and the pieces have no SQL form; tests hold run() against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. A stage's input is deleted once its result is written."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        kept = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
        release(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
