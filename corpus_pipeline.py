"""The corpus pipeline: documents to token counts, by five of the text operators.

Each stage is a function of (spark, docs, sf_dir); what it returns is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents. As a stage's result has
been written when the next is called, each begins by deleting the work tables of the one that its thread
called before.

Defined results, of all stages: null texts count as empty; an empty table gives an empty result; rows with
equal doc_id are rows of their own; other columns, whatever their names, pass through but for ``text`` and
``n_chars`` of what the mix takes in part."""

from __future__ import annotations

import functools
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm import bpe, common, dartminhash, exact_dedup, langid, mixing

_before = threading.local()


def _stage(f: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    @functools.wraps(f)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for path in getattr(_before, "paths", ()):
            common.remove(spark, path)
        _before.paths = []
        common.tidy(spark)  # what finished stages left in memory and as shuffle files
        common.release()
        with common.gathering(_before.paths):
            return f(docs)

    return stage


@_stage
def language(docs: DataFrame) -> DataFrame:
    """Documents in a known language; those without a letter (null and empty texts, too) or of no clear language go."""
    return langid.accepted_documents(docs)


@_stage
def exact(docs: DataFrame) -> DataFrame:
    """Of equal texts the one with the largest doc_id; of repeated rows the last in storage."""
    return exact_dedup.kept_documents(docs)


@_stage
def near(docs: DataFrame) -> DataFrame:
    """Of each class of near-duplicates the document with the least doc_id; null ids last."""
    return dartminhash.kept_documents(docs)


@_stage
def mix(docs: DataFrame) -> DataFrame:
    """The mix of sources: a document as often as it is taken, and the words of its partial take; texts without a word go."""
    return mixing.mixed_documents(docs)


@_stage
def encode(docs: DataFrame) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    return bpe.token_digests(docs, apart=True, most=300_000)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("mixing", mix),
    ("byte_bpe", encode),
]

#: SQL can't express the classifier, the signatures or the merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
