"""From raw documents to training tokens: quality, exact and near duplicates, mix, tokens.

Each stage gets what the one before it kept. The last gives the tokens of the mix.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickloom.llm.bpe import encoded, read_ranks
from tickloom.llm.exact_dedup import without_duplicates
from tickloom.llm.mixing import mixed
from tickloom.llm.near_dedup import without_near_duplicates
from tickloom.llm.quality import accepted
from tickloom.llm.queries import quality_left_out, table
from tickloom.llm.text import stored

VOCABULARY = "byte_bpe_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, trained on the labels of all documents, accepts."""
    raw = table(spark, sf_dir, "documents")
    return accepted(docs, table(spark, sf_dir, "labels"), quality_left_out, learn_from=raw)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the largest id."""
    return without_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id."""
    return without_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as their source's target weight asks for."""
    return mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang and token_ids of every document of the mix."""
    ranks = read_ranks(public_tokenizers.path(VOCABULARY))
    return encoded(docs.select("doc_id", "source", "lang", "text"), ranks, text=False)


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("mix", mix), ("tokens", tokens)]

# A learned classifier, MinHash and byte pair merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source, lang and token_ids of every document of the mix, from ``documents`` and ``labels``.

    A null text scores and counts as empty and has no tokens, nulls in other columns are values like any
    other, rows that repeat id and text are one document, a text without words is in no mix. Other
    columns of ``documents``, whatever their names, go through all stages but the last. Empty tables give no row.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
