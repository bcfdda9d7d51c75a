"""From raw documents to token files: five stages over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pagestrata.llm.common import stored, table
from pagestrata.llm.language import accepted, fit
from pagestrata.llm.minhash import one_of_each
from pagestrata.llm.mixing import take
from pagestrata.llm.templates import without_leaks
from pagestrata.llm.tokens import token_digests, write_token_files

#: Documents go whose language nobody could name: no letters, or every language unlikely.
MIN_SCORE = 0.35
#: Documents of this similarity (in percent, by 5-word shingles) or more are one.
SIMILAR = 80
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network, fitted on the labelled ones, can tell."""
    return accepted(docs, fit(docs), MIN_SCORE)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return one_of_each(docs, SIMILAR)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights: rows are left out or repeated."""
    return take(docs)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order of ids, read back: a digest of each document."""
    return token_digests(write_token_files(docs, TOKENIZER))


STAGES = [
    ("language", known_language),
    ("near_duplicates", deduplicated),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("token_files", tokenized),
]

#: Byte networks, minimum hashing and token files have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each one's rows written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
