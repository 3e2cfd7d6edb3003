"""A training corpus from the table ``documents``: five stages, one after the other."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from morphloom.llm import langid, mixing, pieces, simhash, suffix_dedup
from morphloom.llm.common import keep, read

# Of the tokens that the classifier finds in each domain, what is to be left: at most one,
# as a stage that only drops documents can meet no more.
LEFT = {"good": 0.985, "poor": 0.6, "toxic": 0.1}


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language."""
    return langid.identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.one_of_each(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the long strings that an earlier document has."""
    return suffix_dedup.deduplicated(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents thinned out to the weights of the domains."""
    return mixing.thinned(docs, read(spark, sf_dir, "labels"), LEFT)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids of each text and of what they decode to."""
    return pieces.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language ID", languages),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_strings),
    ("mixing sources to target weights", mixed),
    ("SentencePiece encoding and decoding", encoded),
]

# The stages are trained models, connected components and byte strings.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
