"""The registered queries of this subpackage and, where SQL can express one, its SQL."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

import public_tokenizers

from morphloom.llm import (
    ann_tree,
    bitplane_clusters,
    bpe_automaton,
    common,
    compression_quality,
    k2_search,
    langid,
    licenses,
    mixing,
    pieces,
    repetition,
    simhash,
    suffix_dedup,
    token_blocks,
    training,
)
from morphloom.llm.common import read

# Workers need not have this folder on their path: these functions travel with the job.
for _module in (
    ann_tree,
    bitplane_clusters,
    bpe_automaton,
    common,
    compression_quality,
    k2_search,
    langid,
    licenses,
    mixing,
    pieces,
    repetition,
    simhash,
    suffix_dedup,
    token_blocks,
    training,
):
    cloudpickle.register_pickle_by_value(_module)


# Shares of all tokens that op3 gives to the domains of ``labels``.
MIX = {"good": 0.92, "poor": 0.06, "toxic": 0.02}


def op1_licenses(spark: SparkSession, sf: str) -> DataFrame:
    files = licenses.document_paths(read(spark, sf, "documents"))
    doc_id = F.regexp_extract("path", r"(\d+)(\.txt)?$", 1).cast("long").alias("doc_id")
    return licenses.scan(files).select(doc_id, "*")


def op2_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents")
    return langid.predict(docs, langid.train(docs))


def op3_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents")
    return mixing.mix(docs, mixing.train(docs, read(spark, sf, "labels")), MIX).drop("digest")


def op4_token_blocks(spark: SparkSession, sf: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return token_blocks.round_trip(read(spark, sf, "documents"), tokenizer)


def op5_ann_tree(spark: SparkSession, sf: str) -> DataFrame:
    return ann_tree.search(read(spark, sf, "embeddings"))


def op6_repetition(spark: SparkSession, sf: str) -> DataFrame:
    return repetition.quality(read(spark, sf, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, sf, "documents"))


def op8_compression_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents")
    return compression_quality.score(
        docs, compression_quality.train(docs, read(spark, sf, "labels"))
    )


def op9_pieces(spark: SparkSession, sf: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode_decode(read(spark, sf, "documents"), model)


def op10_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf, "documents"))


def op11_k2_search(spark: SparkSession, sf: str) -> DataFrame:
    return k2_search.search(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


def op12_bpe_automaton(spark: SparkSession, sf: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return bpe_automaton.encode_decode(read(spark, sf, "documents"), tokenizer)


def op13_bitplane_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return bitplane_clusters.clusters(read(spark, sf, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_licenses,
        op2_language_id,
        op3_mixing,
        op4_token_blocks,
        op5_ann_tree,
        op6_repetition,
        op7_suffix_dedup,
        op8_compression_quality,
        op9_pieces,
        op10_simhash,
        op11_k2_search,
        op12_bpe_automaton,
        op13_bitplane_clusters,
    )
}

ORACLES: dict[str, str] = {
    "op6_repetition": repetition.SQL,
    "op7_suffix_dedup": suffix_dedup.SQL,
    "op11_k2_search": k2_search.SQL,
    "op13_bitplane_clusters": bitplane_clusters.sql(),
}
