"""Fixed schemas and constants of the morpheme data model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

# Lattice and dependency columns, in the order of the text format.
MD_COLUMNS = ("from", "to", "token", "lemma", "cpostag", "postag", "feats", "token_id")
DEP_COLUMNS = ("id", "token", "lemma", "cpostag", "postag", "feats", "head", "deprel")

# Columns of the two formats that hold integers.

# Fields of an annotator response.
RESPONSE_FIELDS = ("ma_lattice", "md_lattice", "dep_tree", "segmented_text")

# Part-of-speech tags of content words.
CONTENT_POS = ("NN", "NNT", "NNP", "VB", "JJ", "RB")

# Fixed value: tags of punctuation start with this.
PUNCT_PREFIX = "yy"

# Optional column that tells apart, and orders, documents sharing a doc_id.
DOC_ORDER = "doc_order"

DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.StringType(), False),
        T.StructField("text", T.StringType(), True),
    ]
)

MORPHEME_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.StringType()),
        T.StructField("sentence_id", T.IntegerType()),
        T.StructField("token_id", T.IntegerType()),
        T.StructField("token", T.StringType()),
        T.StructField("lemma", T.StringType()),
        T.StructField("pos", T.StringType()),
        T.StructField("xpos", T.StringType()),
        T.StructField("feats", T.StringType()),
    ]
)

DEPENDENCY_SCHEMA = T.StructType(
    MORPHEME_SCHEMA.fields
    + [
        T.StructField("head_token_id", T.IntegerType()),
        T.StructField("deprel", T.StringType()),
    ]
)


def empty_parse(spark: SparkSession, dependency: bool = False) -> DataFrame:
    """A morpheme table without rows (8 columns, 10 with dependencies)."""
    return spark.createDataFrame([], DEPENDENCY_SCHEMA if dependency else MORPHEME_SCHEMA)


def key_columns(df: DataFrame) -> list[str]:
    """The columns that identify one input document in ``df``."""
    return ["doc_id"] + ([DOC_ORDER] if DOC_ORDER in df.columns else [])


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing column(s) {missing}; the table has {df.columns}")
