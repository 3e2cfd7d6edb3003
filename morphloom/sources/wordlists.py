"""Stopword lists kept as a table ``lang, source, word``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from morphloom.schemas import require_columns


def stopwords(df: DataFrame, lang: str = "he", source: str = "stopwords-iso") -> DataFrame:
    """The distinct lower-cased words of one list; no rows if there is no such list."""
    require_columns(df, "lang", "source", "word")
    return (
        df.where((F.col("lang") == lang) & (F.col("source") == source))
        .where(F.col("word").isNotNull())
        .select(F.lower("word").alias("word"))
        .distinct()
    )
