"""Stored annotator responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from morphloom.schemas import DOC_ORDER, require_columns
from morphloom.sources.texts import required_id


def responses(
    df: DataFrame,
    id_col: str = "doc_id",
    json_col: str = "response",
    order_col: str | None = None,
) -> DataFrame:
    """A table of stored response JSON, so that no annotator has to run again.

    A NULL id stops the job.
    """
    require_columns(df, id_col, json_col, *([order_col] if order_col else []))
    cols = [
        required_id(id_col),
        F.col(json_col).cast("string").alias("response"),
    ]
    if order_col:
        cols.append(F.col(order_col).alias(DOC_ORDER))
    return df.select(*cols)
