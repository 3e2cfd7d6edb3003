"""Document tables: ``doc_id STRING, text STRING``."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from morphloom.schemas import DOC_ORDER, DOCUMENT_SCHEMA, require_columns


def required_id(id_col: str) -> Column:
    """``doc_id``, which is never NULL: a row without id stops the job when it is read."""
    missing = F.raise_error(F.lit(f"NULL in {id_col}: every row needs an id")).cast("string")
    return F.coalesce(F.col(id_col).cast("string"), missing).alias("doc_id")


def documents(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    order_col: str | None = None,
) -> DataFrame:
    """Any table with an id and a text column as a document table.

    Works on every Spark source, batch or streaming. Ids become strings, other
    columns are dropped (so they are not read). A NULL id stops the job.

    A ``doc_id`` may occur more than once: each row is analysed by itself and the
    copies count as one document afterwards. Give ``order_col`` when that happens:
    it must differ between rows with the same id, and orders their tokens. It is
    carried along as ``doc_order`` and keeps the copies apart in every grouping, so
    that a heavily repeated id does not pile up in one task.
    """
    require_columns(df, id_col, text_col, *([order_col] if order_col else []))
    cols = [
        required_id(id_col),
        F.col(text_col).cast("string").alias("text"),
    ]
    if order_col:
        cols.append(F.col(order_col).alias(DOC_ORDER))
    return df.select(*cols)


def documents_from_strings(
    spark: SparkSession,
    texts: Iterable[str] | Mapping[str, str],
    names: Iterable[str] | None = None,
) -> DataFrame:
    """A few strings from the driver as a document table.

    Without names, or if any name is empty or missing, the ids are ``text1``,
    ``text2`` and so on. For real data volumes read a table and use
    :func:`documents`.
    """
    if isinstance(texts, (str, bytes)):
        raise TypeError("texts must be a list or a mapping of strings, not one string")
    if isinstance(texts, Mapping):
        names, values = list(texts.keys()), list(texts.values())
    else:
        values = list(texts)
        names = None if names is None else list(names)
    if not all(v is None or isinstance(v, str) for v in values):
        raise TypeError("texts must be strings")
    if names is not None and len(names) != len(values):
        raise ValueError(f"{len(names)} names for {len(values)} texts")
    if names is None or any(not n for n in names):
        names = [f"text{i}" for i in range(1, len(values) + 1)]
    return spark.createDataFrame(list(zip(names, values)), DOCUMENT_SCHEMA)


def spread_small(df: DataFrame) -> DataFrame:
    """Spread an input that is too small to occupy the cluster.

    A file of a single row group is read by one task however many cores there
    are. If Spark's estimate of the input is below one full file split per core,
    the rows are dealt out round-robin; moving that little data is cheap. A larger
    input already has more splits than cores and is left as it is: no shuffle.
    """
    if df.isStreaming or not hasattr(df, "_jdf"):
        return df
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(2 * cores) if size < cores * split else df
