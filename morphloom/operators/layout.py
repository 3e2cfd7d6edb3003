"""Tables of lattices and trees whose sentences lie together."""

from __future__ import annotations

from pyspark.sql import DataFrame

from morphloom.operators.runs import can_pack, pack, unpack
from morphloom.schemas import key_columns, require_columns

# Without it, a shuffle's files stay until the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def store_by_sentence(
    df: DataFrame, table: str, buckets: int, path: str | None = None, mode: str = "error"
) -> DataFrame:
    """Write an exploded table bucketed by document and sentence, and read it back.

    Two tables of the same number of ``buckets`` need no exchange to be put together by
    :func:`attach_dependencies` and :func:`alignment_report` with ``co_located``. Buckets
    are by sentence and not by document, so a document that holds a third of all rows is
    spread over them. The rows are shuffled once, packed by sentence (:func:`pack`), to one
    file per bucket, each sorted by place. The shuffle's files go when the table is written.

    ``table`` is a name in the catalog; with ``path`` the files go there, else to the
    warehouse. ``mode`` is that of Spark's writers.
    """
    require_columns(df, "doc_id", "sentence_id", "position")
    keys = [*key_columns(df), "sentence_id"]
    writer = (
        _dealt_out(df, buckets, keys)
        .write.mode(mode)
        .format("parquet")
        .option("compression", "zstd")
        .bucketBy(buckets, *keys)
        .sortBy(*keys, "position")
    )
    if path is not None:
        writer = writer.option("path", path)
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        writer.saveAsTable(table)
    finally:
        if before is None:
            conf.unset(_CLEANUP)
        else:
            conf.set(_CLEANUP, before)
    return df.sparkSession.table(table)


def _dealt_out(df: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """``df.repartition(n, *keys)``, with neighbouring rows of the same keys as one."""
    if not can_pack(df):
        return df.repartition(n, *keys)
    rest = [f for f in df.schema if f.name not in keys]
    return unpack(pack(df, keys).repartition(n, *keys), rest, keys).select(*df.columns)
