"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import inspect
import os
import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Hashable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

# Larger than any id: stands for a NULL doc_id where an order of ids is asked for.
NO_ID = 2**63 - 1

_CACHED = 2


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    Only a local session that does not set it gets a temporary folder.
    """
    conf = spark.sparkContext.getConf()
    base = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="shared-")
    return os.path.join(base, uuid.uuid4().hex)


def keep(df: DataFrame) -> DataFrame:
    """``df`` as a table written to the shared folder: computed once, its lineage cut."""
    folder = shared_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def columns(docs: DataFrame, text: str = "binary") -> DataFrame:
    """``doc_id`` and ``text`` only, so that no other column can clash or be carried."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast(text).alias("text")
    )


def worker_cache(key: Hashable, make: Callable[[], object]):
    """What ``make`` gave for ``key`` in this worker process, made on first use.

    Functions of this subpackage travel by value, so their module globals are new in every
    task. A module of its own outlives the task; Spark hands the worker to the next one.
    Only the last ``_CACHED`` things are held.
    """
    held = sys.modules.setdefault("_morphloom_llm_worker", types.ModuleType("worker")).__dict__
    kept = held.setdefault("kept", {})
    value = kept.pop(key) if key in kept else make()
    kept[key] = value
    while len(kept) > _CACHED:
        del kept[next(iter(kept))]
    return value


def give_back() -> None:
    """Hand memory that this process has freed but still holds back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def tidy(run: Callable) -> Callable:
    """``run``, a function for mapInArrow or applyInArrow, with :func:`give_back` behind it.

    Spark keeps a worker for later tasks, of other stages too. What a task has freed would
    otherwise stay with each of them, on top of what the executor needs by then.
    """

    def stream(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    def group(rows):
        try:
            return run(rows)
        finally:
            give_back()

    def groups(left, right):
        try:
            return run(left, right)
        finally:
            give_back()

    # Spark goes by the number of arguments, so each kind has its own
    two = len(inspect.signature(run).parameters) == 2
    return stream if inspect.isgeneratorfunction(run) else groups if two else group


class Remembered(dict):
    """What ``make`` gives for a key, made once while it is remembered.

    Held are the last ``limit`` to twice as many keys: when the table is full it becomes the
    old one, and what is asked for again is taken over from there. So frequent keys stay.
    """

    def __init__(self, limit: int):
        self.limit, self.old = max(1, limit), {}

    def make(self, key):
        raise NotImplementedError

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """Texts as bytes, NULL as empty."""
    return [x or b"" for x in column.to_pylist()]


def table(batch_schema: pa.Schema, *arrays) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(a, t) for a, t in zip(arrays, batch_schema.types)], schema=batch_schema
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the smallest node that
    is connected with it.

    Alternates between linking the larger and the smaller neighbours of each node to
    the smallest one, until nothing changes. Each round is a written table; a node with
    many links is grouped with map-side minima and joined under the adaptive skew split.
    """
    spark = edges.sparkSession
    edge = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edge = keep(edge.where("a <> b").distinct())

    def state(e):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    before = state(edge)
    while before[0]:
        both = edge.union(edge.select("b", "a")).toDF("a", "b")
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        edge = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).distinct()
        least = edge.groupBy("a").agg(F.min("b").alias("m"))
        rest = edge.join(least, "a").where("b <> m").select(F.col("b").alias("a"), "m")
        edge = keep(rest.union(least).toDF("a", "b").distinct())
        after = state(edge)
        if tuple(after) == tuple(before):
            break
        before = after
    roots = edge.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edge.select("b", "b")).distinct()
