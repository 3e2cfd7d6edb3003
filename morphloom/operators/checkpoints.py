"""Keep a costly intermediate result."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder for checkpoints, that of ``spark.checkpoint.dir``, which on a cluster is
    shared. Only a local session without that setting gets a temporary folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
            "spark.checkpoint.dir"
        )
        if folder is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="checkpoint-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage, on storage that outlives executors.

    Checkpoints go to :func:`checkpoint_folder`. With
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` set to ``true`` Spark removes
    the files once no DataFrame refers to them any more.
    """
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def store(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Compute ``df`` once and read it back from Parquet files, by the columns that are needed.

    For a table with a row per morpheme these are a small part of what a checkpoint of
    its rows takes (:func:`materialize`). They lie in a folder of their own below
    :func:`checkpoint_folder`, which Spark does not remove by itself.
    """
    path = f"{checkpoint_folder(df.sparkSession)}/rows_{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
