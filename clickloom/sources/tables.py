"""Parquet tables in shared storage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_local_folder = os.path.join(tempfile.gettempdir(), "clickloom-scratch")


def use_local_folder(path: str) -> None:
    """Name the folder of intermediate tables for local runs without ``spark.checkpoint.dir``."""
    global _local_folder
    _local_folder = path


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate tables, reachable from every executor.

    A local run without the setting uses the local folder; a cluster must name one.
    """
    folder = spark.conf.get(_CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"{_CHECKPOINT_DIR} is not set: name a folder all executors can reach")
    return _local_folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nobody else writes to."""
    return f"{shared_dir(spark)}/clickloom/{name}-{uuid.uuid4().hex}"


def write_table(
    df: DataFrame, path: str, partition_by: str | None = None, rebalance: bool = False
) -> DataFrame:
    """Replace a table and return it as read back.

    ``rebalance`` is for a partition column with many values: rows of a value are brought together,
    large values being split into several files, so that not every task writes a file per value.
    """
    if rebalance and partition_by:
        df = df.hint("rebalance", partition_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return read_table(df.sparkSession, path, df.schema)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Scan a table. With the schema given, an empty partitioned table reads as no rows."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a relation with several consumers once.

    Each consumer then scans only the columns it needs, and a lost executor costs a re-read instead
    of a recomputation from the raw messages.
    """
    return write_table(df, fresh_path(df.sparkSession, name))
