"""Session settings the jobs rely on."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Runtime settings, safe to set on a session somebody else created.
RUNTIME_CONF = {
    # Every wall-clock value in the tables is UTC.
    "spark.sql.session.timeZone": "UTC",
    # Adaptive execution coalesces small shuffle partitions, splits skewed join partitions and
    # re-plans joins from measured sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Shredded variants: each JSON key becomes a Parquet column, so a query that needs three keys
    # reads three columns and its filters reach the scan.
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.inferShreddingSchema": "true",
    "spark.sql.variant.pushVariantIntoScan": "true",
    # The last of several equal keys in a message counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Streaming sessions: merge the minutes of a busy user before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

_MIB = 1024 * 1024
_SHUFFLE_PARTITION_BYTES = 256 * _MIB
# The blocks of a shuffle are map tasks times partitions: beyond some 25 TB partitions grow instead
# of becoming more (1 GiB each at 100 TB; sorts and aggregates spill what does not fit).
_MAX_SHUFFLE_PARTITIONS = 100_000
_LARGE_INPUT_BYTES = 10 * 1024 * 1024 * _MIB


def sizing(input_bytes: int) -> dict[str, str]:
    """Runtime settings for a job over ``input_bytes``; adaptive execution merges what turns out small."""
    partitions = -(-input_bytes // _SHUFFLE_PARTITION_BYTES)
    scan_bytes = 512 * _MIB if input_bytes > _LARGE_INPUT_BYTES else 128 * _MIB
    return {
        "spark.sql.shuffle.partitions": str(min(max(8, partitions), _MAX_SHUFFLE_PARTITIONS)),
        "spark.sql.files.maxPartitionBytes": str(scan_bytes),
    }


def input_bytes(df: DataFrame) -> int:
    """Size of what a frame scans, as the planner knows it: for files, the sum of their sizes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, for sessions that run without it installed there.

    The same as ``spark-submit --py-files``. Needed by operators that run Python in tasks; the clickstream part does not.
    """
    package = os.path.dirname(os.path.abspath(__file__))
    parent, name = os.path.split(package)
    folder = tempfile.TemporaryDirectory(prefix="clickloom-")  # the driver serves the file from here until it ends
    atexit.register(folder.cleanup)
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(folder.name, name), "zip", parent, name))


def build_session(app_name: str = "clickloom", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session; pass ``master`` only for local runs, a cluster names its own."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())
