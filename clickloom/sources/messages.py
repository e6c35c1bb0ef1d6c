"""JSON messages: text files or a Kafka topic, one message per row in ``value``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions import ingest_date

EVENT = "event"
DEAD_LETTER = "dead_letter"


# Bounds of a micro-batch unless told otherwise: a backlog is worked off in steps.
MAX_FILES = 1000
MAX_OFFSETS = 1_000_000


def stream_text(
    spark: SparkSession,
    path: str,
    max_files: int = MAX_FILES,
    max_bytes: str | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Stream of the lines of text files, new files being picked up as they arrive.

    A micro-batch takes ``max_files`` files, or, where given, up to ``max_bytes`` of them. With
    ``archive``, files are moved there once they are landed, so that the inbox to be listed stays small.
    """
    reader = spark.readStream.format("text")
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    else:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def stream_kafka(
    spark: SparkSession, servers: str, topic: str, max_offsets: int = MAX_OFFSETS, **options: str
) -> DataFrame:
    """Stream of a topic's message values (needs the Spark Kafka connector on the class path)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("maxOffsetsPerTrigger", max_offsets)
        .options(**options)
    )
    return message_values(reader.load())


def message_values(records: DataFrame) -> DataFrame:
    """The text of a queue's records; a record without a value is an empty message."""
    return records.select(F.coalesce(F.col("value").cast("string"), F.lit("")).alias("value"))


def parse_messages(messages: DataFrame, loaded_at: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Parse each message on its own; text that is not JSON is kept as a dead letter.

    Columns: ``raw_data`` (variant, null for dead letters), ``raw_text`` (dead letters only),
    ``loaded_at``, ``kind``, ``ingest_date`` and those to ``keep``. A record keeps exactly the keys it came with.
    """
    loaded_at = F.current_timestamp() if loaded_at is None else loaded_at
    readable = F.col("raw_data").isNotNull()
    return (
        messages.select(
            F.try_parse_json(F.col("value")).alias("raw_data"), "value", loaded_at.alias("loaded_at"), *keep
        )
        .select(
            "raw_data",
            F.when(~readable, F.col("value")).alias("raw_text"),
            "loaded_at",
            F.when(readable, EVENT).otherwise(DEAD_LETTER).alias("kind"),
            ingest_date(F.col("loaded_at")).alias("ingest_date"),
            *keep,
        )
    )
