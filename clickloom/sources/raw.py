"""The lake of landed messages, and the raw table: one variant per message with load metadata."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.schemas import RAW_SCHEMA
from clickloom.sources.dated import DATE, open_folder, read_dated
from clickloom.sources.messages import EVENT

_BATCH = T.StructField("batch", T.StringType())
LAKE_SCHEMA = T.StructType(
    [
        T.StructField("raw_data", T.VariantType()),
        T.StructField("raw_text", T.StringType()),
        T.StructField("loaded_at", T.TimestampType()),
        T.StructField("kind", T.StringType()),
        T.StructField("ingest_date", T.DateType()),
        _BATCH,
    ]
)
RAW_TABLE_SCHEMA = T.StructType([*RAW_SCHEMA.fields, _BATCH])

LAKE_PARTITIONS = ("kind", DATE)

# Batches of the lake that are loaded in one step.
MAX_BATCHES = 1000

# Files of a micro-batch unless told otherwise: a backlog is worked off in steps.
MAX_FILES = 1000


def with_load_metadata(lake: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Raw rows of lake files: the message, its file, its row in the file, and the load time."""
    return lake.where(F.col("kind") == EVENT).select(
        "raw_data",
        F.col("_metadata.file_path").alias("metadata_filename"),
        F.col("_metadata.row_index").alias("metadata_file_row_number"),
        (F.current_timestamp() if loaded_at is None else loaded_at).alias("loaded_at"),
        "ingest_date",
        "batch",
    )


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    return read_dated(spark, path, LAKE_SCHEMA, LAKE_PARTITIONS)


def open_lake(spark: SparkSession, path: str) -> DataFrame:
    """Lake rows of dates, and late batches, that aren't closed yet."""
    return spark.read.schema(LAKE_SCHEMA).parquet(open_folder(spark, path))


def stream_lake(spark: SparkSession, path: str, max_files: int = MAX_FILES) -> DataFrame:
    """Stream of lake files as they are landed."""
    reader = spark.readStream.schema(LAKE_SCHEMA).option("maxFilesPerTrigger", max_files)
    return reader.parquet(open_folder(spark, path))


def read_batches(spark: SparkSession, path: str, batches: list[tuple[str, str]]) -> DataFrame:
    """The event files of open batches of the lake, each named by load date and batch."""
    folder = f"{path}/open"
    paths = [f"{folder}/kind={EVENT}/ingest_date={date}/batch={batch}" for date, batch in batches]
    return spark.read.schema(LAKE_SCHEMA).option("basePath", folder).parquet(*paths)


def with_file(lake_files: DataFrame) -> DataFrame:
    """Of the rows of lake files only where they lie: ``kind``, load date, batch and ``file``."""
    return lake_files.select(*LAKE_PARTITIONS, "batch", F.col("_metadata.file_path").alias("file"))


def arrived_files(arrived: DataFrame) -> dict[str, tuple[str, str]]:
    """Load date and batch of the event files that ``arrived`` (``with_file``) has rows of.

    ``arrived`` holds the files of one micro-batch, so there are no more than these.
    """
    found = arrived.where(F.col("kind") == EVENT).select("file", DATE, "batch").distinct().collect()
    return {_place(row["file"]): (str(row[DATE]), row["batch"]) for row in found}


def file_paths(rows: DataFrame) -> set[str]:
    """The files that ``rows`` was found to lie in when it was made, written as by ``arrived_files``."""
    return {_place(path) for path in rows.inputFiles()}


def _place(path: str) -> str:
    """A file's folders below the lake and its name. Spark writes what comes before in more than one way."""
    return unquote("/".join(path.split("/")[-len(LAKE_PARTITIONS) - 2 :]))


def read_raw(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """Scan the raw table.

    ``since`` (a date) prunes the load-date partitions, for looking at recent messages. Facts must not be
    built from a part of the table: earlier sessions and copies would be missing, and session numbers
    would start anew.
    """
    raw = read_dated(spark, path, RAW_TABLE_SCHEMA).drop("batch")
    return raw if since is None else raw.where(F.col("ingest_date") >= F.lit(since).cast("date"))
