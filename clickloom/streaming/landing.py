"""Streaming ingestion: messages to lake files, lake files to the raw table.

Both steps write each micro-batch to folders of its own (``sources.dated``). A failed batch is run again
under the same number, over the same input and at the same recorded time, and replaces what its first try
left; so each step is exactly-once, without a log of all files ever written. A batch without rows writes
nothing.

A file source's own list of files seen lies in the checkpoint and grows by a line per file. It may be dropped
by starting with a new checkpoint: batches are named after it, messages that were landed are moved out of
the inbox, and loading a lake batch once more replaces it in the raw table. Folders of files need no such list:
``land_files`` moves what it has landed, and ``load_batches`` compares the folders of the lake's open batches with
those the raw table has, so nothing but the tables themselves is kept from run to run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.sources.dated import (
    BATCH,
    DATE,
    close_dates,
    closed_batches,
    in_batches,
    move_files,
    open_batches,
    read_dated,
    waiting_files,
    write_batch,
)
from clickloom.sources.messages import EVENT, MAX_FILES, parse_messages
from clickloom.sources.raw import (
    LAKE_PARTITIONS,
    LAKE_SCHEMA,
    MAX_BATCHES,
    RAW_TABLE_SCHEMA,
    arrived_files,
    file_paths,
    open_lake,
    read_batches,
    with_file,
    with_load_metadata,
)

# Fixed value: the longest wait before a micro-batch is taken.
TRIGGER_INTERVAL = "10 seconds"


def start(
    stream: DataFrame, write: Callable[[DataFrame, str], None], checkpoint: str, continuous: bool
) -> StreamingQuery:
    """Hand every batch to ``write`` with its name: every ten seconds, or once over everything available."""
    label = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]
    writer = stream.writeStream.foreachBatch(in_batches(write, label)).option("checkpointLocation", checkpoint)
    if continuous:
        return writer.trigger(processingTime=TRIGGER_INTERVAL).start()
    return writer.trigger(availableNow=True).start()


def start_table(
    stream: DataFrame, path: str, checkpoint: str, continuous: bool, partitions: Sequence[str] = ()
) -> StreamingQuery:
    """Write every batch of a stream to a table of batches below ``path``."""
    return start(
        stream, lambda df, batch: write_batch(df, path, batch, partitions), checkpoint, continuous
    )


def land_messages(
    messages: DataFrame,
    lake: str,
    checkpoint: str,
    continuous: bool = True,
    loaded_at: Column | None = None,
) -> StreamingQuery:
    """Write a message stream to the lake, by kind (event or dead letter), local load date and batch."""
    return start_table(parse_messages(messages, loaded_at), lake, checkpoint, continuous, LAKE_PARTITIONS)


def land_files(spark: SparkSession, inbox: str, lake: str, archive: str, max_files: int = MAX_FILES) -> int:
    """Land the text files of a folder and move them to ``archive``; their number is returned.

    A file is a batch: named after its path and time, and loaded at that time. So a file that was landed and not
    yet moved when a run stopped is landed once more in place of itself, and nothing has to be remembered. Files
    appear in the inbox whole, by renaming.
    """
    landed = 0
    while paths := waiting_files(spark, inbox, max_files):
        arrived = F.col("_metadata.file_modification_time")
        name = F.md5(F.concat_ws("|", F.col("_metadata.file_path"), arrived.cast("string")))
        lines = spark.read.text(paths).select("value", name.alias(BATCH), arrived.alias("arrived"))
        write_batch(parse_messages(lines, F.col("arrived"), keep=[BATCH]), lake, partitions=LAKE_PARTITIONS)
        move_files(spark, paths, archive)
        landed += len(paths)
    return landed


def keep_landing(spark: SparkSession, inbox: str, lake: str, archive: str, checkpoint: str, max_files: int = MAX_FILES) -> StreamingQuery:
    """Land new files every ten seconds, by the same clock as ``keep_loading``."""
    return _on_clock(spark, lambda session: land_files(session, inbox, lake, archive, max_files), checkpoint)


def batch_counts(lake: DataFrame) -> DataFrame:
    """Messages received, written as events and set aside, for every batch ever landed.

    Counted from the lake itself, by its partition columns, so nothing is lost with a query's progress.
    """
    written = F.count_if(F.col("kind") == EVENT)
    received = F.count(F.lit(1))
    return lake.groupBy("batch").agg(
        received.alias("received"), written.alias("written"), (received - written).alias("malformed")
    )


def autoload(
    lake_files: DataFrame,
    lake: str,
    raw: str,
    checkpoint: str,
    continuous: bool = True,
    loaded_at: Column | None = None,
) -> StreamingQuery:
    """Load new lake batches into the raw table, each under its name in the lake.

    The stream says which batches have new files; these are loaded whole, in place of what the raw table
    has of them. A batch of many files comes in several micro-batches: files that were loaded with the first of
    them are passed over in the others, so every batch is loaded once. A stream that is started again may load
    the batch it was in once more.
    """
    ahead: set[str] = set()  # files loaded with their batch that the stream has not come to yet

    def load(arrived: DataFrame, _: str) -> None:
        spark = arrived.sparkSession
        files = arrived_files(arrived)
        batches = sorted({place for file, place in files.items() if file not in ahead})
        if batches:
            rows = read_batches(spark, lake, batches)
            loaded = file_paths(rows)
            write_batch(with_load_metadata(rows, loaded_at), raw)
            ahead.update(loaded)
        ahead.difference_update(files)

    return start(with_file(lake_files), load, checkpoint, continuous)


def unloaded_batches(spark: SparkSession, lake: str, raw: str) -> list[tuple[str, str]]:
    """Load date and name of the event batches in the lake that the raw table lacks, in order.

    Folders are listed and no file is read, but for dates that are closed in the raw table already and open in
    the lake: of these, late batches may have come, and the closed files say which are there.
    """
    landed = {x[1:] for x in open_batches(spark, lake, LAKE_PARTITIONS, {"kind": EVENT})}
    landed -= open_batches(spark, raw)
    dates = sorted({date for date, _ in landed})
    return sorted(landed - closed_batches(spark, raw, RAW_TABLE_SCHEMA, dates)) if landed else []


def load_batches(
    spark: SparkSession, lake: str, raw: str, max_batches: int = MAX_BATCHES, loaded_at: Column | None = None
) -> int:
    """Load what the raw table lacks of the lake, ``max_batches`` batches in one step; their number is returned.

    A batch appears in the raw table by one renaming of its folder, so a run that stops leaves whole batches only,
    and the next one loads the rest.
    """
    batches = unloaded_batches(spark, lake, raw)
    for at in range(0, len(batches), max_batches):
        write_batch(with_load_metadata(read_batches(spark, lake, batches[at : at + max_batches]), loaded_at), raw)
    return len(batches)


def keep_loading(spark: SparkSession, lake: str, raw: str, checkpoint: str, max_batches: int = MAX_BATCHES) -> StreamingQuery:
    """Load new batches every ten seconds."""
    return _on_clock(spark, lambda session: load_batches(session, lake, raw, max_batches), checkpoint)


def _on_clock(spark: SparkSession, work: Callable[[SparkSession], int], checkpoint: str) -> StreamingQuery:
    """Run ``work`` every ten seconds. The stream is a clock; its checkpoint holds the last hundred ticks."""
    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()

    def tick(batch: DataFrame, _: str) -> None:
        work(batch.sparkSession)

    return start(clock, tick, checkpoint, continuous=True)


def unloaded_dates(lake: DataFrame, raw: str) -> list:
    """Dates of which the raw table lacks an event batch of these lake rows."""
    batches = lake.where(F.col("kind") == EVENT).select(DATE, BATCH).distinct()
    dates = [row[0] for row in batches.select(DATE).distinct().collect()]
    loaded = read_dated(lake.sparkSession, raw, RAW_TABLE_SCHEMA).where(F.col(DATE).isin(dates))
    missing = batches.join(loaded.select(DATE, BATCH).distinct(), [DATE, BATCH], "left_anti")
    return [row[0] for row in missing.select(DATE).distinct().collect()]


def compact(spark: SparkSession, lake: str | None, raw: str | None, before: str) -> dict[str, list]:
    """Close the dates before ``before`` in the raw table and then the lake.

    A date with a lake batch that isn't in the raw table yet waits in both; a later run closes it. The lake
    is closed together with its raw table only.
    """
    if lake is not None and raw is None:
        raise ValueError("a lake can't be closed without the raw table that shows what was loaded")
    closed = {}
    if raw is not None:
        waiting = None if lake is None else lambda _: unloaded_dates(open_lake(spark, lake), raw)
        closed["raw"] = close_dates(spark, raw, RAW_TABLE_SCHEMA, before, waiting=waiting)
    if lake is not None:
        closed["lake"] = close_dates(
            spark, lake, LAKE_SCHEMA, before, LAKE_PARTITIONS, lambda rows: unloaded_dates(rows, raw)
        )
    return closed
