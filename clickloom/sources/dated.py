"""Tables that grow by micro-batches, for years.

New rows lie in ``open``, in a folder per load date and batch. A batch written again replaces its own
folders, so a repeated batch doubles nothing. Dates that get no more rows are closed: rewritten into a few
large files below ``closed`` and then listed in ``dates``. Rows that come for a closed date all the same lie
in ``open`` until the next close merges them: the whole date is written anew below ``merged`` and listed with
the number of the merge. Readers take closed dates from where they are listed last, without the batches that
``open`` has of them, and all else from ``open``, so they see every row once before, while and after a date is
closed, and what they list grows with the open dates and with one entry per closed date, not with the number
of batches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE, BATCH, MERGE = "ingest_date", "batch", "merge"
_CLOSED_FILE_ROWS = 10_000_000


def _file_system(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def open_folder(spark: SparkSession, path: str) -> str:
    """Where new batches lie; made if it isn't there, so that a stream can start on it."""
    files, place = _file_system(spark, f"{path}/open")
    files.mkdirs(place)
    return f"{path}/open"


def write_batch(df: DataFrame, path: str, batch: str | None = None, partitions: Sequence[str] = (DATE,)) -> None:
    """Write a batch to its folders and replace what they hold.

    ``batch`` names it; without a name, ``df`` brings a column of that kind, and all rows of each batch.
    """
    if batch is not None:
        df = df.withColumn(BATCH, F.lit(batch))
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions, BATCH).parquet(f"{path}/open")


def waiting_files(spark: SparkSession, folder: str, most: int) -> list[str]:
    """Files in a folder, the oldest first, at most so many; hidden ones are still being written."""
    files, place = _file_system(spark, folder)
    found = [s for s in files.listStatus(place) if s.isFile() and s.getPath().getName()[0] not in "._"] if files.exists(place) else []
    found.sort(key=lambda s: (s.getModificationTime(), s.getPath().toString()))
    return [s.getPath().toString() for s in found[:most]]


def move_files(spark: SparkSession, paths: Sequence[str], folder: str) -> None:
    """Move files into a folder, under names that begin with their times."""
    files, place = _file_system(spark, folder)
    files.mkdirs(place)
    for path in paths:
        files, source = _file_system(spark, path)
        name = f"{files.getFileStatus(source).getModificationTime()}-{source.getName()}"
        target = spark._jvm.org.apache.hadoop.fs.Path(place, name)
        if not files.rename(source, target):
            raise OSError(f"could not move {path} to {folder}")


def open_batches(spark: SparkSession, path: str, partitions: Sequence[str] = (DATE,), only: dict[str, str] | None = None) -> set[tuple]:
    """Partition values and names of the batches that lie in ``open``, from the names of their folders alone."""
    names = [*partitions, BATCH]
    files, place = _file_system(spark, "/".join([path, "open", *(f"{n}={(only or {}).get(n, '*')}" for n in names)]))
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    found = set()
    for status in files.globStatus(place) or []:
        parts = status.getPath().toString().split("/")[-len(names) :]
        found.add(tuple(unescape(part.partition("=")[2]) for part in parts))
    return found


def closed_batches(spark: SparkSession, path: str, schema: T.StructType, dates: Sequence[str], partitions: Sequence[str] = (DATE,)) -> set[tuple]:
    """The same of those of ``dates`` that are closed, from their files."""
    merges = {d: n for d, n in _merges(spark, path).items() if str(d) in set(dates)}
    if not merges:
        return set()
    return {tuple(map(str, x)) for x in _batches(_read_closed(spark, path, schema, merges), partitions)}


def remove_batches(spark: SparkSession, path: str, batches: Sequence[tuple], partitions: Sequence[str] = (DATE,)) -> None:
    """Remove open batches, named as by ``open_batches``."""
    _remove_batches(spark, f"{path}/open", [list(zip([*partitions, BATCH], x)) for x in batches])


def _merges(spark: SparkSession, path: str) -> dict:
    """Closed dates, each with the last merge into it; 0 for none."""
    if not exists(spark, f"{path}/dates"):
        return {}
    listed = spark.read.schema(f"{DATE} date, {MERGE} long").parquet(f"{path}/dates")
    return {row[0]: row[1] for row in listed.groupBy(DATE).agg(F.max(F.coalesce(MERGE, F.lit(0)))).collect()}


def closed_dates(spark: SparkSession, path: str) -> list:
    """Closed dates, one for each day at most."""
    return list(_merges(spark, path))


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _among(dates) -> Column:
    return F.coalesce(F.col(DATE).isin(list(dates)), F.lit(False))


def _read_closed(spark: SparkSession, path: str, schema: T.StructType, merges: dict) -> DataFrame:
    """The rows of closed dates, from the folders of the merges given."""
    out = _read(spark, f"{path}/closed", schema).where(_among(d for d, n in merges.items() if n == 0))
    places = [f"{d}/{n}" for d, n in merges.items() if n > 0]
    if not places:
        return out
    merged = _read(spark, f"{path}/merged", T.StructType([*schema.fields, T.StructField(MERGE, T.LongType())]))
    place = F.concat_ws("/", F.col(DATE).cast("string"), F.col(MERGE).cast("string"))
    return out.unionByName(merged.where(place.isin(places)).drop(MERGE))


def _with_late(old: DataFrame, late: DataFrame, keys: list, partitions: Sequence[str]) -> DataFrame:
    """Rows of closed dates with those that came after the close; a batch written again replaces itself."""
    if not keys:
        return old
    names = [*partitions, BATCH]
    again = old.sparkSession.createDataFrame(keys, T.StructType([late.schema[c] for c in names]))
    return old.join(F.broadcast(again), names, "left_anti").select(late.columns).unionByName(late)


def _batches(rows: DataFrame, partitions: Sequence[str]) -> list:
    return [tuple(row) for row in rows.select(*partitions, BATCH).distinct().collect()]


def read_dated(spark: SparkSession, path: str, schema: T.StructType, partitions: Sequence[str] = (DATE,)) -> DataFrame:
    """All rows. ``schema`` names the partition columns too."""
    # Open files are listed before the closed dates: a date closed in between is in at least one of them.
    new = _read(spark, f"{path}/open", schema)
    merges = _merges(spark, path)
    if not merges:
        return new
    late = new.where(_among(merges))
    old = _with_late(_read_closed(spark, path, schema, merges), late, _batches(late, partitions), partitions)
    return new.where(~_among(merges)).unionByName(old)


def close_dates(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    before: str,
    partitions: Sequence[str] = (DATE,),
    waiting: Callable[[DataFrame], list] | None = None,
) -> list:
    """Close the open dates before ``before`` and merge what came for closed ones; these dates are returned.

    ``waiting`` says of the open rows due which dates must wait. The large files are complete before the
    dates are listed, and a run that stops in between is simply repeated. The batches that were rewritten,
    and no others, are removed last, as are the files that a merge replaces.
    """
    if not exists(spark, f"{path}/open"):
        return []
    # Whatever is written after this listing is neither rewritten nor removed.
    rows = _read(spark, f"{path}/open", schema)
    merges = _merges(spark, path)
    due = rows.where(_among(merges) | (F.col(DATE) < F.lit(before).cast("date")))
    wait = set(waiting(due)) if waiting else set()
    at = list(partitions).index(DATE)
    batches = [x for x in _batches(due, partitions) if x[at] not in wait]
    dates = {x[at] for x in batches}
    first, again = dates - set(merges), {d: n for d, n in merges.items() if d in dates}
    number = max(merges.values(), default=0) + 1

    def write(df: DataFrame, place: str, mode: str) -> None:
        writer = df.hint("rebalance", *partitions).write.mode("overwrite")
        writer = writer.option("partitionOverwriteMode", mode).option("maxRecordsPerFile", _CLOSED_FILE_ROWS)
        writer.partitionBy(*partitions).parquet(place)

    if first:
        write(due.where(_among(first)), f"{path}/closed", "dynamic")
    if again:
        late, keys = due.where(_among(again)), [x for x in batches if x[at] in again]
        whole = _with_late(_read_closed(spark, path, schema, again), late, keys, partitions)
        write(whole, f"{path}/merged/{MERGE}={number}", "static")
    if dates:
        listed = [*((d, 0) for d in first), *((d, number) for d in again)]
        listed = spark.createDataFrame(listed, f"{DATE} date, {MERGE} long")
        listed.coalesce(1).write.mode("append").parquet(f"{path}/dates")
    names = [*partitions, BATCH]
    _remove_batches(spark, f"{path}/open", [list(zip(names, x)) for x in batches])
    for date, n in again.items():
        for folder in _date_folders(spark, f"{path}/merged/{MERGE}={n}" if n else f"{path}/closed", date, partitions):
            files, folder = _file_system(spark, folder)
            files.delete(folder, True)
    return sorted(dates)


def _remove_batches(spark: SparkSession, path: str, batches: list[list[tuple]]) -> None:
    """Remove the folders of batches, and those of dates that hold no others."""
    naming = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    parents = set()
    for parts in batches:
        names = [naming.getPartitionPathString(name, str(value)) for name, value in parts]
        files, folder = _file_system(spark, "/".join([path, *names]))
        files.delete(folder, True)
        parents.add("/".join([path, *names[:-1]]))
    for parent in parents:
        files, folder = _file_system(spark, parent)
        if files.exists(folder) and not files.listStatus(folder):
            files.delete(folder, False)


def _date_folders(spark: SparkSession, path: str, date, partitions: Sequence[str]) -> list[str]:
    files, top = _file_system(spark, path)
    levels = [top] if files.exists(top) else []
    for _ in range(list(partitions).index(DATE)):
        levels = [s.getPath() for level in levels for s in files.listStatus(level) if s.isDirectory()]
    folders = [spark._jvm.org.apache.hadoop.fs.Path(level, f"{DATE}={date}") for level in levels]
    return [folder.toString() for folder in folders if files.exists(folder)]


def in_batches(write: Callable[[DataFrame, str], None], label: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that hands on each batch with its name: label and number."""

    def run(df: DataFrame, number: int) -> None:
        write(df, f"{label}-{number:010d}")

    return run
