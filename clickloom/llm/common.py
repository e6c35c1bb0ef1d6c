"""Helpers the operators share: table access, Arrow output in bounded batches, widths of work."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, which parts words in every operator here. Fixed values.
SPACE = " \t\n\x0b\x0c\r"
#: A word, as a Java regular expression. Fixed value.
WORD = r"[^\x20\x09-\x0D]+"

_BATCH_BYTES = 8 << 20
_BATCH_ROWS = 4096
#: Copies of a row that a task makes at most.
_COPIES = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``df.mapInArrow(run, schema)``, with input batches of the size of output batches (a longer row is a batch of its own).

    Workers outlive a task: what one has freed goes back to the system at its end.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(_BATCH_ROWS))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(_BATCH_BYTES))

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return df.mapInArrow(bounded, schema)


def release_memory() -> None:
    """Give freed memory of this process back to the system, where its C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def emit(rows: Iterable[tuple], schema: pa.Schema, weight: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of some 8 MB, whatever the input's batches hold."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += weight(row)
        if size >= _BATCH_BYTES or len(held) >= _BATCH_ROWS:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    arrays = [pa.array(column, field.type) for column, field in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once, however often ``body`` names it.

    Inside a lambda an outer expression would be evaluated for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else untouched."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fresh_name(taken: Iterable[str], name: str) -> str:
    """A column name that no given column has, not even in other case."""
    used = {x.lower() for x in taken}
    while name.lower() in used:
        name += "_"
    return name


def each_copy(grouped: DataFrame, copies: str, number: str) -> DataFrame:
    """A row for each of the ``copies`` of every row of a written table, with its ``number`` from 1, instead of their count.

    A row with very many copies is spread over tasks before they are made.
    """
    chunk = fresh_name([*grouped.columns, number], "chunk")
    chunks = F.sequence(F.lit(0).cast("long"), F.floor((F.col(copies) - 1) / _COPIES))
    spread = grouped.withColumn(chunk, F.explode(chunks))
    if (grouped.agg(F.max(copies).alias("n")).first()["n"] or 0) > _COPIES:
        spread = spread.repartition(shuffle_partitions(grouped.sparkSession), *[c for c in grouped.columns if c != copies], chunk)
    last = F.least(F.col(copies), (F.col(chunk) + 1) * _COPIES)
    return spread.withColumn(number, F.explode(F.sequence(F.col(chunk) * _COPIES + 1, last))).drop(chunk, copies)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Largest set of keys that is sent to every executor; beyond it both sides are shuffled.
BROADCAST_BYTES = 64 << 20


def join_keys(df: DataFrame, keys: DataFrame, on: str | list[str], how: str, key_bytes: int = 32) -> DataFrame:
    """Join with a written table of rows with distinct keys, which are counted first.

    Within the bound the keys are broadcast and ``df`` stays in place; a larger set is joined by shuffle.
    """
    if keys.count() * key_bytes <= BROADCAST_BYTES:
        keys = F.broadcast(keys)
    return df.join(keys, on, how)
