"""Joins of a large event table with a dimension.

A dimension is measured once (rows, bytes, null keys). Within the byte bound it is broadcast, and
the events are not shuffled at all. Beyond the bound the join is a shuffled one: rows without a key
are spread over all partitions instead of meeting in one, and adaptive execution splits partitions
of hot keys. It can do so because both sides come straight from a shuffle, without an aggregate on the
join key in between, and every caller shuffles by another key afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.operators import bloom
from clickloom.sources.tables import materialize

MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# In-memory cost of one row of the broadcast hash table on top of its text.
_ROW_OVERHEAD_BYTES = 64


@dataclass(frozen=True)
class Dimension:
    """A dimension with the facts that decide how it is joined."""

    df: DataFrame
    key: str
    rows: int
    bytes: int
    has_null_key: bool
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES

    @property
    def fits_broadcast(self) -> bool:
        return self.bytes <= self.max_broadcast_bytes

    def hinted(self, df: DataFrame | None = None) -> DataFrame:
        """``df`` (a projection of the dimension; default: all of it) with the join hint it earns."""
        df = self.df if df is None else df
        return F.broadcast(df) if self.fits_broadcast else df

    def keys(self) -> DataFrame:
        """Keys without the null key, as often as they occur."""
        return self.df.select(self.key).where(F.col(self.key).isNotNull())

    @cached_property
    def distinct_keys(self) -> DataFrame:
        """Distinct keys without the null key; too many to broadcast, they are written to a table once."""
        distinct = self.keys().distinct()
        return distinct if self.fits_broadcast else materialize(distinct, f"{self.key}-keys")


def _row_bytes(schema: T.StructType) -> Column:
    total: Column = F.lit(_ROW_OVERHEAD_BYTES)
    fields = [(F.col(field.name), field.dataType) for field in schema.fields]
    while fields:
        value, kind = fields.pop()
        if isinstance(kind, T.StructType):
            fields += [(value[field.name], field.dataType) for field in kind.fields]
        elif isinstance(kind, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(value), F.lit(0)) + 8
        else:
            total = total + 16
    return total.cast("bigint")


def measure(
    df: DataFrame,
    key: str,
    columns: Sequence[str] | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> Dimension:
    """Measure a dimension in one aggregate over the columns that joins will carry."""
    if columns is not None:
        df = df.select(*dict.fromkeys([key, *columns]))
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(_row_bytes(df.schema)), F.lit(0)).alias("bytes"),
        F.coalesce(F.max(F.col(key).isNull()), F.lit(False)).alias("has_null"),
    ).first()
    return Dimension(df, key, row["rows"], row["bytes"], row["has_null"], max_broadcast_bytes)


def _spread_key(key: Column, spread_by: Column) -> Column:
    """The key, or for rows without one a throw-away value that differs from row to row."""
    return F.coalesce(key, F.concat(F.lit("\0"), F.xxhash64(spread_by).cast("string")))


def left_lookup(
    events: DataFrame,
    dimension: Dimension,
    key: Column,
    spread_by: str,
    columns: DataFrame | None = None,
    condition: Column | None = None,
) -> DataFrame:
    """Left join ``events`` to a dimension on ``key`` = dimension key, plus an optional condition.

    ``columns`` is the projection of the dimension to join; its key column does not survive.
    Column names must not clash, apart from the key.
    """
    right = dimension.df if columns is None else columns
    right = right.withColumnRenamed(dimension.key, "__dimension_key")
    if dimension.fits_broadcast:
        left_key = key
    else:
        left_key = _spread_key(key, F.col(spread_by))
        condition = key.isNotNull() if condition is None else key.isNotNull() & condition
    on = left_key == F.col("__dimension_key")
    if condition is not None:
        on = on & condition
    return events.join(dimension.hinted(right), on, "left").drop("__dimension_key")


def relevant_keys(parent: Dimension, asked: DataFrame) -> DataFrame:
    """The parent's keys that may be among the ``asked`` ones (a written column of distinct keys).

    The asked keys' Bloom filter goes to the parent's rows; of those that nobody asks for, some thousandth is
    left. Only what is left has to be shuffled to be compared exactly: it holds every asked key the parent has.
    If the filter is too large to broadcast, all keys are returned.
    """
    key = asked.columns[0]
    blocks = bloom.blocks_for(asked.count())
    if blocks * bloom.BLOCK_BYTES > parent.max_broadcast_bytes:
        return parent.keys()
    filter_ = materialize(bloom.build(asked, key, blocks), f"asked-{key}")
    keys = parent.keys().withColumn("__block", bloom.block_of(F.col(parent.key), blocks))
    met = keys.join(F.broadcast(filter_.withColumnRenamed("block", "__block")), "__block")
    return met.where(bloom.may_hold(F.col("words"), F.col(parent.key))).select(parent.key)


def unknown_keys(events: DataFrame, dimension: Dimension, key: Column) -> Dimension:
    """The keys of the events that the dimension does not have, as a measured table.

    Only the distinct keys travel to meet a large dimension. What is left over is mostly few, so the
    events themselves can be flagged by a broadcast.
    """
    keys = events.select(key.alias(dimension.key)).distinct()
    unknown = materialize(without_parent(keys, dimension.key, dimension), f"unknown-{dimension.key}")
    return measure(unknown, dimension.key, max_broadcast_bytes=dimension.max_broadcast_bytes)


def with_unknown_flag(
    events: DataFrame,
    dimension: Dimension,
    key: Column,
    flag: str,
    spread_by: str,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Add the value of ``key NOT IN (dimension keys)`` under SQL's three-valued logic.

    With a null among the dimension keys the test is never true (null where the key is not found).
    The caller decides about null keys; here they are null, or true against an empty dimension.

    A large dimension is not joined to a batch of events: the events' unknown keys are. They are taken
    from ``keys_from``, a cheaper relation with the same keys, where there is one.
    """
    if dimension.rows == 0:
        return events.withColumn(flag, F.lit(True))
    if dimension.fits_broadcast or events.isStreaming:
        joined, found = dimension, dimension.distinct_keys
    else:
        joined = unknown_keys(events if keys_from is None else keys_from, dimension, key)
        found = joined.df
        if joined.rows == 0:
            return events.withColumn(flag, F.when(key.isNotNull(), F.lit(False)))
    marked = left_lookup(events, joined, key, spread_by, columns=found.withColumn("__found", F.lit(True)))
    is_found = F.col("__found").isNotNull()
    unknown = ~is_found if joined is dimension else is_found
    if dimension.has_null_key:
        value = F.when(~unknown & key.isNotNull(), F.lit(False))
    else:
        value = F.when(key.isNotNull(), unknown)
    return marked.withColumn(flag, value).drop("__found")


def without_parent(child: DataFrame, key: str, parent: Dimension) -> DataFrame:
    """Rows of ``child`` whose non-null key does not occur in the parent (left anti join).

    Of a parent too large to broadcast, only the keys that the child may hold are shuffled.
    """
    child = child.where(F.col(key).isNotNull())
    keys = parent.keys()
    if not parent.fits_broadcast and not child.isStreaming:
        child = materialize(child, f"child-{key}")
        keys = relevant_keys(parent, materialize(child.select(key).distinct(), f"child-{key}-keys"))
    keys = keys.withColumnRenamed(parent.key, "__parent_key")
    return child.join(parent.hinted(keys), F.col(key) == F.col("__parent_key"), "left_anti")
