"""Type 2 slowly changing dimension: one row per key and period of unchanged attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _version(values: dict[str, Column]) -> Column:
    return F.struct(*[value.alias(name) for name, value in values.items()])


def _opened(attributes: dict[str, Column], key: Column, at: Column) -> Column:
    return _version(
        {
            **attributes,
            "version_id": F.md5(F.concat_ws("|", key.cast("string"), at.cast("string"))),
            "updated_at": at,
            "valid_from": at,
            "valid_to": F.lit(None).cast("timestamp_ntz"),
        }
    )


def first_snapshot(load: DataFrame, key: str, at: Column) -> DataFrame:
    """Open one version per key of the first load."""
    version = _opened({name: F.col(name) for name in load.columns}, F.col(key), at)
    return load.where(F.col(key).isNotNull()).select(version.alias("v")).select("v.*")


def apply_snapshot(
    history: DataFrame, load: DataFrame, key: str, check: Sequence[str], at: Column
) -> DataFrame:
    """History after a new full load taken at ``at`` (a zone-less timestamp column).

    New keys open a version. A key with a change in ``check`` (null-safe) closes its open version and
    opens another. Unchanged keys stay as they are, and so do keys missing from the load. Applying
    the same load again changes nothing. Rows without a key are not versioned.

    Closed versions are passed through without a shuffle; open ones meet the load in one full outer
    join, which each row leaves as up to two versions.
    """
    history = history.select(*load.columns, "version_id", "updated_at", "valid_from", "valid_to")
    closed = history.where(F.col("valid_to").isNotNull())
    opened = history.where(F.col("valid_to").isNull()).alias("open")
    fresh = load.alias("load")

    def was(name: str) -> Column:
        return F.col(f"open.{name}")

    def now(name: str) -> Column:
        return F.col(f"load.{name}")

    in_history, in_load = was(key).isNotNull(), now(key).isNotNull()
    changed = F.lit(False)
    for name in check:
        changed = changed | ~was(name).eqNullSafe(now(name))
    replaced = in_history & in_load & changed

    kept = {name: was(name) for name in history.columns}
    kept["valid_to"] = F.when(replaced, at)
    versions = F.array(
        F.when(in_history, _version(kept)),
        F.when(
            in_load & (~in_history | changed),
            _opened({name: now(name) for name in load.columns}, now(key), at),
        ),
    )
    return (
        opened.join(fresh, was(key) == now(key), "full_outer")
        .select(F.explode(versions).alias("v"))
        .where(F.col("v").isNotNull())
        .select("v.*")
        .unionByName(closed)
    )


def current_versions(history: DataFrame) -> DataFrame:
    """The open version of each key."""
    return history.where(F.col("valid_to").isNull())


def versions_at(history: DataFrame, ts: Column) -> DataFrame:
    """The versions valid at one point in time."""
    return history.where(
        (F.col("valid_from") <= ts) & (F.col("valid_to").isNull() | (ts < F.col("valid_to")))
    )
