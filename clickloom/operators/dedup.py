"""Keep the latest copy of each event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_first() -> list[Column]:
    """Order of the copies of an event: a missing load time counts as the latest, then file and row decide."""
    return [F.col(name).desc_nulls_first() for name in ("loaded_at", "metadata_filename", "metadata_file_row_number")]


def latest_copy(events: DataFrame, key: str = "event_id") -> DataFrame:
    """One row per key: the last loaded copy.

    The order is total, so the choice is the same on every run. ``rank = 1`` makes Spark cut each map
    partition to one row per key before the shuffle, so a key with very many copies stays cheap.
    """
    of_key = Window.partitionBy(key).orderBy(*newest_first())
    return (
        events.where(F.col(key).isNotNull())
        .withColumn("__rank", F.row_number().over(of_key))
        .where(F.col("__rank") == 1)
        .drop("__rank")
    )
