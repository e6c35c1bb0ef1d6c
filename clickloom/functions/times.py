"""Time arithmetic on zone-less timestamps.

Spark's ``timestampdiff`` counts elapsed units. The session rules count *crossed boundaries*:
10:00:59.9 to 10:01:00.1 is one minute and one second. Both ends are therefore mapped to the number
of their minute (or second) before subtracting.

The session time zone is UTC (``clickloom.configure`` sets it), so a zone-less value and the instant
it is cast to are the same number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickloom.schemas import LAKE_TIME_ZONE

_FIRST_SECOND = -62_135_596_800  # 0001-01-01 00:00:00
_LAST_SECOND = 253_402_300_799  # 9999-12-31 23:59:59


def epoch_second(ts: Column) -> Column:
    """Number of the second ``ts`` lies in, counted from 1970-01-01."""
    return F.unix_seconds(ts.cast("timestamp"))


def epoch_minute(ts: Column) -> Column:
    """Number of the calendar minute ``ts`` lies in, counted from 1970-01-01."""
    second = epoch_second(ts)
    return ((second - F.pmod(second, F.lit(60))) / 60).cast("bigint")


def crossed_minutes(start: Column, end: Column) -> Column:
    """Minute boundaries between two timestamps."""
    return epoch_minute(end) - epoch_minute(start)


def crossed_seconds(start: Column, end: Column) -> Column:
    """Second boundaries between two timestamps."""
    return epoch_second(end) - epoch_second(start)


def instant_of_epoch(seconds: Column) -> Column:
    """Zone-less UTC timestamp of a number of seconds since 1970-01-01, null outside years 1 to 9999."""
    in_calendar = F.when(seconds.between(_FIRST_SECOND, _LAST_SECOND), seconds)
    return F.timestamp_add("SECOND", in_calendar, F.lit("1970-01-01").cast("timestamp_ntz"))


def ingest_date(loaded_at: Column, zone: str = LAKE_TIME_ZONE) -> Column:
    """Local calendar date of a UTC load time; the lake is partitioned by it."""
    return F.to_date(F.from_utc_timestamp(loaded_at, zone))
