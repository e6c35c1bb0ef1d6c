from datetime import date, datetime, timedelta

import pytest
from moments import at
from pyspark.sql import functions as F

from clickloom.functions import crossed_minutes, crossed_seconds, event_timestamp, ingest_date, text_field


def _value(spark, column, **values):
    schema = ", ".join(f"{name} timestamp_ntz" for name in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "start, end, minutes, seconds",
    [
        ("10:00:59", "10:31:00", 31, 1801),
        ("10:00:00", "10:30:59", 30, 1859),
        ("10:00:59.9", "10:01:00.1", 1, 1),
        ("10:00:00.1", "10:00:00.9", 0, 0),
        ("10:01:00", "10:00:59", -1, -1),
        ("1969-12-31T23:59:59.5", "1970-01-01T00:00:00.5", 1, 1),
    ],
)
def test_boundaries_are_counted_not_elapsed_units(spark, start, end, minutes, seconds):
    times = {"a": at(start), "b": at(end)}
    assert _value(spark, crossed_minutes(F.col("a"), F.col("b")), **times) == minutes
    assert _value(spark, crossed_seconds(F.col("a"), F.col("b")), **times) == seconds


@pytest.mark.parametrize(
    "value, expected",
    [
        ("1764000000", datetime(2025, 11, 24, 16, 0)),
        ('"1764000000"', datetime(2025, 11, 24, 16, 0)),
        ('"2025-11-24T16:00:00+00:00"', datetime(2025, 11, 24, 16, 0)),
        ('"2025-11-24T16:00:00.123456+00:00"', datetime(2025, 11, 24, 16, 0, 0, 123456)),
        ('"2025-11-24T16:00:00+05:00"', datetime(2025, 11, 24, 16, 0)),
        ("0", datetime(1970, 1, 1)),
        ("-1", datetime(1969, 12, 31, 23, 59, 59)),
        ('"junk"', None),
        ("99999999999999999", None),
        ("999999999999999999999999999999", None),
        ("null", None),
        ("true", None),
        ("{}", None),
    ],
)
def test_event_time_of_text_and_number(make_raw, value, expected):
    raw = make_raw(f'{{"event_timestamp":{value}}}')
    text = text_field(F.col("raw_data"), "event_timestamp")
    assert raw.select(event_timestamp(text).alias("v")).first()["v"] == expected


def test_lake_date_is_local(spark):
    loaded = spark.createDataFrame(
        [(datetime(2025, 1, 1, 22, 59),), (datetime(2025, 1, 1, 23, 0),), (datetime(2025, 7, 1, 22, 0),)],
        "t timestamp_ntz",
    )
    days = [r["d"] for r in loaded.select(ingest_date(F.col("t").cast("timestamp")).alias("d")).collect()]
    assert days == [date(2025, 1, 1), date(2025, 1, 2), date(2025, 7, 2)]


def test_random_times_against_python(spark):
    import random

    rng = random.Random(7)
    times = [
        datetime(1970, 1, 1) + timedelta(microseconds=rng.randrange(-(10**15), 4 * 10**15)) for _ in range(300)
    ]
    pairs = list(zip(times, times[1:]))
    frame = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    got = frame.select(
        "a", "b", crossed_minutes(F.col("a"), F.col("b")).alias("m"), crossed_seconds(F.col("a"), F.col("b")).alias("s")
    )
    for row in got.collect():
        a, b = row["a"], row["b"]
        whole = (b.replace(microsecond=0) - a.replace(microsecond=0)).total_seconds()
        minutes = (b.replace(second=0, microsecond=0) - a.replace(second=0, microsecond=0)).total_seconds() / 60
        assert (row["m"], row["s"]) == (minutes, whole)
