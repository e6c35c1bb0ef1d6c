"""Typed reads from the semi-structured message column.

The ``try_`` forms give null for a value that does not fit, so that one bad message cannot stop a
job over the whole table. A missing key and a JSON null both read as SQL null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickloom.functions.times import instant_of_epoch

_WHOLE_NUMBER = "^-?[0-9]+$"


def text_field(raw: Column, key: str) -> Column:
    return F.try_variant_get(raw, f"$.{key}", "string")


def int_field(raw: Column, key: str) -> Column:
    return F.try_variant_get(raw, f"$.{key}", "int")


def event_timestamp(text: Column) -> Column:
    """Event time of a text: whole epoch seconds or ISO-8601 (a zone offset is dropped), else null.

    The field holds numbers and strings, so it is read as text. Only digits are tried as a number: a
    failed cast of every ISO text would cost an exception per row.
    """
    seconds = text.try_cast("bigint")
    return F.when(text.rlike(_WHOLE_NUMBER), instant_of_epoch(seconds)).otherwise(
        text.try_cast("timestamp_ntz")
    )
