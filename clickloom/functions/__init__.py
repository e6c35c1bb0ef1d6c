from clickloom.functions.rules import reject_reason
from clickloom.functions.times import (
    crossed_minutes,
    crossed_seconds,
    epoch_minute,
    epoch_second,
    ingest_date,
    instant_of_epoch,
)
from clickloom.functions.variants import event_timestamp, int_field, text_field

__all__ = [
    "crossed_minutes",
    "crossed_seconds",
    "epoch_minute",
    "epoch_second",
    "event_timestamp",
    "ingest_date",
    "instant_of_epoch",
    "int_field",
    "reject_reason",
    "text_field",
]
