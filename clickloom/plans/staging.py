"""Raw messages to typed, validated, de-duplicated events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions import event_timestamp, int_field, reject_reason, text_field
from clickloom.operators.dedup import latest_copy
from clickloom.operators.lookup import Dimension, with_unknown_flag
from clickloom.schemas import DEFAULT_MIN_EVENT_TS, GUEST_USER, PLAIN_TEXT_FIELDS


def parse_events(raw: DataFrame, min_event_ts: str | None = DEFAULT_MIN_EVENT_TS) -> DataFrame:
    """Type the message fields and keep events with an id from ``min_event_ts`` on (None: all).

    A message without a timestamp is dropped. One with a timestamp nobody can read stays, with a null
    ``event_at_ts``, for the quarantine.
    """
    raw_data = F.col("raw_data")
    text = {name: text_field(raw_data, name) for name in PLAIN_TEXT_FIELDS}
    sent_at = text_field(raw_data, "event_timestamp")
    event_at = event_timestamp(sent_at)
    typed = raw.select(
        text["event_id"].alias("event_id"),
        F.coalesce(text_field(raw_data, "user_id"), F.lit(GUEST_USER)).alias("user_id"),
        text["product_id"].alias("product_id"),
        text["order_id"].alias("order_id"),
        F.lower(text_field(raw_data, "event_type")).alias("event_type"),
        event_at.alias("event_at_ts"),
        int_field(raw_data, "quantity").alias("quantity"),
        *[
            text[name].alias(name)
            for name in ("platform", "ip_address", "user_agent", "utm_source", "utm_medium", "utm_campaign")
        ],
        "metadata_filename",
        "metadata_file_row_number",
        F.col("loaded_at").cast("timestamp_ntz").alias("loaded_at"),
        sent_at.alias("__sent_at"),
    )
    has_time = F.col("__sent_at").isNotNull()
    if min_event_ts is not None:
        in_range = F.col("event_at_ts") >= F.lit(min_event_ts).cast("timestamp_ntz")
        has_time = F.coalesce(in_range, has_time)
    return typed.where(F.col("event_id").isNotNull() & has_time).drop("__sent_at")


def validate_events(events: DataFrame, products: Dimension, users: Dimension) -> DataFrame:
    """Add ``is_valid_record`` (never null) and ``reject_reason``."""
    flagged = with_unknown_flag(
        events, products, F.col("product_id"), "product_unknown", spread_by="event_id"
    )
    # Guests need no registration: without a key they take no part in the join.
    registered = F.when(F.col("user_id") != GUEST_USER, F.col("user_id"))
    flagged = with_unknown_flag(
        flagged, users, registered, "user_unknown", spread_by="event_id", keys_from=events
    )
    reason = reject_reason(
        F.col("event_type"),
        F.col("product_id"),
        F.col("product_unknown"),
        F.col("user_id"),
        F.col("user_unknown"),
        F.col("event_at_ts").isNull(),
    )
    return (
        flagged.withColumn("reject_reason", reason)
        .withColumn("is_valid_record", F.col("reject_reason").isNull())
        .drop("product_unknown", "user_unknown")
    )


def valid_events(validated: DataFrame) -> DataFrame:
    """The latest valid copy of each event; an invalid newer copy does not hide a valid older one."""
    return latest_copy(validated.where("is_valid_record")).drop("is_valid_record", "reject_reason")


def quarantined_events(validated: DataFrame) -> DataFrame:
    """Every record that broke a rule, with the reason."""
    return validated.where(~F.col("is_valid_record"))
