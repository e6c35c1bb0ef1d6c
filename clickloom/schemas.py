"""Table layouts and the fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# They define the results and must not change.
GUEST_USER = "guest"
EVENT_TYPES = ["page_view", "add_to_cart", "checkout", "product_view", "remove_from_cart"]
PAGE_VIEW = "page_view"
PRODUCT_VIEW = "product_view"
ADD_TO_CART = "add_to_cart"
CHECKOUT = "checkout"
SESSION_GAP_MINUTES = 30
DEFAULT_MIN_EVENT_TS = "2025-11-23 15:20:00"
OPEN_ENDED_VALID_TO = "9999-12-31 00:00:00"
LAKE_TIME_ZONE = "Europe/Paris"

RAW_SCHEMA = T.StructType(
    [
        T.StructField("raw_data", T.VariantType()),
        T.StructField("metadata_filename", T.StringType()),
        T.StructField("metadata_file_row_number", T.LongType()),
        T.StructField("loaded_at", T.TimestampType()),
        T.StructField("ingest_date", T.DateType()),
    ]
)

VALIDATED_SCHEMA = T.StructType(
    [
        *[
            T.StructField(n, T.StringType())
            for n in ("event_id", "user_id", "product_id", "order_id", "event_type")
        ],
        T.StructField("event_at_ts", T.TimestampNTZType()),
        T.StructField("quantity", T.IntegerType()),
        *[
            T.StructField(n, T.StringType())
            for n in (
                "platform",
                "ip_address",
                "user_agent",
                "utm_source",
                "utm_medium",
                "utm_campaign",
                "metadata_filename",
            )
        ],
        T.StructField("metadata_file_row_number", T.LongType()),
        T.StructField("loaded_at", T.TimestampNTZType()),
        T.StructField("reject_reason", T.StringType()),
        T.StructField("is_valid_record", T.BooleanType()),
    ]
)

PRODUCT_SCHEMA = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price", T.DecimalType(10, 2)),
    ]
)

USER_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("registration_date", T.DateType()),
        T.StructField("country", T.StringType()),
    ]
)

PRODUCT_VERSION_SCHEMA = T.StructType(
    [
        *PRODUCT_SCHEMA.fields,
        T.StructField("version_id", T.StringType()),
        T.StructField("updated_at", T.TimestampNTZType()),
        T.StructField("valid_from", T.TimestampNTZType()),
        T.StructField("valid_to", T.TimestampNTZType()),
    ]
)

# Text fields of a message that are taken over without change.
PLAIN_TEXT_FIELDS = [
    "event_id",
    "product_id",
    "order_id",
    "platform",
    "ip_address",
    "user_agent",
    "utm_source",
    "utm_medium",
    "utm_campaign",
]

# What the session facts are computed from.
METRIC_COLUMNS = [
    "event_id",
    "user_id",
    "event_at_ts",
    "event_type",
    "product_id",
    "value",
    "utm_source",
]

SESSION_EVENT_COLUMNS = [
    "event_id",
    "event_type",
    "user_id",
    "product_id",
    "order_id",
    "value",
    "quantity",
    "platform",
    "ip_address",
    "user_agent",
    "utm_source",
    "utm_medium",
    "utm_campaign",
    "event_at_ts",
    "session_id",
]
