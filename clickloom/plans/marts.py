"""The session fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.lookup import Dimension, left_lookup
from clickloom.operators.sessions import products_viewed, session_metrics, session_minutes
from clickloom.operators.sketches import products_viewed_approx
from clickloom.schemas import SESSION_GAP_MINUTES
from clickloom.sources.tables import materialize


FACT_COLUMNS = [
    "session_id",
    "user_id",
    "user_country",
    "session_started_at_ts",
    "session_ended_at_ts",
    "session_duration_seconds",
    "total_events_in_session",
    "total_session_revenue",
    "total_items_added_to_cart",
    "distinct_products_viewed",
    "session_utm_source",
]


def enrich_sessions(sessions: DataFrame, users: Dimension) -> DataFrame:
    """Add ``user_country``; sessions of unknown users stay."""
    countries = users.df.select(users.key, F.col("country").alias("user_country"))
    return left_lookup(sessions, users, F.col("user_id"), spread_by="session_id", columns=countries)


def fact_sessions(
    events: DataFrame,
    users: Dimension,
    gap_minutes: int = SESSION_GAP_MINUTES,
    unique_events: bool = True,
    minutes: DataFrame | None = None,
    approx_products: int | None = None,
) -> DataFrame:
    """One row per session. ``events`` are valid, priced events, best read from a written table.

    ``approx_products`` (binary logarithm of a sketch's buckets) has distinct products estimated instead of counted.

    Everything comes from the session minutes, which are written down first where they are not given: a
    user's minutes are ordered once.
    """
    if minutes is None:
        minutes = materialize(session_minutes(events, gap_minutes, unique_events), "session-minutes")
    metrics = session_metrics(minutes)
    if approx_products is None:
        viewed = products_viewed(events, minutes)
    else:
        viewed = products_viewed_approx(events, minutes, approx_products)
    sessions = metrics.join(viewed, ["user_id", "session_index"], "left").withColumn(
        "distinct_products_viewed", F.coalesce("distinct_products_viewed", F.lit(0).cast("bigint"))
    )
    return enrich_sessions(sessions, users).select(*FACT_COLUMNS)
