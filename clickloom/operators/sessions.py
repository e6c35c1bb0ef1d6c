"""Sessions by inactivity gap, at the grain of user and minute.

The rule: an event starts a session when it is the user's first, or when more than ``gap`` minute
boundaries lie between it and the user's previous event. Two events of a user in the same minute are
never separated, so whether a session starts, and its running number, depend only on the *distinct
minutes* in which the user was active.

That is what makes the operator safe against a hot user (all visitors without a login share one):
events are reduced to distinct (user, minute) pairs before anything is ordered per user. The window
over a user then sees one narrow row per active minute, at most 525,600 a year, however many events
there were. Row-level results come from a join back on (user, minute), which spreads a hot user over
as many partitions as there are minutes.

After staging neither the user nor the time of an event is null.

Both inputs of that join read ``events``; hand in a written table (see ``sources.tables``) rather
than a long lazy plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions import crossed_minutes, crossed_seconds, epoch_minute, epoch_second
from clickloom.schemas import (
    ADD_TO_CART,
    CHECKOUT,
    GUEST_USER,
    PRODUCT_VIEW,
    SESSION_EVENT_COLUMNS,
    SESSION_GAP_MINUTES,
)


#: Begins the id of a visitor; no registered user has a colon after it.
VISITOR_PREFIX = f"{GUEST_USER}:"
INSTANT_COLUMNS = ["event_id", "user_id", "event_at_ts"]


def _lag(column: str, keys: list[str], order: str) -> Column:
    return F.lag(column).over(Window.partitionBy(*keys).orderBy(order))


def _by_minute():
    return Window.partitionBy("user_id").orderBy("minute")


def visitor_of(user: Column, ip_address: Column, user_agent: Column) -> Column:
    """The user, or for guests the visitor: told by address and agent, the same in every run.

    A guest of whom neither is known stays the shared guest.
    """
    place = F.concat(F.coalesce(ip_address, F.lit("")), F.lit("|"), F.coalesce(user_agent, F.lit("")))
    visitor = F.concat(F.lit(VISITOR_PREFIX), F.left(F.md5(place), F.lit(16)))
    return F.when((user == GUEST_USER) & (F.length(place) > 1), visitor).otherwise(user)


def account_of(user: Column) -> Column:
    """The user a visitor is registered as: the guest."""
    return F.when(user.startswith(VISITOR_PREFIX), F.lit(GUEST_USER)).otherwise(user)


def with_visitors(events: DataFrame) -> DataFrame:
    """Events with visitors in place of the shared guest, whose traffic would run into a few endless sessions."""
    return events.withColumn("user_id", visitor_of(F.col("user_id"), F.col("ip_address"), F.col("user_agent")))


def number_sessions(minutes: DataFrame, gap_minutes: int = SESSION_GAP_MINUTES) -> DataFrame:
    """Add ``session_index`` (1, 2, ... per user) to rows unique by (user, minute)."""
    idle = F.col("minute") - F.lag("minute").over(_by_minute())
    so_far = _by_minute().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        minutes.withColumn("__starts", F.when(idle <= gap_minutes, 0).otherwise(1))
        .withColumn("session_index", F.sum("__starts").over(so_far))
        .drop("__starts")
    )


def active_minutes(events: DataFrame, gap_minutes: int = SESSION_GAP_MINUTES) -> DataFrame:
    """(user, minute, session_index) for every minute in which a user was active."""
    minutes = events.select("user_id", epoch_minute(F.col("event_at_ts")).alias("minute")).distinct()
    return number_sessions(minutes, gap_minutes)


def minute_totals(events: DataFrame, unique_events: bool = True) -> DataFrame:
    """The totals of the priced events of every (user, minute), summed up with map-side combining.

    ``unique_events`` says that an event id occurs in one row only, which spares the distinct count;
    leave it off after a closed-interval price join.
    """
    event_count = F.count("event_id") if unique_events else F.countDistinct("event_id")
    is_type = F.col("event_type").eqNullSafe
    return (
        events.withColumn("minute", epoch_minute(F.col("event_at_ts")))
        .groupBy("user_id", "minute")
        .agg(
            F.min("event_at_ts").alias("first_ts"),
            F.max("event_at_ts").alias("last_ts"),
            event_count.alias("events"),
            # A checkout without a known value is null and left out; a session of nothing else is null.
            F.sum(F.when(is_type(CHECKOUT), F.col("value")).otherwise(0)).alias("revenue"),
            F.sum(F.when(is_type(ADD_TO_CART), 1).otherwise(0)).alias("items_added"),
            F.max("utm_source").alias("utm_source"),
        )
    )


def session_minutes(
    events: DataFrame, gap_minutes: int = SESSION_GAP_MINUTES, unique_events: bool = True
) -> DataFrame:
    """The active minutes with the totals of their priced events.

    The one relation the session facts come from: a user's minutes are put in order once. Write it where
    several things are derived from it.
    """
    return number_sessions(minute_totals(events, unique_events), gap_minutes)


def session_id() -> Column:
    user = F.coalesce(F.col("user_id"), F.lit(GUEST_USER))
    return F.concat(user, F.lit("-"), F.col("session_index").cast("string"))


def with_session_index(
    events: DataFrame, gap_minutes: int = SESSION_GAP_MINUTES, minutes: DataFrame | None = None
) -> DataFrame:
    """Add ``session_index`` to every event; ``minutes`` are its active minutes where already known."""
    minutes = active_minutes(events, gap_minutes) if minutes is None else minutes
    minutes = minutes.select("user_id", "minute", "session_index")
    return (
        events.withColumn("minute", epoch_minute(F.col("event_at_ts")))
        .join(minutes, ["user_id", "minute"], "left")
        .drop("minute")
    )


def sessionize(
    events: DataFrame, gap_minutes: int = SESSION_GAP_MINUTES, minutes: DataFrame | None = None
) -> DataFrame:
    """One row per event with its ``session_id``."""
    return (
        with_session_index(events, gap_minutes, minutes)
        .withColumn("session_id", session_id())
        .select(*SESSION_EVENT_COLUMNS)
    )


def event_gaps(events: DataFrame, gap_minutes: int = SESSION_GAP_MINUTES) -> DataFrame:
    """Previous event of the same user, minutes since then, and the session-start flag, per event.

    Event ids are unique; events of a user at the same instant are ordered by id. Four grains, each
    bounded whatever the traffic: instants within a second, seconds within a minute, minutes within a user,
    and the events themselves. Each grain hands its last instant on to the next one.
    """
    ts = F.col("event_at_ts")
    events = events.select(*INSTANT_COLUMNS, epoch_minute(ts).alias("minute"), epoch_second(ts).alias("second"))
    instants = events.groupBy("user_id", "second", "event_at_ts").agg(F.min("event_id").alias("first_id"))
    instants = instants.withColumn("before_in_second", _lag("event_at_ts", ["user_id", "second"], "event_at_ts"))
    seconds = events.groupBy("user_id", "minute", "second").agg(F.max("event_at_ts").alias("last_ts"))
    minutes = seconds.groupBy("user_id", "minute").agg(F.max("last_ts").alias("last_ts"))
    seconds = seconds.withColumn("before_in_minute", _lag("last_ts", ["user_id", "minute"], "second")).drop("last_ts")
    minutes = minutes.withColumn("before_minute", _lag("last_ts", ["user_id"], "minute")).drop("last_ts")
    before = seconds.join(minutes, ["user_id", "minute"]).select(
        "user_id", "second", F.coalesce("before_in_minute", "before_minute").alias("before_second")
    )
    instants = instants.join(before, ["user_id", "second"]).select(
        "user_id",
        "event_at_ts",
        "first_id",
        F.coalesce("before_in_second", "before_second").alias("before_instant"),
    )
    idle = crossed_minutes(F.col("previous_event_ts"), F.col("event_at_ts"))
    return (
        events.join(instants, ["user_id", "event_at_ts"], "left")
        .withColumn(
            "previous_event_ts",
            F.when(F.col("event_id") == F.col("first_id"), F.col("before_instant")).otherwise(
                F.col("event_at_ts")
            ),
        )
        .withColumn("minutes_since_last_event", idle)
        .withColumn("is_new_session", F.when(idle <= gap_minutes, 0).otherwise(1))
        .select(
            "event_id",
            "user_id",
            "event_at_ts",
            "previous_event_ts",
            "minutes_since_last_event",
            "is_new_session",
        )
    )


def session_metrics(minutes: DataFrame) -> DataFrame:
    """Sessions as sums over their minutes (``session_minutes``); no session is attached to an event."""
    return (
        minutes.groupBy("user_id", "session_index")
        .agg(
            F.min("first_ts").alias("session_started_at_ts"),
            F.max("last_ts").alias("session_ended_at_ts"),
            F.sum("events").alias("total_events_in_session"),
            F.sum("revenue").alias("total_session_revenue"),
            F.sum("items_added").alias("total_items_added_to_cart"),
            F.max("utm_source").alias("session_utm_source"),
        )
        .withColumn("session_id", session_id())
        .withColumn(
            "session_duration_seconds",
            crossed_seconds(F.col("session_started_at_ts"), F.col("session_ended_at_ts")),
        )
    )


def minute_views(events: DataFrame) -> DataFrame:
    """The distinct products viewed in every (user, minute)."""
    views = events.where((F.col("event_type") == PRODUCT_VIEW) & F.col("product_id").isNotNull())
    return views.select("user_id", epoch_minute(F.col("event_at_ts")).alias("minute"), "product_id").distinct()


def products_viewed(events: DataFrame, minutes: DataFrame) -> DataFrame:
    """(user, session_index, distinct_products_viewed) for sessions with a product view.

    Views are made distinct per minute, then per session, then counted: every step combines before
    its shuffle and none gathers the products of one session in a single group.
    """
    views = minute_views(events)
    return (
        views.join(minutes.select("user_id", "minute", "session_index"), ["user_id", "minute"])
        .select("user_id", "session_index", "product_id")
        .distinct()
        .groupBy("user_id", "session_index")
        .agg(F.count("product_id").alias("distinct_products_viewed"))
    )
