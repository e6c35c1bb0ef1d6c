"""Join events to the version of a dimension row valid at the time of the event.

Two ways. ``price_asof`` is a lookup with a range condition: every event meets every version of its product,
which suits short histories, and closed intervals too. ``price_asof_sweep`` puts events and versions in one order
of time and carries the last version on, so its cost is events plus versions, however long a history is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions import epoch_second
from clickloom.operators.lookup import Dimension, left_lookup, measure
from clickloom.schemas import OPEN_ENDED_VALID_TO
from clickloom.sources.tables import materialize

#: Events of a product and bucket that are put in order in one task; a bucket with more is split.
SLOT_EVENTS = 1_000_000


def valid_at(ts: Column, closed: bool = False) -> Column:
    """``valid_from <= ts < valid_to``; with ``closed`` the end counts as valid too.

    Closed intervals overlap in the instant of a change: an event at that instant joins both
    versions. The half-open form gives it the new version only.
    """
    valid_to = F.coalesce(F.col("valid_to"), F.lit(OPEN_ENDED_VALID_TO).cast("timestamp_ntz"))
    before_end = ts <= valid_to if closed else ts < valid_to
    return (ts >= F.col("valid_from")) & before_end


def price_asof(events: DataFrame, versions: Dimension, closed: bool = False) -> DataFrame:
    """Add ``value`` = quantity x price valid at ``event_at_ts``; null where either is unknown."""
    prices = versions.df.select("product_id", "price", "valid_from", "valid_to")
    priced = left_lookup(
        events,
        versions,
        F.col("product_id"),
        spread_by="event_id",
        columns=prices,
        condition=valid_at(F.col("event_at_ts"), closed),
    )
    return priced.withColumn("value", F.col("quantity") * F.col("price")).drop(
        "price", "valid_from", "valid_to"
    )


def overlapping_versions(versions: DataFrame) -> DataFrame:
    """Versions that begin before an earlier one of their product has ended; a history has none."""
    until = F.coalesce(F.col("valid_to"), F.lit(OPEN_ENDED_VALID_TO).cast("timestamp_ntz"))
    known = versions.where(F.col("product_id").isNotNull() & (F.col("valid_from") < until)).withColumn("until", until)
    before = Window.partitionBy("product_id").orderBy("valid_from", "until").rowsBetween(Window.unboundedPreceding, -1)
    return known.withColumn("taken", F.max("until").over(before)).where("valid_from < taken").drop("until", "taken")


def price_asof_sweep(
    events: DataFrame, versions: DataFrame, bucket_seconds: int = 86_400, slot_events: int = SLOT_EVENTS
) -> DataFrame:
    """The same ``value`` as half-open ``price_asof``, for versions that don't overlap (``overlapping_versions``).

    Time is cut into buckets. The version that holds at the start of a bucket comes from a small table, of the last
    version of each bucket that has any, carried over the buckets of a product. Within a bucket, versions and events
    are put in order together and the last version is carried from row to row. Events don't depend on each other:
    a bucket with very many of them is split into slots, each with the bucket's versions. Events are shuffled once;
    those without a product or time have no value and stay where they are.
    """
    timed = F.col("product_id").isNotNull() & F.col("event_at_ts").isNotNull()
    no_price = F.lit(None).cast(versions.schema["price"].dataType)
    rest = events.where(~timed).withColumn("value", F.col("quantity") * no_price)
    known = events.where(timed).select(
        "product_id", _bucket(F.col("event_at_ts"), bucket_seconds).alias("bucket"), F.col("event_at_ts").alias("at"), F.struct(*events.columns).alias("event")
    )
    counts = materialize(known.groupBy("product_id", "bucket").agg(F.count(F.lit(1)).alias("events")), "asof-buckets")
    begun = versions.where(F.col("product_id").isNotNull() & F.col("valid_from").isNotNull()).select(
        "product_id", _bucket(F.col("valid_from"), bucket_seconds).alias("bucket"), F.col("valid_from").alias("at"), F.struct("price", "valid_to").alias("version")
    )
    # Brought together first: a sort of all that a task of the scan holds would take memory as the table grows.
    begun = begun.repartition("product_id", "bucket")
    # Of versions that begin together only one lasts: a null end is the latest.
    lasting = F.struct("at", F.coalesce(F.col("version.valid_to"), F.lit(OPEN_ENDED_VALID_TO).cast("timestamp_ntz")))
    ends = begun.groupBy("product_id", "bucket").agg(F.max_by("version", lasting).alias("version"))
    before = Window.partitionBy("product_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    held = counts.join(ends, ["product_id", "bucket"], "full").withColumn("start", F.last("version", ignorenulls=True).over(before))
    start_at = F.timestamp_add("SECOND", F.col("bucket") * bucket_seconds, F.lit("1970-01-01").cast("timestamp_ntz"))
    starts = held.where(F.col("events").isNotNull() & F.col("start").isNotNull())
    starts = starts.select("product_id", "bucket", start_at.alias("at"), F.col("start").alias("version"), F.lit(0).alias("kind"), "events")
    inside = begun.join(counts, ["product_id", "bucket"]).select("product_id", "bucket", "at", "version", F.lit(1).alias("kind"), "events")

    slots = F.ceil(F.col("events") / slot_events).cast("int")
    versions_there = starts.unionByName(inside).withColumn("slot", F.explode(F.sequence(F.lit(0), slots - 1))).drop("events")
    crowded = counts.where(F.col("events") > slot_events).select("product_id", F.col("bucket").alias("__bucket"), slots.alias("__slots"))
    crowded = measure(materialize(crowded, "asof-crowded"), "product_id")
    slot = F.pmod(F.xxhash64("event.event_id", "at"), F.coalesce("__slots", F.lit(1)))
    if crowded.rows:
        marked = known.join(crowded.hinted().withColumnRenamed("__bucket", "bucket"), ["product_id", "bucket"], "left")
    else:
        marked = known.withColumn("__slots", F.lit(None).cast("int"))
    marked = marked.select("product_id", "bucket", slot.cast("int").alias("slot"), "at", F.lit(2).alias("kind"), "event")

    swept = marked.unionByName(versions_there, allowMissingColumns=True)
    lasts = F.coalesce(F.col("version.valid_to"), F.lit(OPEN_ENDED_VALID_TO).cast("timestamp_ntz"))
    so_far = Window.partitionBy("product_id", "bucket", "slot").orderBy("at", "kind", lasts).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = swept.withColumn("valid", F.last("version", ignorenulls=True).over(so_far)).where("kind = 2")
    ends_at = F.coalesce(F.col("valid.valid_to"), F.lit(OPEN_ENDED_VALID_TO).cast("timestamp_ntz"))
    price = F.when(F.col("at") < ends_at, F.col("valid.price"))
    priced = swept.select("event.*", (F.col("event.quantity") * price).alias("value"))
    return priced.unionByName(rest)


def _bucket(ts: Column, seconds: int) -> Column:
    second = epoch_second(ts)
    return ((second - F.pmod(second, F.lit(seconds))) / seconds).cast("bigint")

