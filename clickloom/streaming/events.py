"""Streaming forms of de-duplication, routing and sessions.

The scheduled batch job stays authoritative: it sees every copy of an event, however late. These
give early results while the data arrives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clickloom.operators.lookup import MAX_BROADCAST_BYTES, Dimension, measure
from clickloom.plans.refresh import published_run
from clickloom.plans.staging import parse_events, validate_events
from clickloom.schemas import ADD_TO_CART, DEFAULT_MIN_EVENT_TS, SESSION_GAP_MINUTES, VALIDATED_SCHEMA
from clickloom.sources.dated import BATCH, exists, remove_batches, write_batch
from clickloom.sources.tables import materialize, read_table
from clickloom.streaming.landing import start, start_table


def stream_events(raw: DataFrame, min_event_ts: str | None = DEFAULT_MIN_EVENT_TS) -> DataFrame:
    """Typed events of a raw stream.

    ``event_at`` repeats the event time in the type a watermark needs, ``event_minute`` its minute.
    """
    event_at = F.col("event_at_ts").cast("timestamp")
    events = parse_events(raw, min_event_ts).withColumn("event_at", event_at)
    return events.withColumn("event_minute", F.date_trunc("minute", "event_at"))


def valid_stream(events: DataFrame, products: Dimension, users: Dimension) -> DataFrame:
    """The events that break no rule, as the batch job validates them. Stateless."""
    return validate_events(events, products, users).where("is_valid_record").drop("is_valid_record", "reject_reason")


def first_copies(
    events: DataFrame, lateness: str = "1 hour", time: str = "event_at", spread: int = 16
) -> DataFrame:
    """One copy of each event, remembered for ``lateness``: one of those in the first batch that has any.

    Which of several copies in one batch it is depends on the order of tasks. Copies are thinned out per id
    and one of ``spread`` slots first, so that an id with very many of them does not meet in one task: at
    most ``spread`` of its copies reach the second step.
    """
    slot = F.pmod(F.xxhash64("metadata_filename", "metadata_file_row_number"), F.lit(spread))
    timed = events.where(F.col(time).isNotNull()).withColumn("__slot", slot)
    return (
        timed.withWatermark(time, lateness)
        .dropDuplicatesWithinWatermark(["event_id", "__slot"])
        .dropDuplicatesWithinWatermark(["event_id"])
        .drop("__slot")
    )


def route_events(
    events: DataFrame,
    products: Dimension,
    users: Dimension,
    path: str,
    checkpoint: str,
    continuous: bool = True,
) -> StreamingQuery:
    """Validate a stream and write valid and quarantined records to their own partitions in one pass."""
    routed = validate_events(events, products, users)
    return start_table(routed, path, checkpoint, continuous, ["is_valid_record"])


class PublishedDimensions:
    """Products and users of the run that is published last, measured once per run."""

    def __init__(self, spark: SparkSession, warehouse: str, max_broadcast_bytes: int = MAX_BROADCAST_BYTES):
        self._spark, self._warehouse, self._bound = spark, warehouse, max_broadcast_bytes
        self._run: str | None = None
        self._dimensions: tuple[Dimension, Dimension] | None = None

    def current(self) -> tuple[str, Dimension, Dimension]:
        """The run's id and its dimensions; they are measured anew when another run has been published."""
        run = published_run(self._spark, self._warehouse)
        if run is None:
            raise LookupError(f"nothing has been published in {self._warehouse}")
        if run != self._run:
            folder = f"{self._warehouse}/run={run}"
            products = measure(read_table(self._spark, f"{folder}/products"), "product_id", [], self._bound)
            users = measure(read_table(self._spark, f"{folder}/users"), "user_id", [], self._bound)
            self._run, self._dimensions = run, (products, users)
        return run, *self._dimensions


def route_published(
    events: DataFrame,
    warehouse: str,
    path: str,
    checkpoint: str,
    continuous: bool = True,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> StreamingQuery:
    """``route_events`` with the dimensions of the warehouse as they are when a batch is taken.

    When a run has been published since the last batch, the records in quarantine are judged anew first: those
    whose product or user it brings join the valid ones. A record that was valid stays so.
    """
    dimensions = PublishedDimensions(events.sparkSession, warehouse, max_broadcast_bytes)

    def route(batch: DataFrame, name: str) -> None:
        run, products, users = dimensions.current()
        judge_again(batch.sparkSession, path, run, products, users)
        write_batch(validate_events(batch, products, users), path, name, ["is_valid_record"])

    return start(events, route, checkpoint, continuous)


def judge_again(spark: SparkSession, path: str, run: str, products: Dimension, users: Dimension) -> int:
    """Judge the quarantine of routed records by a run's dimensions, once per run; the number of batches that changed is returned.

    Records that pass are written to a batch of their own first, named after theirs and the run, and then their
    batch in quarantine is written without them. Repeated after a stop in between, this replaces what it wrote.
    """
    done = f"{path}/judged/run={run}"
    if exists(spark, done):
        return 0
    changed: list[str] = []
    if exists(spark, f"{path}/open/is_valid_record=false"):
        schema = T.StructType([*VALIDATED_SCHEMA, T.StructField(BATCH, T.StringType())])
        held = spark.read.schema(schema).parquet(f"{path}/open").where(~F.col("is_valid_record"))
        judged = materialize(validate_events(held.drop("is_valid_record", "reject_reason"), products, users), "judged-again")
        passed = judged.where("is_valid_record")
        changed = [row[BATCH] for row in passed.select(BATCH).distinct().collect()]
        if changed:
            write_batch(passed.withColumn(BATCH, F.concat(BATCH, F.lit(f"-{run}"))), path, partitions=["is_valid_record"])
            names = passed.select(BATCH).distinct()
            left = judged.where(~F.col("is_valid_record")).join(names, BATCH, "left_semi")
            write_batch(left, path, partitions=["is_valid_record"])
            emptied = names.join(left.select(BATCH).distinct(), BATCH, "left_anti").collect()
            remove_batches(spark, path, [("false", row[BATCH]) for row in emptied], ["is_valid_record"])
    spark.range(1).coalesce(1).write.mode("overwrite").parquet(done)
    return len(changed)


def read_routed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(VALIDATED_SCHEMA).parquet(f"{path}/open")


def live_sessions(
    events: DataFrame, lateness: str = "1 hour", gap_minutes: int = SESSION_GAP_MINUTES
) -> DataFrame:
    """Sessions of a stream of valid events, each emitted once no more events can join it.

    Copies are removed first, under the same watermark. Session windows over the event time cut to the
    minute are the sessions of the batch job: they merge while the next minute is at most ``gap_minutes``
    away. A running number needs the whole history, so a live session is known by user and first minute.
    """
    return (
        first_copies(events, lateness, time="event_minute")
        .groupBy("user_id", F.session_window("event_minute", f"{gap_minutes} minutes").alias("w"))
        .agg(
            F.min("event_at_ts").alias("session_started_at_ts"),
            F.max("event_at_ts").alias("session_ended_at_ts"),
            F.count("event_id").alias("total_events_in_session"),
            F.sum(_one_if(F.col("event_type") == ADD_TO_CART)).alias("total_items_added_to_cart"),
            F.max("utm_source").alias("session_utm_source"),
        )
        .withColumn("first_minute", F.col("w.start").cast("timestamp_ntz"))
        .drop("w")
    )


def _one_if(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)
