"""The scheduled refresh: dimensions, product history, staging, sessions, facts, checks.

A run writes its tables below ``run=<id>`` of the warehouse and is published, by one small pointer
table, only after its checks have passed. Readers see the last published run throughout; a failed or
lost run leaves nothing half-replaced, and is simply run again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions import epoch_minute
from clickloom.operators import quality
from clickloom.operators.asof import price_asof
from clickloom.operators.lookup import MAX_BROADCAST_BYTES, Dimension, measure
from clickloom.operators.scd2 import apply_snapshot, first_snapshot
from clickloom.operators.sessions import account_of, session_minutes, sessionize, with_visitors
from clickloom.plans.marts import fact_sessions
from clickloom.plans.staging import parse_events, quarantined_events, valid_events, validate_events
from clickloom.schemas import (
    DEFAULT_MIN_EVENT_TS,
    EVENT_TYPES,
    PAGE_VIEW,
    PRODUCT_VERSION_SCHEMA,
    SESSION_GAP_MINUTES,
    VALIDATED_SCHEMA,
)
from clickloom.session import input_bytes, sizing
from clickloom.sources.tables import read_table, write_table

# The key and the compared attributes of the product history.
PRODUCT_KEY = "product_id"
PRODUCT_CHECK = ["category", "product_name", "price"]


@dataclass(frozen=True)
class RefreshConfig:
    warehouse: str
    run_id: str
    # Time of this load in the product history, e.g. "2025-11-24 00:00:00".
    loaded_at: str
    min_event_ts: str | None = DEFAULT_MIN_EVENT_TS
    gap_minutes: int = SESSION_GAP_MINUTES
    closed_validity: bool = False
    # Give guests sessions by visitor (address and agent) instead of together.
    split_guests: bool = False
    # Estimate distinct products by sketches of two to this power of buckets; None counts them.
    approx_products: int | None = None
    # Size of the raw table, by which scans and shuffles are sized; measured where it is not given.
    raw_bytes: int | None = None
    # Largest dimension to broadcast; raise it with the memory of the executors.
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES

    def table(self, name: str) -> str:
        return f"{self.warehouse}/run={self.run_id}/{name}"


def published_runs(spark: SparkSession, warehouse: str) -> DataFrame:
    """(run_id, published_at), one row per published run."""
    try:
        return read_table(spark, f"{warehouse}/published")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], "run_id string, published_at timestamp")
        raise


def published_run(spark: SparkSession, warehouse: str) -> str | None:
    """Id of the last published run, None before the first."""
    return published_runs(spark, warehouse).agg(F.max_by("run_id", "published_at")).first()[0]


def read_published(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    """A table of the last published run; ``quarantine`` and ``sessionized`` are views."""
    run_id = published_run(spark, warehouse)
    if run_id is None:
        raise LookupError(f"nothing has been published in {warehouse}")
    folder = f"{warehouse}/run={run_id}"
    if table == "quarantine":
        return quarantined_events(read_validated(spark, f"{folder}/validated"))
    if table == "sessionized":
        minutes = read_table(spark, f"{folder}/session_minutes")
        return sessionize(read_table(spark, f"{folder}/events"), minutes=minutes)
    return read_table(spark, f"{folder}/{table}")


PUBLISHED = [
    "products",
    "users",
    "product_versions",
    "events",
    "quarantine",
    "sessionized",
    "fact_sessions",
    "checks",
]


def register_views(spark: SparkSession, warehouse: str) -> None:
    """Make the published tables available to SQL by name."""
    for table in PUBLISHED:
        read_published(spark, warehouse, table).createOrReplaceTempView(table)


def read_validated(spark: SparkSession, path: str) -> DataFrame:
    """Validated records, partitioned by their flag: the quarantine is one of the two partitions."""
    return read_table(spark, path, VALIDATED_SCHEMA)


def publish(spark: SparkSession, config: RefreshConfig) -> None:
    """Append the run to the list of published runs: a single file, visible all at once."""
    row = spark.range(1).select(
        F.lit(config.run_id).alias("run_id"), F.current_timestamp().alias("published_at")
    )
    row.coalesce(1).write.mode("append").parquet(f"{config.warehouse}/published")


def product_history(
    spark: SparkSession, config: RefreshConfig, products: DataFrame, previous: str | None
) -> DataFrame:
    """History of the last published run carried on with this run's products."""
    at = F.lit(config.loaded_at).cast("timestamp_ntz")
    if previous is None:
        return first_snapshot(products, PRODUCT_KEY, at)
    history = read_table(spark, f"{config.warehouse}/run={previous}/product_versions", PRODUCT_VERSION_SCHEMA)
    return apply_snapshot(history, products, PRODUCT_KEY, PRODUCT_CHECK, at)


def event_rules() -> list[quality.RowCheck]:
    """Rules on single rows of the event table."""
    return [
        quality.not_null("events.event_id.not_null", "event_id"),
        quality.not_null("events.event_at_ts.not_null", "event_at_ts"),
        quality.not_null("events.user_id.not_null", "user_id"),
        quality.not_null("events.product_id.not_null", "product_id", where=~F.col("event_type").isin(PAGE_VIEW)),
        quality.not_null("sessionized.event_id.not_null", "event_id"),
    ]


def fact_rules() -> list[quality.RowCheck]:
    """Rules on single rows of the session table."""
    return [
        quality.not_null("sessions.session_id.not_null", "session_id"),
        quality.not_null("sessions.user_id.not_null", "user_id"),
        quality.RowCheck("sessions.session_duration_seconds.not_negative", F.col("session_duration_seconds") < 0),
    ]


def table_checks(
    events: DataFrame, minutes: DataFrame, facts: DataFrame, users: Dimension
) -> DataFrame:
    """The checks of the event, session-event and session tables.

    A session event is an event joined to the one minute it lies in, so its rules are checked where they
    arise: its id is the event's, it has a session unless its minute is missing, and it is there once if
    the event is and no minute is there twice. No event is joined to its session for that.
    """
    row_checks = [(events, event_rules()), (facts, fact_rules())]
    # Rows by kind of violation: an event id twice, a minute twice.
    keys = minutes.groupBy("user_id", "minute").agg(F.count("session_index").alias("n_records"))
    doubles = quality.duplicated(events, "event_id").select(F.lit(1).alias("e"), F.lit(0).alias("m"))
    doubles = doubles.unionByName(keys.where("n_records > 1").select(F.lit(0).alias("e"), F.lit(1).alias("m")))
    doubles = doubles.agg(F.sum("e").alias("e"), F.sum("m").alias("m"))
    # Events are counted per minute before they meet the minutes that have a session.
    active = events.groupBy("user_id", epoch_minute(F.col("event_at_ts")).alias("minute")).agg(F.count(F.lit(1)).alias("n"))
    homeless = active.join(keys.where("n_records > 0"), ["user_id", "minute"], "left_anti").agg(F.sum("n").alias("n"))
    e, m = (F.coalesce(F.col(c), F.lit(0)) for c in ("e", "m"))
    count_checks = [
        (
            doubles,
            [
                quality.CountCheck("events.event_id.unique", e),
                quality.CountCheck("sessionized.event_id.unique", e + m),
            ],
        ),
        (homeless, [quality.CountCheck("sessionized.session_id.not_null", F.col("n"))]),
    ]
    query_checks = [
        quality.accepted_values("events.event_type.accepted_values", events, "event_type", EVENT_TYPES),
        quality.unique("sessions.session_id.unique", facts, "session_id"),
        quality.relationships("sessions.user_id.relationships", facts.withColumn("user_id", account_of(F.col("user_id"))), "user_id", users),
    ]
    return quality.run_checks(row_checks, query_checks, count_checks)


def refresh(
    spark: SparkSession, config: RefreshConfig, raw: DataFrame, products: DataFrame, users: DataFrame
) -> DataFrame:
    """Run all steps in order, stop at the first failure, and return the published fact table.

    Every table is written once and read by the later steps, which scan only the columns they need.
    The raw messages are typed once, and the quarantine is a partition of the validated records. The
    session-event relation is a view: it is checked by what it is made of and computed when read.
    """
    settings = sizing(input_bytes(raw) if config.raw_bytes is None else config.raw_bytes)
    before = {key: spark.conf.get(key) for key in settings}
    # A raw table of few bytes may hold many rows: it gets no fewer tasks than the session's settings give it.
    partitions, scan = "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"
    settings[partitions] = str(max(int(settings[partitions]), int(before[partitions])))
    if settings[scan] == sizing(1)[scan]:
        del settings[scan]
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        facts = _build(spark, config, raw, products, users)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    publish(spark, config)
    return facts


def _build(
    spark: SparkSession, config: RefreshConfig, raw: DataFrame, products: DataFrame, users: DataFrame
) -> DataFrame:
    if not published_runs(spark, config.warehouse).where(F.col("run_id") == config.run_id).isEmpty():
        raise ValueError(f"run {config.run_id} is published already; readers and later runs rely on it")
    previous = published_run(spark, config.warehouse)

    products = write_table(products, config.table("products"))
    users = write_table(users, config.table("users"))
    versions = write_table(
        product_history(spark, config, products, previous), config.table("product_versions")
    )

    bound = config.max_broadcast_bytes
    product_keys = measure(products, PRODUCT_KEY, [], bound)
    user_dim = measure(users, "user_id", ["country"], bound)
    prices = measure(versions, PRODUCT_KEY, ["price", "valid_from", "valid_to"], bound)

    parsed = parse_events(raw, config.min_event_ts)
    validated = write_table(
        validate_events(parsed, product_keys, user_dim),
        config.table("validated"),
        partition_by="is_valid_record",
    )
    events = price_asof(valid_events(validated), prices, config.closed_validity)
    events = write_table(with_visitors(events) if config.split_guests else events, config.table("events"))
    minutes = session_minutes(events, config.gap_minutes, not config.closed_validity)
    minutes = write_table(minutes, config.table("session_minutes"))
    facts = write_table(
        fact_sessions(events, user_dim, config.gap_minutes, minutes=minutes, approx_products=config.approx_products),
        config.table("fact_sessions"),
    )

    checks = write_table(table_checks(events, minutes, facts, user_dim), config.table("checks"))
    quality.require_passed(checks)
    return facts
