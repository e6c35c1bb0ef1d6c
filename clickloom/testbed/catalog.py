"""The named queries: each runs one operator over the whole derived clickstream."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import configure
from clickloom.functions import crossed_seconds, event_timestamp, text_field
from clickloom.operators import quality, scd2, sketches
from clickloom.operators.asof import price_asof, price_asof_sweep
from clickloom.operators.lookup import Dimension, measure, with_unknown_flag
from clickloom.operators.sessions import (
    INSTANT_COLUMNS,
    active_minutes,
    event_gaps,
    products_viewed,
    session_id,
    session_metrics,
    session_minutes,
    sessionize,
    with_visitors,
    with_session_index,
)
from clickloom.plans import increment, staging
from clickloom.plans.marts import enrich_sessions, fact_sessions
from clickloom.plans.refresh import (
    PRODUCT_CHECK,
    PRODUCT_KEY,
    RefreshConfig,
    publish,
    read_published,
    refresh,
    table_checks,
)
from clickloom.schemas import (
    EVENT_TYPES,
    METRIC_COLUMNS,
    PAGE_VIEW,
    PLAIN_TEXT_FIELDS,
    PRODUCT_VIEW,
    SESSION_EVENT_COLUMNS,
)
from clickloom.sources.dimensions import load_dimension, read_csv
from clickloom.sources.messages import DEAD_LETTER, EVENT, parse_messages, read_text, stream_text
from clickloom.sources.raw import read_lake, read_raw, stream_lake
from clickloom.sources.tables import fresh_path, materialize, read_table, write_table
from clickloom.streaming import events as live
from clickloom.streaming.landing import autoload, batch_counts, compact, land_files, land_messages, load_batches, start_table
from clickloom.testbed import recipe

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    """Register a query under ``name``; it runs with the library's session settings."""

    def register(run: Query) -> Query:
        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(configure(spark), sf_dir)

        configured.__doc__ = run.__doc__
        QUERIES[name] = configured
        return run

    return register


# --- relations the queries share -----------------------------------------------------------------


#: Messages in a file of the raw table, about; a task then types or sorts so many.
RAW_FILE_ROWS = 100_000
_TABLES: dict[tuple[str, str, str], str] = {}
_DIMENSIONS: dict[tuple[str, str, str], Dimension] = {}


def _place(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, str, str]:
    return spark.sparkContext.applicationId, sf_dir, name


def _stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> str:
    """Path of a derived input table, written once per application and input folder."""
    place = _place(spark, sf_dir, name)
    if place not in _TABLES:
        path = fresh_path(spark, name)
        write_table(build(), path)
        _TABLES[place] = path
    return _TABLES[place]


def raw_path(spark: SparkSession, sf_dir: str) -> str:
    """The raw table. The given events are one small file; messages arrive in many, more as there are more of them."""

    def build() -> DataFrame:
        messages = spark.read.parquet(f"{sf_dir}/events.parquet").count()
        files = max(spark.sparkContext.defaultParallelism, -(-messages // RAW_FILE_ROWS))
        return recipe.raw_events(spark, sf_dir, files=files)

    return _stored(spark, sf_dir, "raw", build)


def raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, raw_path(spark, sf_dir))


def _dimension(
    spark: SparkSession, sf_dir: str, name: str, build: Query, key: str, columns: list[str]
) -> Dimension:
    """A dimension table, measured when it is loaded."""
    place = _place(spark, sf_dir, name)
    if place not in _DIMENSIONS:
        path = _stored(spark, sf_dir, name, lambda: build(spark, sf_dir))
        _DIMENSIONS[place] = measure(read_table(spark, path), key, columns)
    return _DIMENSIONS[place]


def product_dim(spark: SparkSession, sf_dir: str) -> Dimension:
    return _dimension(spark, sf_dir, "products", recipe.products, "product_id", [])


def user_dim(spark: SparkSession, sf_dir: str) -> Dimension:
    return _dimension(spark, sf_dir, "users", recipe.users, "user_id", ["country"])


def version_dim(spark: SparkSession, sf_dir: str) -> Dimension:
    return _dimension(
        spark,
        sf_dir,
        "product_versions",
        recipe.product_versions,
        "product_id",
        ["price", "valid_from", "valid_to"],
    )


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.parse_events(raw_table(spark, sf_dir), recipe.MIN_EVENT_TS)


def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.validate_events(
        parsed(spark, sf_dir), product_dim(spark, sf_dir), user_dim(spark, sf_dir)
    )


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.valid_events(validated(spark, sf_dir))


def priced(spark: SparkSession, sf_dir: str, closed: bool = False) -> DataFrame:
    return price_asof(valid(spark, sf_dir), version_dim(spark, sf_dir), closed)


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_metrics(session_minutes(priced(spark, sf_dir)))


# --- staging -------------------------------------------------------------------------------------


@query("parse_events")
def run_parse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed fields of every message."""
    return parsed(spark, sf_dir).drop("metadata_filename")


@query("parse_timestamps")
def run_parse_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times from ISO text and from epoch seconds."""
    return parsed(spark, sf_dir).select("metadata_file_row_number", "event_at_ts")


@query("normalize_event_type")
def run_normalize_event_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per lower-cased type."""
    return parsed(spark, sf_dir).groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


@query("filter_cutoff")
def run_filter_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events from the middle of the period on."""
    late = staging.parse_events(raw_table(spark, sf_dir), recipe.PRICE_CHANGE)
    return late.select("event_id", "event_at_ts", "loaded_at")


@query("orphan_events")
def run_orphan_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages whose product is not in the catalogue (NOT IN with three-valued logic)."""
    flagged = with_unknown_flag(
        parsed(spark, sf_dir), product_dim(spark, sf_dir), F.col("product_id"), "product_unknown", "event_id"
    )
    return flagged.where("product_unknown").select(
        "metadata_file_row_number", "event_id", "event_type", "product_id"
    )


@query("validate_events")
def run_validate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validity flag and reason per message."""
    return validated(spark, sf_dir).select(
        "metadata_file_row_number", "event_id", "is_valid_record", "reject_reason"
    )


@query("quarantine")
def run_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that broke a rule."""
    return staging.quarantined_events(validated(spark, sf_dir)).drop("metadata_filename")


@query("dedup_events")
def run_dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest valid copy of each event."""
    return valid(spark, sf_dir).drop("metadata_filename")


# --- prices --------------------------------------------------------------------------------------


@query("price_asof")
def run_price_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events valued at the price of their time; one version per instant."""
    return priced(spark, sf_dir).select("event_id", "product_id", "quantity", "event_at_ts", "value")


@query("price_asof_closed")
def run_price_asof_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with both ends of a version valid."""
    return priced(spark, sf_dir, closed=True).select(
        "event_id", "product_id", "quantity", "event_at_ts", "value"
    )


@query("price_sweep")
def run_price_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events valued by a history of a price a day for each product, in one sweep over events and versions."""
    files = spark.sparkContext.defaultParallelism
    path = _stored(spark, sf_dir, "daily_versions", lambda: recipe.daily_versions(spark, sf_dir, files=files))
    priced_events = price_asof_sweep(materialize(valid(spark, sf_dir), "valid"), read_table(spark, path))
    return priced_events.select("event_id", "product_id", "quantity", "event_at_ts", "value")


@query("scd2_snapshot")
def run_scd2_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product history after two loads: changed, unchanged, new and no longer listed products."""
    return _history(spark, sf_dir)


@query("scd2_current")
def run_scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open versions of that history."""
    return scd2.current_versions(_history(spark, sf_dir))


@query("scd2_point_in_time")
def run_scd2_point_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions valid shortly before the price change."""
    ts = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    return scd2.versions_at(_history(spark, sf_dir), ts).select("product_id", "price", "valid_from")


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = scd2.first_snapshot(
        recipe.first_catalogue(spark, sf_dir), PRODUCT_KEY, F.lit(recipe.FIRST_LOAD).cast("timestamp_ntz")
    )
    return scd2.apply_snapshot(
        first,
        recipe.second_catalogue(spark, sf_dir),
        PRODUCT_KEY,
        PRODUCT_CHECK,
        F.lit(recipe.PRICE_CHANGE).cast("timestamp_ntz"),
    )


# --- sessions ------------------------------------------------------------------------------------


@query("event_gaps")
def run_event_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previous event, gap in minutes and session-start flag per event."""
    return event_gaps(materialize(valid(spark, sf_dir).select(*INSTANT_COLUMNS), "valid"))


@query("session_index")
def run_session_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running session number per event."""
    return with_session_index(materialize(valid(spark, sf_dir).select(*INSTANT_COLUMNS), "valid"))


@query("sessionize")
def run_sessionize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priced events with their session."""
    columns = [name for name in SESSION_EVENT_COLUMNS if name != "session_id"]
    return sessionize(materialize(priced(spark, sf_dir).select(*columns), "priced"))


@query("sessionize_wide_gap")
def run_sessionize_wide_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions with a gap of six hours."""
    events = materialize(valid(spark, sf_dir).select(*INSTANT_COLUMNS), "valid")
    return with_session_index(events, gap_minutes=360).select(
        "event_id", session_id().alias("session_id")
    )


@query("fact_sessions")
def run_fact_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The session fact table."""
    events = materialize(priced(spark, sf_dir).select(*METRIC_COLUMNS), "priced")
    return fact_sessions(events, user_dim(spark, sf_dir))


@query("visitor_sessions")
def run_visitor_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The session fact table with guests told apart by address and agent."""
    events = materialize(with_visitors(priced(spark, sf_dir)).select(*METRIC_COLUMNS), "priced")
    return fact_sessions(events, user_dim(spark, sf_dir))


@query("session_bounds")
def run_session_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics(spark, sf_dir).select("session_id", "session_started_at_ts", "session_ended_at_ts")


@query("session_duration")
def run_session_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics(spark, sf_dir).select("session_id", "session_duration_seconds")


@query("session_event_counts")
def run_session_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct events per session over the closed price join, where events can repeat."""
    counted = session_metrics(session_minutes(priced(spark, sf_dir, closed=True), unique_events=False))
    return counted.select("session_id", "total_events_in_session")


@query("session_revenue")
def run_session_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics(spark, sf_dir).select(
        "session_id", "total_session_revenue", "total_items_added_to_cart"
    )


@query("session_utm")
def run_session_utm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics(spark, sf_dir).select("session_id", "session_utm_source")


@query("session_products_viewed")
def run_session_products_viewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct products viewed, for sessions with a view."""
    events = materialize(priced(spark, sf_dir).select(*METRIC_COLUMNS), "priced")
    views = products_viewed(events, materialize(active_minutes(events), "active-minutes"))
    return views.select(session_id().alias("session_id"), "distinct_products_viewed")


@query("approx_products_viewed")
def run_approx_products_viewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct products viewed by session, country and day, and whether the merged sketches' estimate is near the count."""
    events = materialize(priced(spark, sf_dir).select(*METRIC_COLUMNS), "priced")
    minutes = materialize(session_minutes(events), "session-minutes")
    viewed = materialize(sketches.viewed_sketches(events), "viewed-sketches")
    users = user_dim(spark, sf_dir)
    day = F.to_date(F.timestamp_seconds(F.col("minute") * 60))
    of_country = enrich_sessions(viewed.withColumn("session_id", F.lit("")), users)
    found = [
        sketches.session_sketches(viewed, minutes).select(F.lit("session").alias("level"), session_id().alias("name"), "viewed"),
        sketches.united(of_country, F.lit("country").alias("level"), F.col("user_country").alias("name")),
        sketches.united(viewed, F.lit("day").alias("level"), day.cast("string").alias("name")),
    ]
    estimates = reduce(DataFrame.unionByName, found).select("level", "name", sketches.estimate().alias("estimate"))
    views = events.where((F.col("event_type") == PRODUCT_VIEW) & F.col("product_id").isNotNull())
    views = enrich_sessions(with_session_index(views, minutes=minutes).withColumn("session_id", session_id()), users)
    groups = [("session", F.col("session_id")), ("country", F.col("user_country")), ("day", F.to_date("event_at_ts").cast("string"))]
    of_groups = F.explode(F.array(*[F.struct(F.lit(level).alias("level"), name.alias("name")) for level, name in groups]))
    counts = views.select(of_groups.alias("g"), "product_id").groupBy("g.level", "g.name").agg(F.countDistinct("product_id").alias("distinct_products"))
    same = (counts["level"] == estimates["level"]) & counts["name"].eqNullSafe(estimates["name"])
    error = F.abs(F.col("estimate") - F.col("distinct_products"))
    near = error <= F.greatest(F.lit(0.5), 4 * sketches.relative_error() * F.col("distinct_products"))
    return counts.join(estimates, same, "left").select(counts["level"], counts["name"], "distinct_products", F.coalesce(near, F.lit(False)).alias("near"))


@query("enrich_sessions")
def run_enrich_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions with the country of their user."""
    return enrich_sessions(metrics(spark, sf_dir), user_dim(spark, sf_dir)).select(
        "session_id", "user_id", "user_country"
    )


# --- dimensions and set operations ---------------------------------------------------------------


@query("dim_products")
def run_dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products written as CSV and loaded back with their schema."""
    return _through_csv(spark, recipe.products(spark, sf_dir), "products")


@query("dim_users")
def run_dim_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users written as CSV and loaded back; the guest's blank fields are null."""
    return _through_csv(spark, recipe.users(spark, sf_dir), "users")


def _through_csv(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = fresh_path(spark, f"{name}-csv")
    df.write.csv(path, header=True)
    return load_dimension(read_csv(spark, path, df.schema), fresh_path(spark, name))


@query("union_all")
def run_union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event ids and the ids of guests' events with the user left null, without removing doubles."""
    return _united(spark, sf_dir)


@query("union_all_equal")
def run_union_all_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An equality filter over that relation; rows without a user do not pass."""
    return _united(spark, sf_dir).where(F.col("user_id") == "guest")


def _united(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = parsed(spark, sf_dir)
    named = events.select("event_id", "user_id")
    guests = events.where(F.col("user_id") == "guest").select(
        "event_id", F.lit(None).cast("string").alias("user_id")
    )
    return named.unionByName(guests)


# --- data quality --------------------------------------------------------------------------------


@query("dq_unique")
def run_dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicated(parsed(spark, sf_dir), "event_id")


@query("dq_not_null")
def run_dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing(parsed(spark, sf_dir), "product_id").select(
        "metadata_file_row_number", "event_id", "event_type"
    )


@query("dq_not_null_where")
def run_dq_not_null_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = ~F.col("event_type").isin(PAGE_VIEW)
    return quality.missing(parsed(spark, sf_dir), "product_id", where).select(
        "metadata_file_row_number", "event_id", "event_type"
    )


@query("dq_accepted_values")
def run_dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types as sent, before they are lower-cased."""
    sent = raw_table(spark, sf_dir).select(
        text_field(F.col("raw_data"), "event_type").alias("event_type")
    )
    return quality.unaccepted(sent, "event_type", EVENT_TYPES)


@query("dq_relationships")
def run_dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.orphaned(parsed(spark, sf_dir), "user_id", user_dim(spark, sf_dir))


@query("dq_positive_duration")
def run_dq_positive_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions that end before they start. There are none, so every seventh one's ends are swapped first."""
    start, end = F.col("session_started_at_ts"), F.col("session_ended_at_ts")
    swapped = F.col("session_index") % 7 == 0
    seconds = F.when(swapped, crossed_seconds(end, start)).otherwise(crossed_seconds(start, end))
    sessions = metrics(spark, sf_dir).select("session_id", seconds.alias("session_duration_seconds"))
    return quality.violating(sessions, F.col("session_duration_seconds") < 0)


@query("dq_suite")
def run_dq_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks of the event, session-event and session tables."""
    events = materialize(priced(spark, sf_dir).select(*METRIC_COLUMNS), "priced")
    users = user_dim(spark, sf_dir)
    minutes = materialize(session_minutes(events), "session-minutes")
    facts = materialize(fact_sessions(events, users, minutes=minutes), "facts")
    return table_checks(events, minutes, facts, users)


@query("dq_suite_dirty")
def run_dq_suite_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same kinds of checks over the records before validation, where they fail."""
    events = materialize(parsed(spark, sf_dir), "parsed")
    product_rule = quality.not_null(
        "product_id.not_null", "product_id", ~F.col("event_type").isin(PAGE_VIEW), quality.WARN
    )
    return quality.run_checks(
        [(events, [quality.not_null("event_id.not_null", "event_id"), product_rule])],
        [
            quality.unique("event_id.unique", events, "event_id"),
            quality.accepted_values("event_type.accepted_values", events, "event_type", EVENT_TYPES),
            quality.relationships(
                "user_id.relationships", events, "user_id", user_dim(spark, sf_dir), quality.WARN
            ),
        ],
    )


# --- ingestion -----------------------------------------------------------------------------------


MESSAGE_FILES = 8


def _message_files(spark: SparkSession, sf_dir: str) -> str:
    """Messages, cut-off ones among them, as text files."""
    path = fresh_path(spark, "messages")
    messages = recipe.messages(spark, sf_dir, malformed=True).select("value")
    messages.repartition(MESSAGE_FILES).write.text(path)
    return path


def _landed(spark: SparkSession, sf_dir: str) -> str:
    """Folder of a lake the messages were landed in, file by file: as many batches as there are files."""
    lake = fresh_path(spark, "lake")
    source = stream_text(spark, _message_files(spark, sf_dir), max_files=1)
    land_messages(source, lake, fresh_path(spark, "lake-offsets"), continuous=False).awaitTermination()
    return lake


def _loaded(spark: SparkSession, sf_dir: str) -> str:
    """Folder of a raw table loaded from that lake in steps, then again, then closed, then loaded once more."""
    lake, raw = _landed(spark, sf_dir), fresh_path(spark, "raw")
    for _ in range(2):
        load_batches(spark, lake, raw, max_batches=3)
    compact(spark, lake, raw, before="2999-01-01")
    load_batches(spark, lake, raw)
    return raw


def _autoloaded(spark: SparkSession, sf_dir: str) -> str:
    """Folder of a raw table a stream of files loaded from that lake in several batches, then again, then closed."""
    lake, raw = _landed(spark, sf_dir), fresh_path(spark, "raw")
    # The second run finds no new files; the third has a new checkpoint and loads every batch once more.
    first, other = fresh_path(spark, "raw-offsets"), fresh_path(spark, "raw-offsets")
    for checkpoint in (first, first, other):
        files = stream_lake(spark, lake, max_files=3)
        autoload(files, lake, raw, checkpoint, continuous=False).awaitTermination()
    compact(spark, lake, raw, before="2999-01-01")
    return raw


@query("ingest_json")
def run_ingest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text fields of the messages a stream landed in the lake."""
    return _message_fields(spark, _landed(spark, sf_dir))


def _message_fields(spark: SparkSession, lake: str) -> DataFrame:
    fields = [*PLAIN_TEXT_FIELDS, "event_type", "user_id", "event_timestamp"]
    events = read_lake(spark, lake).where(F.col("kind") == EVENT)
    return events.select(*[text_field(F.col("raw_data"), name).alias(name) for name in fields])


@query("ingest_files")
def run_ingest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text fields of the messages of files that were landed, in steps, and moved away."""
    lake = fresh_path(spark, "lake")
    land_files(spark, _message_files(spark, sf_dir), lake, fresh_path(spark, "landed-files"), max_files=3)
    return _message_fields(spark, lake)


@query("ingest_malformed")
def run_ingest_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters of the same stream."""
    lake = _landed(spark, sf_dir)
    return read_lake(spark, lake).where(F.col("kind") == DEAD_LETTER).select("raw_text")


@query("ingest_ragged")
def run_ingest_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch parse of the text files; absent keys read as null."""
    parsed_messages = parse_messages(read_text(spark, _message_files(spark, sf_dir)))
    raw = F.col("raw_data")
    return parsed_messages.where(F.col("kind") == EVENT).select(
        text_field(raw, "event_id").alias("event_id"),
        text_field(raw, "order_id").alias("order_id"),
        text_field(raw, "utm_campaign").alias("utm_campaign"),
        F.try_variant_get(raw, "$.quantity", "int").alias("quantity"),
    )


@query("ingest_roundtrip")
def run_ingest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream to the lake, stream on to the raw table, parse: the typed events as one summary."""
    raw = read_raw(spark, _autoloaded(spark, sf_dir))
    return (
        staging.parse_events(raw, recipe.MIN_EVENT_TS)
        .groupBy("event_type", "platform")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.countDistinct("event_id").alias("event_ids"),
            F.sum("quantity").alias("quantity"),
            F.min("event_at_ts").alias("first_at"),
            F.max("event_at_ts").alias("last_at"),
        )
    )


@query("ingest_partitions")
def run_ingest_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per local load date in the lake; they load a quarter of an hour apart around both clock changes."""
    number = F.get_json_object("value", "$.event_id").cast("bigint")
    hours = F.pmod(number, F.lit(192)) * F.expr("interval 15 minutes")
    change = F.when(number % 2 == 0, F.lit("2024-03-30 00:00:00")).otherwise(F.lit("2024-10-26 00:00:00"))
    source = stream_text(spark, _message_files(spark, sf_dir))
    lake = fresh_path(spark, "lake")
    land_messages(
        source, lake, fresh_path(spark, "lake-offsets"), continuous=False, loaded_at=change.cast("timestamp") + hours
    ).awaitTermination()
    landed = read_lake(spark, lake).where(F.col("kind") == EVENT)
    return landed.groupBy("ingest_date").agg(F.count("raw_data").alias("events"))


@query("ingest_metrics")
def run_ingest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Received, written and malformed messages over all batches, with a progress buffer of two batches."""
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(kept)
    spark.conf.set(kept, "2")
    try:
        lake = _landed(spark, sf_dir)
    finally:
        spark.conf.set(kept, before)
    counts = batch_counts(read_lake(spark, lake))
    return counts.agg(F.count(F.lit(1)).alias("batches"), *[F.sum(c).alias(c) for c in ("received", "written", "malformed")])


@query("ingest_continuous")
def run_ingest_continuous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages by kind that the ten-second trigger has landed when the inbox is worked off."""
    lake = fresh_path(spark, "lake")
    stream = land_messages(stream_text(spark, _message_files(spark, sf_dir)), lake, fresh_path(spark, "lake-offsets"))
    try:
        stream.processAllAvailable()
    finally:
        stream.stop()
    return read_lake(spark, lake).groupBy("kind").agg(F.count(F.lit(1)).alias("messages"))


@query("raw_autoload")
def run_raw_autoload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in the raw table after several runs of the loader."""
    raw = read_raw(spark, _loaded(spark, sf_dir))
    data = F.col("raw_data")
    return raw.select(
        text_field(data, "event_id").alias("event_id"),
        text_field(data, "event_timestamp").alias("event_timestamp"),
    )


@query("raw_metadata")
def run_raw_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load metadata: each row has a file, a row in it that no other row has, and a load time."""
    raw = read_raw(spark, _loaded(spark, sf_dir))
    return raw.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("metadata_filename", "metadata_file_row_number").alias("distinct_positions"),
        # The path tells the file's kind, load date and batch in the lake.
        F.count_if(F.col("metadata_filename").rlike(r"/kind=event/ingest_date=[0-9-]+/batch=\w+-[0-9]+/part-")).alias("with_path"),
        F.countDistinct(F.regexp_extract("metadata_filename", "batch=([^/]+)", 1)).alias("batches"),
        F.count("loaded_at").alias("with_load_time"),
    )


# --- streams -------------------------------------------------------------------------------------


ARRIVALS, ARRIVAL_FILES, ARRIVAL_DAYS = 6, 4, 5
# Repeated copies arrive one batch, at most ten days, after the first ones.
LATENESS = "11 days"


def _arrivals(spark: SparkSession, sf_dir: str) -> str:
    """The raw table as it arrives: five days at a time, repeated copies one step after the first ones."""

    def build(path: str) -> None:
        raw = raw_table(spark, sf_dir)
        number = F.col("metadata_file_row_number")
        at = event_timestamp(text_field(F.col("raw_data"), "event_timestamp"))
        step = F.datediff(at, F.lit("2024-01-01").cast("date")) / ARRIVAL_DAYS
        step = F.least(F.floor(step), F.lit(ARRIVALS - 1)) + (number % 20 == 7).cast("int")
        # A folder a step: each is read once.
        rows = write_table(raw.withColumn("step", step), fresh_path(spark, "arrivals"), partition_by="step")
        for i in range(ARRIVALS + 1):
            part = rows.where(F.col("step") == i).drop("step").repartition(_arrival_files(spark, sf_dir))
            part.write.mode("append").parquet(path)

    place = _place(spark, sf_dir, "arrivals")
    if place not in _TABLES:
        path = fresh_path(spark, "arrivals")
        build(path)
        _TABLES[place] = path
    return _TABLES[place]


def _arrival_files(spark: SparkSession, sf_dir: str) -> int:
    """Files of an arrival, all taken in one micro-batch."""
    return max(ARRIVAL_FILES, -(-raw_table(spark, sf_dir).count() // ((ARRIVALS + 1) * RAW_FILE_ROWS)))


def _raw_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed events in seven micro-batches."""
    path = _arrivals(spark, sf_dir)
    reader = spark.readStream.schema(read_table(spark, path).schema)
    reader = reader.option("maxFilesPerTrigger", _arrival_files(spark, sf_dir))
    return live.stream_events(reader.parquet(path), recipe.MIN_EVENT_TS)


def _run(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """The rows a stream emits in append mode."""
    path = fresh_path(spark, name)
    start_table(stream, path, fresh_path(spark, f"{name}-offsets"), continuous=False).awaitTermination()
    return spark.read.schema(stream.schema).option("recursiveFileLookup", "true").parquet(f"{path}/open")


@query("stream_dedup")
def run_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that pass the streaming de-duplication: the copies that arrived first."""
    copies = live.first_copies(_raw_stream(spark, sf_dir), LATENESS)
    return _run(spark, copies.drop("event_at", "event_minute"), "first-copies").select("event_id", "event_at_ts")


@query("stream_sessions")
def run_stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of valid, distinct events that a stream has closed by its end."""
    events = live.valid_stream(_raw_stream(spark, sf_dir), product_dim(spark, sf_dir), user_dim(spark, sf_dir))
    return _run(spark, live.live_sessions(events, LATENESS), "live-sessions")


@query("stream_quarantine")
def run_stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records a stream routed, by validity and reason."""
    path = fresh_path(spark, "routed")
    events = _raw_stream(spark, sf_dir).drop("event_at", "event_minute")
    live.route_events(
        events,
        product_dim(spark, sf_dir),
        user_dim(spark, sf_dir),
        path,
        fresh_path(spark, "routed-offsets"),
        continuous=False,
    ).awaitTermination()
    return _routed_counts(live.read_routed(spark, path))


def _routed_counts(routed: DataFrame) -> DataFrame:
    return routed.groupBy("is_valid_record", "reject_reason").agg(
        F.count(F.lit(1)).alias("events"), F.min("event_id").alias("first_event_id")
    )


@query("stream_quarantine_published")
def run_stream_quarantine_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records routed by the dimensions as published: the first batches know half the products, then all are published."""
    warehouse, path, offsets = fresh_path(spark, "warehouse"), fresh_path(spark, "routed"), fresh_path(spark, "routed-offsets")
    everything = product_dim(spark, sf_dir).df
    number = F.substring_index("product_id", "-", -1).cast("long")
    arrivals = read_table(spark, _arrivals(spark, sf_dir))
    inbox = fresh_path(spark, "inbox")
    last = arrivals.agg(F.max("metadata_file_row_number")).first()[0] or 0
    for run, known, late in (("1", everything.where(number % 2 == 0), False), ("2", everything, True)):
        config = RefreshConfig(warehouse, run, recipe.FIRST_LOAD)
        write_table(known, config.table("products"))
        write_table(user_dim(spark, sf_dir).df, config.table("users"))
        publish(spark, config)
        part = arrivals.where((F.col("metadata_file_row_number") * 2 > last) == late)
        part.write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(arrivals.schema).parquet(inbox)
        events = live.stream_events(stream, recipe.MIN_EVENT_TS).drop("event_at", "event_minute")
        live.route_published(events, warehouse, path, offsets, continuous=False).awaitTermination()
    return _routed_counts(live.read_routed(spark, path))


# --- the whole job -------------------------------------------------------------------------------


def _refreshed(spark: SparkSession, sf_dir: str) -> str:
    """Two published runs: one at the first prices, one after the raise."""
    warehouse = fresh_path(spark, "warehouse")
    raw = raw_table(spark, sf_dir)
    users = recipe.users(spark, sf_dir)
    for run_id, loaded_at, load in [
        ("1", recipe.FIRST_LOAD, recipe.products),
        ("2", recipe.PRICE_CHANGE, recipe.raised_products),
    ]:
        config = RefreshConfig(warehouse, run_id, loaded_at, recipe.MIN_EVENT_TS)
        refresh(spark, config, raw, load(spark, sf_dir), users)
    return warehouse


@query("refresh_facts")
def run_refresh_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published session facts after two scheduled runs."""
    return read_published(spark, _refreshed(spark, sf_dir), "fact_sessions")


PARTS = 3


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table with ``part``: rows come in order of their numbers, every eleventh one part late, repeated copies as they do."""
    raw = raw_table(spark, sf_dir)
    number = F.col("metadata_file_row_number")
    last = raw.agg(F.max(number)).first()[0] or 0
    part = F.floor(number * PARTS / (last + 1)) + (number % 11 == 5).cast("int")
    return raw.withColumn("part", F.least(part, F.lit(PARTS - 1)))


def _advanced(spark: SparkSession, sf_dir: str) -> str:
    """A state built in parts. The first run knows two thirds of the products, the second all."""
    place = _place(spark, sf_dir, "increments")
    if place in _TABLES:
        return _TABLES[place]
    folder = fresh_path(spark, "increments")
    # A folder a part, so that a run reads its own rows only.
    raw = write_table(_parts(spark, sf_dir), fresh_path(spark, "parts"), partition_by="part")
    users, versions = user_dim(spark, sf_dir).df, version_dim(spark, sf_dir).df
    all_products = product_dim(spark, sf_dir).df
    some = all_products.where(F.substring_index("product_id", "-", -1).cast("long") % 3 != 0)
    for part in range(PARTS):
        rows = raw.where(F.col("part") == part).drop("part")
        increment.advance(spark, folder, f"part-{part}", rows, all_products if part else some, users, versions, recipe.MIN_EVENT_TS)
    _TABLES[place] = folder
    return folder


@query("increment_sessions")
def run_increment_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session facts from runs over parts of the raw table, with late and repeated events and late products."""
    return increment.session_facts(spark, _advanced(spark, sf_dir), user_dim(spark, sf_dir))


@query("increment_events")
def run_increment_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest valid copy of each event from the same runs."""
    return increment.latest_events(spark, _advanced(spark, sf_dir)).drop("metadata_filename", "value")


@query("increment_checks")
def run_increment_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suite of those runs, from the states of runs and days."""
    return increment.checks(spark, _advanced(spark, sf_dir), user_dim(spark, sf_dir))


@query("refresh_quarantine")
def run_refresh_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published quarantine after two scheduled runs."""
    published = read_published(spark, _refreshed(spark, sf_dir), "quarantine")
    return published.select("metadata_file_row_number", "event_id", "reject_reason")
