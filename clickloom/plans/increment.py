"""The session facts in increments: a run takes new raw rows only, and ends where a refresh of all rows would.

What is carried from run to run lies below one folder, in tables of which every part is written by one run:

* ``copies``: valid, priced events by event day, ``superseded`` those a newer copy has replaced since;
* ``filters``: a Bloom filter of each run's event ids. New ids are asked against all of them, and only runs that may
  hold one of them are read for the older copy;
* ``minutes`` and ``views``: totals and viewed products of every active minute, by day, with the session's number and
  the state of the user just before the minute;
* ``tails`` and ``seen``: each user's state after the last minute, and the products of the session still open;
* ``facts``: sessions by the day they start, ``rejected``: what is in quarantine;
* ``event_checks``, ``minute_checks``, ``fact_checks``: counts from which the checks of the whole tables are put
  together, one set for each run's events and for each day of minutes and facts.

A user whose new events all lie after the tail goes on from there. Where an event comes late, or a newer copy takes
another's place, the user's minutes from there on are numbered anew, from the state that the first of them carries.
So a run reads the new rows, the days in which minutes change, and later days of late users only; a session without
an end, as of the shared guest, is carried on by its totals and never read again.

A run is published by one small row once all its parts are written. It may be repeated until then, and readers see
the state of the last published run throughout.

Dimensions may grow: rows in quarantine are judged anew when their product or user is published. Where a key is
gone, or a price has changed for times already loaded, events long counted would change: the run then stops, and the
state is to be built anew from all raw rows in an empty folder.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions import crossed_seconds, epoch_minute
from clickloom.operators import bloom, quality
from clickloom.operators.asof import price_asof
from clickloom.operators.dedup import latest_copy, newest_first
from clickloom.operators.lookup import MAX_BROADCAST_BYTES, Dimension, measure, without_parent
from clickloom.operators.sessions import minute_totals, minute_views, session_id
from clickloom.plans.marts import FACT_COLUMNS, enrich_sessions
from clickloom.plans.refresh import event_rules, fact_rules
from clickloom.plans.staging import parse_events, validate_events
from clickloom.schemas import DEFAULT_MIN_EVENT_TS, EVENT_TYPES, SESSION_GAP_MINUTES, VALIDATED_SCHEMA
from clickloom.sources.dated import exists
from clickloom.sources.tables import materialize, read_table, write_table

#: Largest table of a run's own that is broadcast, by this module and by Spark's choice: all of them go through the driver.
HINTED_BYTES = 4 * 1024 * 1024
SPARK_BROADCAST_BYTES = 1024 * 1024
DAY, RUN = "day", "run"
_TOTALS = "first_ts timestamp_ntz, last_ts timestamp_ntz, events long, revenue decimal(31,2), items_added long, utm_source string"
#: A user's state after a minute: the session it lies in, with its totals so far.
_STATE = (
    "minute long, session_index long, started_at timestamp_ntz, ended_at timestamp_ntz, events long, "
    "revenue decimal(38,2), items_added long, utm_source string, products long"
)
_VALID = T.StructType([f for f in VALIDATED_SCHEMA if f.name not in ("reject_reason", "is_valid_record")])
_SCHEMAS = {
    "copies": T.StructType([*_VALID, T.StructField("value", T.DecimalType(21, 2))]),
    "superseded": "event_id string, old_run string",
    "rejected": T.StructType([f for f in VALIDATED_SCHEMA if f.name != "is_valid_record"]),
    "minutes": f"user_id string, minute long, {_TOTALS}, session_index long, before struct<{_STATE}>",
    "views": "user_id string, minute long, product_id string",
    "facts": f"user_id string, {_STATE}",
    "minute_checks": "name string, value string, n long",
    "fact_checks": "name string, value string, n long",
}
_WHOLE = {
    "filters": "blocks long, block long, words array<long>",
    "tails": f"user_id string, tail struct<{_STATE}>",
    "seen": "user_id string, product_id string, minute long",
    "event_checks": "name string, value string, n long",
}
#: Columns of an event that its rules, and its minute, need.
_CHECKED = ["event_id", "user_id", "event_at_ts", "event_type", "product_id"]


class DimensionsChanged(ValueError):
    """Events that are counted already would change; the state must be built anew."""


@dataclass
class State:
    """The parts that make up the carried tables: of a day, one run's part or, for tables that only grow, several."""

    spark: SparkSession
    folder: str
    runs: list[str]
    parts: dict[str, set[tuple[str, str]]]

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> State:
        """The state of the last published run, or an empty one."""
        parts: dict[str, set[tuple[str, str]]] = {name: set() for name in _SCHEMAS}
        if not exists(spark, f"{folder}/published"):
            return cls(spark, folder, [], parts)
        listed = read_table(spark, f"{folder}/published").orderBy("published_at").collect()
        runs = [row["run_id"] for row in listed]
        for row in read_table(spark, f"{folder}/parts/{RUN}={runs[-1]}").collect():  # a row a table and day
            parts[row["name"]].add((row[DAY], row["part"]))
        return cls(spark, folder, runs, parts)

    def days(self, name: str) -> set[str]:
        return {day for day, _ in self.parts[name]}

    def read(self, name: str, days: Iterable[str] | None = None, runs: Iterable[str] | None = None) -> DataFrame:
        """Rows of a table with ``day`` and ``run``, from the parts of these days and runs alone."""
        schema = _SCHEMAS[name]
        schema = T.StructType(list(schema.fields)) if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        schema = schema.add(RUN, T.StringType()).add(DAY, T.DateType())
        wanted, of_runs = None if days is None else set(days), None if runs is None else set(runs)
        found = sorted(p for p in self.parts[name] if (wanted is None or p[0] in wanted) and (of_runs is None or p[1] in of_runs))
        if not found:
            return self.spark.createDataFrame([], schema)
        top = f"{self.folder}/{name}"
        paths = [f"{top}/{RUN}={run}/{DAY}={day}" for day, run in found]
        return self.spark.read.schema(schema).option("basePath", top).parquet(*paths)

    def read_whole(self, name: str, runs: Iterable[str]) -> DataFrame:
        """Rows of a table that a run writes as a whole, with ``run``."""
        schema = T.StructType.fromDDL(_WHOLE[name]).add(RUN, T.StringType())
        paths = [f"{self.folder}/{name}/{RUN}={run}" for run in runs]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.folder}/{name}").parquet(*paths)

    def write(self, df: DataFrame, name: str, run: str, day: Column, replaces: Iterable[str] | None = None) -> None:
        """Write a run's part of a table, in place of all parts of the days it ``replaces``, or besides the others."""
        path = f"{self.folder}/{name}/{RUN}={run}"
        write_table(df.withColumn(DAY, day), path, partition_by=DAY, rebalance=True)
        written = self.spark.read.schema(f"{DAY} date").parquet(path).select(DAY).distinct().collect()
        gone = set() if replaces is None else set(replaces)
        self.parts[name] = {p for p in self.parts[name] if p[0] not in gone} | {(str(row[DAY]), run) for row in written}

    def publish(self, run: str) -> None:
        rows = [(name, day, part) for name, parts in self.parts.items() for day, part in sorted(parts)]
        listed = self.spark.createDataFrame(rows, f"name string, {DAY} string, part string")
        write_table(listed.coalesce(1), f"{self.folder}/parts/{RUN}={run}")
        row = self.spark.range(1).select(F.lit(run).alias("run_id"), F.current_timestamp().alias("published_at"))
        row.coalesce(1).write.mode("append").parquet(f"{self.folder}/published")
        self.runs.append(run)


@dataclass(frozen=True)
class Report:
    """What a run did: rows taken and replaced, and how much of the state it had to read."""

    gained: int
    superseded: int
    runs_held: int
    runs_read: int
    days_held: int
    days_read: int


def _day(minute: Column) -> Column:
    return F.to_date(F.timestamp_seconds(minute * 60))


def _days(*rows: DataFrame) -> set[str]:
    """The days of column ``day``: as many as the calendar has."""
    return {str(row[0]) for df in rows for row in df.select(DAY).distinct().collect() if row[0] is not None}


def _between(days: set[str], first: str | None, last: str | None = None) -> set[str]:
    return {d for d in days if first is not None and first <= d and (last is None or d <= last)}


def _hinted(rows: DataFrame, key: str = "user_id") -> DataFrame:
    """Written rows, broadcast if they are small: a run does so for several tables of its users."""
    return measure(rows, key, max_broadcast_bytes=HINTED_BYTES).hinted()


def _keys_added(state: State, name: str, key: str, now: Dimension) -> bool:
    """Whether a dimension has new keys; those it had must still be there, and the null key as before."""
    before = read_table(state.spark, f"{state.folder}/dimensions/{RUN}={state.runs[-1]}/{name}")
    old = measure(before, key, [])
    gone = old.keys().distinct().join(now.distinct_keys, key, "left_anti")
    if old.has_null_key != now.has_null_key or (old.rows == 0) != (now.rows == 0) or not gone.isEmpty():
        raise DimensionsChanged(f"keys of {name} are gone, or its null key has changed")
    return not now.distinct_keys.join(old.keys(), key, "left_anti").isEmpty()


def _prices_unchanged(state: State, versions: DataFrame) -> None:
    """Stop if a price differs for a time that is loaded: versions may only change after the last event."""
    columns = ["product_id", "price", "valid_from", "valid_to"]
    before = read_table(state.spark, f"{state.folder}/dimensions/{RUN}={state.runs[-1]}/versions").select(*columns)
    last = max(state.days("copies"), default=None)
    if last is None:
        return
    until = state.read("copies", [last]).agg(F.max("event_at_ts")).first()[0]
    if until is None:
        return
    # What is valid up to then: versions that begin later don't count, nor does how long a version lasts after it.
    end = F.lit(until).cast("timestamp_ntz")

    def effective(df: DataFrame) -> DataFrame:
        known = df.select(*columns).where(F.col("valid_from") <= end)
        return known.withColumn("valid_to", F.when(F.col("valid_to") <= end, F.col("valid_to")))

    old, new = effective(before), effective(versions)
    changed = new.exceptAll(old).unionByName(old.exceptAll(new)).select("product_id").distinct()
    changed = materialize(changed, "increment-repriced")
    if not changed.isEmpty() and not state.read("copies").join(changed, "product_id", "left_semi").isEmpty():
        raise DimensionsChanged("prices have changed for times that are loaded")


def merge_copies(state: State, fresh: DataFrame, run: str) -> tuple[DataFrame, DataFrame, int]:
    """Rows of ``fresh`` (written, one a key) that are the latest copy, the stored rows they replace, and the number of runs read.

    ``superseded`` rows have old_run and the columns in ``_CHECKED``.
    """
    found = materialize(bloom.suspects(fresh, "event_id", state.read_whole("filters", state.runs), RUN), "increment-suspects")
    runs = [row[RUN] for row in found.select(RUN).distinct().collect()]
    columns = [*fresh.columns, RUN]
    stored = state.read("copies", runs=runs).select(*columns).join(found, ["event_id", RUN], "left_semi")
    asked = fresh.join(found.select("event_id").distinct(), "event_id", "left_semi").withColumn(RUN, F.lit(None).cast("string"))
    # Of equal copies the stored one stays. A stored row that was replaced before never comes first.
    of_id = Window.partitionBy("event_id").orderBy(*newest_first(), F.col(RUN).asc_nulls_last())
    rivals = stored.unionByName(asked.select(*columns)).withColumn("rank", F.row_number().over(of_id))
    rivals = rivals.withColumn("first_run", F.first(RUN).over(of_id))
    rivals = materialize(rivals.select(*_CHECKED, RUN, "rank", "first_run"), "increment-rivals")
    beaten = rivals.where(F.col(RUN).isNull() & (F.col("rank") > 1)).select("event_id")
    gained = fresh.join(beaten, "event_id", "left_anti")
    superseded = rivals.where(F.col(RUN).isNotNull() & (F.col("rank") == 2) & F.col("first_run").isNull())
    return gained, superseded.select(F.col(RUN).alias("old_run"), *_CHECKED), len(runs)


def number_from(rows: DataFrame, views: DataFrame, seen: DataFrame, gap_minutes: int) -> tuple[DataFrame, DataFrame]:
    """Minutes of users with session numbers, the state before and after each, and the first views of each session.

    ``rows``: user_id, minute, totals, and ``carried``, the user's state before all of them. ``seen``: user_id and
    product_id of what the carried session had seen. The second table has user_id, session_index, product_id, minute.
    """
    by_user = Window.partitionBy("user_id").orderBy("minute")
    so_far = by_user.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    idle = F.col("minute") - F.coalesce(F.lag("minute").over(by_user), F.col("carried.minute"))
    numbered = rows.withColumn("starts", F.when(idle <= gap_minutes, 0).otherwise(1))
    numbered = numbered.withColumn("begun", F.sum("starts").over(so_far))
    numbered = numbered.withColumn("session_index", F.coalesce("carried.session_index", F.lit(0).cast("long")) + F.col("begun"))
    numbered = materialize(numbered.drop("starts"), "increment-numbered")

    of_session = views.join(numbered.select("user_id", "minute", "session_index", "begun"), ["user_id", "minute"])
    firsts = of_session.groupBy("user_id", "session_index", "begun", "product_id").agg(F.min("minute").alias("minute"))
    known = seen.select("user_id", "product_id", F.lit(0).cast("long").alias("begun"))
    firsts = materialize(firsts.join(known, ["user_id", "product_id", "begun"], "left_anti"), "increment-firsts")
    new = firsts.groupBy("user_id", "minute").agg(F.count("*").alias("new_products"))

    by_session = Window.partitionBy("user_id", "session_index").orderBy("minute").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joins = F.col("begun") == 0

    def carried(name: str) -> Column:
        return F.when(joins, F.col(f"carried.{name}"))

    def added(own: str, name: str) -> Column:
        """Running total of the session, with what is carried; nulls are left out."""
        own, before = F.sum(own).over(by_session), carried(name)
        return F.coalesce(own + before, own, before)

    after = F.struct(
        "minute",
        "session_index",
        F.coalesce(carried("started_at"), F.min("first_ts").over(by_session)).alias("started_at"),
        F.max("last_ts").over(by_session).alias("ended_at"),
        added("events", "events").alias("events"),
        added("revenue", "revenue").cast("decimal(38,2)").alias("revenue"),
        added("items_added", "items_added").alias("items_added"),
        F.greatest(F.max("utm_source").over(by_session), carried("utm_source")).alias("utm_source"),
        added("new_products", "products").alias("products"),
    )
    whole = numbered.join(new, ["user_id", "minute"], "left").fillna(0, ["new_products"]).withColumn("after", after)
    whole = whole.withColumn("before", F.coalesce(F.lag("after").over(by_user), F.col("carried")))
    return materialize(whole, "increment-minutes"), firsts


def advance(
    spark: SparkSession,
    folder: str,
    run_id: str,
    raw: DataFrame,
    products: DataFrame,
    users: DataFrame,
    versions: DataFrame,
    min_event_ts: str | None = DEFAULT_MIN_EVENT_TS,
    gap_minutes: int = SESSION_GAP_MINUTES,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> Report:
    """Take raw rows that no run has taken before, and publish the state with them."""
    state = State.load(spark, folder)
    if run_id in state.runs:
        raise ValueError(f"run {run_id} is published already")
    with _small_broadcasts(spark):
        return _advance(state, run_id, raw, products, users, versions, min_event_ts, gap_minutes, max_broadcast_bytes)


@contextmanager
def _small_broadcasts(spark: SparkSession) -> Iterator[None]:
    """Let Spark broadcast small tables only: it goes by a file's size, and packed rows are many times that."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    bound = int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    spark.conf.set(name, str(min(bound, SPARK_BROADCAST_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _advance(
    state: State,
    run_id: str,
    raw: DataFrame,
    products: DataFrame,
    users: DataFrame,
    versions: DataFrame,
    min_event_ts: str | None,
    gap_minutes: int,
    max_broadcast_bytes: int,
) -> Report:
    spark, folder, held = state.spark, state.folder, len(state.runs)
    fresh = _judge(state, run_id, raw, products, users, versions, min_event_ts, max_broadcast_bytes)
    gained, superseded, runs_read = merge_copies(state, fresh, run_id)
    superseded = materialize(superseded.withColumn(DAY, F.to_date("event_at_ts")), "increment-superseded")
    state.write(superseded.select("event_id", "old_run", DAY), "superseded", run_id, F.col(DAY))
    state.write(gained, "copies", run_id, F.to_date("event_at_ts"))
    gained = state.read("copies", runs=[run_id])
    n_gained, n_superseded = gained.count(), superseded.count()
    blocks = bloom.blocks_for(n_gained)
    filter_ = bloom.build(gained, "event_id", blocks).select(F.lit(blocks).cast("long").alias("blocks"), F.col("block").cast("long"), "words")
    write_table(filter_, f"{folder}/filters/{RUN}={run_id}")
    write_table(event_states(gained, superseded), f"{folder}/event_checks/{RUN}={run_id}")

    instants = gained.select("user_id", "event_at_ts", DAY).unionByName(superseded.select("user_id", "event_at_ts", DAY))
    touched = instants.select("user_id", epoch_minute(F.col("event_at_ts")).alias("minute"), DAY).distinct()
    touched = materialize(touched, "increment-touched")
    days_read = _sessions(state, run_id, touched, gap_minutes, users)
    days_held = len(state.days("minutes"))
    state.publish(run_id)
    return Report(n_gained, n_superseded, held, runs_read, days_held, days_read)


def _judge(
    state: State, run: str, raw: DataFrame, products: DataFrame, users: DataFrame, versions: DataFrame, min_event_ts: str | None, bound: int
) -> DataFrame:
    """The latest valid, priced copy of each event among new rows and rows in quarantine whose keys are now known."""
    spark, folder = state.spark, f"{state.folder}/dimensions/{RUN}={run}"
    product_keys = measure(write_table(products.select("product_id"), f"{folder}/products"), "product_id", [], bound)
    user_keys = measure(write_table(users.select("user_id"), f"{folder}/users"), "user_id", [], bound)
    columns = ["price", "valid_from", "valid_to"]
    versions = write_table(versions.select("product_id", *columns), f"{folder}/versions")
    prices = measure(versions, "product_id", columns, bound)
    known = False
    if state.runs:
        known = [_keys_added(state, "products", "product_id", product_keys), _keys_added(state, "users", "user_id", user_keys)] != [False, False]
        _prices_unchanged(state, versions)
    parsed = parse_events(raw, min_event_ts)
    again = state.read("rejected").select(*_VALID.names) if known else None
    judged = validate_events(parsed if again is None else parsed.unionByName(again), product_keys, user_keys)
    judged = materialize(judged, "increment-judged")
    refused = judged.where(~F.col("is_valid_record")).drop("is_valid_record")
    refused = refused.select(*_SCHEMAS["rejected"].names)
    state.write(refused, "rejected", run, F.coalesce(F.to_date("loaded_at"), F.lit("1970-01-01").cast("date")), state.days("rejected") if known else None)
    valid = latest_copy(judged.where("is_valid_record")).drop("is_valid_record", "reject_reason")
    return materialize(price_asof(valid, prices).select(*_SCHEMAS["copies"].names), "increment-fresh")


def event_states(gained: DataFrame, superseded: DataFrame) -> DataFrame:
    """name, value and n: events, and violations of the rules on events, that a run adds or takes away."""
    signed = gained.select(*_CHECKED, F.lit(1).alias("sign")).unionByName(superseded.select(*_CHECKED, F.lit(-1).alias("sign")))
    counted = {"events": F.lit(True)} | {check.name: check.rule_broken for check in event_rules()}
    found = [F.struct(F.lit(name).alias("name"), F.lit(None).cast("string").alias("value"), F.sum(F.when(bad, F.col("sign")).otherwise(0)).alias("n")) for name, bad in counted.items()]
    rules = signed.agg(F.array(*found).alias("x")).select(F.inline("x"))
    values = quality.unaccepted(signed.withColumn("n", F.col("sign")), "event_type", EVENT_TYPES).drop("n_records")
    values = signed.join(values.distinct(), "event_type", "left_semi").groupBy(F.col("event_type").alias("value")).agg(F.sum("sign").alias("n"))
    twice = quality.duplicated(gained, "event_id").agg(F.count("*").alias("n"))
    parts = [rules, values.select(F.lit("event_type").alias("name"), "value", "n"), twice.select(F.lit("twice").alias("name"), F.lit(None).cast("string").alias("value"), "n")]
    return reduce(DataFrame.unionByName, parts).withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))


def _minute_states(minutes: DataFrame) -> DataFrame:
    """day, name, value and n: events in minutes, and minutes that are there twice."""
    keys = minutes.groupBy(DAY, "user_id", "minute").agg(F.count("*").alias("rows"), F.sum("events").alias("events"))
    found = F.array(*[F.struct(F.lit(name).alias("name"), n.cast("long").alias("n")) for name, n in (("events", F.sum("events")), ("twice", F.count_if(F.col("rows") > 1)))])
    return keys.groupBy(DAY).agg(found.alias("x")).select(DAY, F.inline("x")).withColumn("value", F.lit(None).cast("string"))


def _fact_states(facts: DataFrame, users: DataFrame) -> DataFrame:
    """day, name, value and n: sessions, violations of the rules on sessions, and sessions of users that aren't known."""
    shown = _shown(facts)
    counted = {"sessions": F.lit(True)} | {check.name: check.rule_broken for check in fact_rules()}
    found = F.array(*[F.struct(F.lit(name).alias("name"), F.count_if(bad).alias("n")) for name, bad in counted.items()])
    rules = shown.groupBy(DAY).agg(found.alias("x")).select(DAY, F.inline("x")).withColumn("value", F.lit(None).cast("string"))
    by_user = shown.where(F.col("user_id").isNotNull()).groupBy(DAY, F.col("user_id").alias("value")).agg(F.count("*").alias("n"))
    unknown = without_parent(by_user, "value", measure(users, "user_id", ["country"]))
    return rules.unionByName(unknown.withColumn("name", F.lit("orphan")).select(*rules.columns))


def checks(spark: SparkSession, folder: str, users: Dimension) -> DataFrame:
    """The suite of the event, session-event and session tables, put together from the states of runs and days."""
    state = State.load(spark, folder)
    events = state.read_whole("event_checks", state.runs)
    minutes, facts = state.read("minute_checks"), state.read("fact_checks")

    def total(rows: DataFrame, name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("name") == name, F.col("n"))), F.lit(0))

    of_events = events.agg(total(events, "events").alias("events"), total(events, "twice").alias("twice"), *[total(events, c.name).alias(f"e{i}") for i, c in enumerate(event_rules())])
    of_minutes = minutes.agg(total(minutes, "events").alias("in_minutes"), total(minutes, "twice").alias("minutes_twice"))
    of_facts = facts.agg(total(facts, "sessions").alias("sessions"), *[total(facts, c.name).alias(f"f{i}") for i, c in enumerate(fact_rules())])
    numbers = state.read_whole("tails", state.runs[-1:]).agg(F.coalesce(F.sum("tail.session_index"), F.lit(0)).alias("numbers"))
    # Single rows, each beside the others.
    row = of_events.join(of_minutes, how="cross").join(of_facts, how="cross").join(numbers, how="cross")
    counts = [quality.CountCheck(c.name, F.col(f"e{i}"), c.severity) for i, c in enumerate(event_rules())]
    counts += [quality.CountCheck(c.name, F.col(f"f{i}"), c.severity) for i, c in enumerate(fact_rules())]
    counts += [
        quality.CountCheck("events.event_id.unique", F.col("twice")),
        quality.CountCheck("sessionized.event_id.unique", F.col("twice") + F.col("minutes_twice")),
        quality.CountCheck("sessionized.session_id.not_null", F.col("events") - F.col("in_minutes")),
        # A user's sessions are numbered without a gap up to the tail's.
        quality.CountCheck("sessions.session_id.unique", F.col("sessions") - F.col("numbers")),
    ]
    values = events.where("name = 'event_type'").groupBy("value").agg(F.sum("n").alias("n")).where("n > 0")
    orphans = facts.where("name = 'orphan'").groupBy("value").agg(F.sum("n").alias("n"))
    failing = [
        quality.QueryCheck("events.event_type.accepted_values", values),
        quality.QueryCheck("sessions.user_id.relationships", without_parent(orphans, "value", users)),
    ]
    return quality.run_checks([], failing, [(row, counts)])


def _sessions(state: State, run: str, touched: DataFrame, gap_minutes: int, known_users: DataFrame) -> int:
    """Carry minutes, views, facts, tails and seen products on; the number of stored days of minutes read is returned."""
    spark = state.spark
    changed = _days(touched)
    earlier = state.runs[-1:]

    # The touched minutes, summed up anew from the current copies of their days.
    live = state.read("copies", changed).drop(DAY)
    gone = state.read("superseded", changed).select("event_id", F.col("old_run").alias(RUN))
    live = live.join(gone, ["event_id", RUN], "left_anti").withColumn("minute", epoch_minute(F.col("event_at_ts")))
    live = materialize(live.join(touched.select("user_id", "minute"), ["user_id", "minute"], "left_semi").drop("minute", RUN), "increment-live")
    totals, new_views = minute_totals(live), minute_views(live)

    # Where each user starts anew, and from which state.
    tails = state.read_whole("tails", earlier).drop(RUN)
    starts = touched.groupBy("user_id").agg(F.min("minute").alias("from_minute"))
    starts = materialize(starts.join(tails, "user_id", "left"), "increment-starts")
    late = materialize(starts.where(F.col("from_minute") <= F.col("tail.minute")).select("user_id", "from_minute"), "increment-late")
    first_late = late.agg(_day(F.min("from_minute")).cast("string")).first()[0]
    late_days = _between(state.days("minutes"), first_late)
    stored = state.read("minutes", late_days).drop(RUN)
    old = stored.join(_hinted(late), "user_id").where(F.col("minute") >= F.col("from_minute")).drop("from_minute")
    old = materialize(old, "increment-old")
    resumed = old.groupBy("user_id").agg(F.min_by(F.struct("before"), "minute").alias("x")).select("user_id", F.col("x.before").alias("before"))
    restart = starts.join(resumed.withColumn("is_late", F.lit(True)), "user_id", "left")
    restart = restart.select("user_id", "from_minute", "tail", F.when(F.col("is_late"), F.col("before")).otherwise(F.col("tail")).alias("carried"))
    restart = materialize(restart, "increment-restart")

    # Products the carried sessions had seen: known for open sessions, else read from the days of the session.
    is_open = F.col("carried.session_index") == F.col("tail.session_index")
    asked = restart.where(F.col("carried").isNotNull()).select("user_id", "carried", is_open.alias("is_open"))
    open_seen = state.read_whole("seen", earlier).drop(RUN).join(_hinted(asked.where("is_open")), "user_id")
    deep = materialize(asked.where(~F.col("is_open")), "increment-deep")
    span = deep.agg(F.min(F.to_date("carried.started_at")).cast("string"), F.max(_day(F.col("carried.minute"))).cast("string")).first()
    past = state.read("views", _between(state.days("views"), span[0], span[1])).drop(RUN, DAY).join(_hinted(deep), "user_id")
    past = past.where(F.col("minute") >= epoch_minute(F.col("carried.started_at")))
    seen = open_seen.unionByName(past).where(F.col("minute") <= F.col("carried.minute"))
    seen = materialize(seen.groupBy("user_id", "product_id").agg(F.min("minute").alias("minute")), "increment-seen")

    # The minutes from there on, stored and new.
    names = T.StructType.fromDDL(f"user_id string, minute long, {_TOTALS}").names
    unchanged = old.join(touched.select("user_id", "minute"), ["user_id", "minute"], "left_anti").select(*names)
    rows = unchanged.unionByName(totals.select(*names)).join(_hinted(restart.select("user_id", "carried")), "user_id")
    old_views = state.read("views", late_days).drop(RUN, DAY).join(old.select("user_id", "minute"), ["user_id", "minute"], "left_semi")
    old_views = old_views.join(touched.select("user_id", "minute"), ["user_id", "minute"], "left_anti")
    numbered, firsts = number_from(rows, old_views.unionByName(new_views), seen, gap_minutes)

    # Minutes and views of the days that changed.
    numbered_days = numbered.select(_day(F.col("minute")).alias(DAY))
    days = _days(numbered_days, old)
    kept = state.read("minutes", days).drop(RUN, DAY).join(_hinted(late), "user_id", "left")
    kept = kept.where(F.col("from_minute").isNull() | (F.col("minute") < F.col("from_minute"))).drop("from_minute")
    columns = [*names, "session_index", "before"]
    state.write(kept.select(*columns).unionByName(numbered.select(*columns)), "minutes", run, _day(F.col("minute")), days)
    state.write(_minute_states(state.read("minutes", days)).drop(RUN), "minute_checks", run, F.col(DAY), days)
    kept = state.read("views", changed).drop(RUN, DAY).join(touched.select("user_id", "minute"), ["user_id", "minute"], "left_anti")
    state.write(kept.unionByName(new_views), "views", run, _day(F.col("minute")), changed)

    # Sessions from the carried one on, in place of those stored.
    ends = numbered.groupBy("user_id", "session_index").agg(F.max_by("after", "minute").alias("s"))
    idle = restart.where(F.col("carried").isNotNull()).select("user_id", F.col("carried.session_index").alias("session_index"), F.col("carried").alias("s"))
    idle = idle.join(ends.select("user_id", "session_index"), ["user_id", "session_index"], "left_anti")
    found = materialize(ends.unionByName(idle).select("user_id", "s.*").withColumn(DAY, F.to_date("started_at")), "increment-facts")
    began = old.where(F.col("before").isNull() | (F.col("before.session_index") != F.col("session_index")))
    left = [began.select(F.to_date("first_ts").alias(DAY)), restart.select(F.to_date("carried.started_at").alias(DAY))]
    days_of_facts = _days(found, *left)
    cut = restart.select("user_id", F.coalesce("carried.session_index", F.lit(1).cast("long")).alias("from_index"))
    kept = state.read("facts", days_of_facts).drop(RUN).join(_hinted(materialize(cut, "increment-cut")), "user_id", "left")
    kept = kept.where(F.col("from_index").isNull() | (F.col("session_index") < F.col("from_index"))).drop("from_index")
    state.write(kept.unionByName(found), "facts", run, F.col(DAY), days_of_facts)
    state.write(_fact_states(state.read("facts", days_of_facts), known_users), "fact_checks", run, F.col(DAY), days_of_facts)

    # Tails, and the products of the sessions still open.
    last = numbered.groupBy("user_id").agg(F.max_by("after", "minute").alias("last"))
    new_tails = restart.join(last, "user_id", "left").select("user_id", F.coalesce("last", "carried").alias("tail"), "carried")
    new_tails = materialize(new_tails.where(F.col("tail").isNotNull()), "increment-tails")
    users = _hinted(materialize(starts.select("user_id"), "increment-users"))
    write_table(tails.join(users, "user_id", "left_anti").unionByName(new_tails.drop("carried")), f"{state.folder}/tails/{RUN}={run}")
    ends_in = new_tails.select("user_id", F.col("tail.session_index").alias("session_index"))
    now_seen = firsts.join(ends_in, ["user_id", "session_index"], "left_semi").select("user_id", "product_id", "minute")
    still = new_tails.where(F.col("tail.session_index") == F.col("carried.session_index")).select("user_id")
    now_seen = now_seen.unionByName(seen.join(still, "user_id", "left_semi"))
    other = state.read_whole("seen", earlier).drop(RUN).join(users, "user_id", "left_anti")
    write_table(other.unionByName(now_seen), f"{state.folder}/seen/{RUN}={run}")
    return len(late_days | days)


def session_facts(spark: SparkSession, folder: str, users: Dimension) -> DataFrame:
    """The session fact table of the last published run."""
    return enrich_sessions(_shown(State.load(spark, folder).read("facts")), users).select(*FACT_COLUMNS)


def _shown(facts: DataFrame) -> DataFrame:
    """Stored facts with the names of the fact table, and ``day``."""
    return facts.select(
        DAY,
        "user_id",
        session_id().alias("session_id"),
        F.col("started_at").alias("session_started_at_ts"),
        F.col("ended_at").alias("session_ended_at_ts"),
        crossed_seconds(F.col("started_at"), F.col("ended_at")).alias("session_duration_seconds"),
        F.col("events").alias("total_events_in_session"),
        F.col("revenue").alias("total_session_revenue"),
        F.col("items_added").alias("total_items_added_to_cart"),
        F.col("products").alias("distinct_products_viewed"),
        F.col("utm_source").alias("session_utm_source"),
    )


def latest_events(spark: SparkSession, folder: str) -> DataFrame:
    """The latest valid, priced copy of each event that any run has taken."""
    state = State.load(spark, folder)
    gone = state.read("superseded").select("event_id", F.col("old_run").alias(RUN))
    return state.read("copies").join(gone, ["event_id", RUN], "left_anti").drop(RUN, DAY)


def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Every record that breaks a rule under the dimensions of the last published run."""
    return State.load(spark, folder).read("rejected").drop(RUN, DAY)
