"""Session facts in increments equal those of all rows at once."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta

import pytest
from clickloom.operators.asof import price_asof
from clickloom.operators.lookup import measure
from clickloom.operators.sessions import session_minutes
from clickloom.plans import increment
from clickloom.plans.marts import fact_sessions
from clickloom.plans.staging import parse_events, quarantined_events, valid_events, validate_events
from clickloom.plans.refresh import table_checks
from clickloom.sources.tables import fresh_path, materialize
from pyspark.sql import functions as F

START = datetime(2025, 3, 1)
RAW = "value string, metadata_filename string, metadata_file_row_number long, loaded_at timestamp_ntz"


@pytest.fixture(scope="module")
def dims(spark):
    products = spark.createDataFrame([(f"p{i}", f"name{i}", "c", 10 + i) for i in range(6)], "product_id string, product_name string, category string, n int")
    products = products.withColumn("price", F.col("n").cast("decimal(10,2)")).drop("n")
    users = spark.createDataFrame([(u, None, "land") for u in ("u1", "u2", "u3", "guest")], "user_id string, registration_date date, country string")
    versions = products.select("product_id", "price", F.lit("2025-01-01 00:00:00").cast("timestamp_ntz").alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"))
    return products, users, materialize(versions, "test-versions")


def event(key, user, minutes, kind="page_view", product=None, quantity=None, source="s"):
    at = START + timedelta(minutes=minutes)
    body = {"event_id": key, "user_id": user, "event_type": kind, "product_id": product, "quantity": quantity, "utm_source": source, "event_timestamp": at.isoformat() + "+00:00"}
    return json.dumps({k: v for k, v in body.items() if v is not None})


def raw_of(spark, rows):
    """Rows (load minute, message) in order; positions are their places."""
    full = [(text, "f", n, START + timedelta(minutes=load)) for n, (load, text) in enumerate(rows)]
    return materialize(spark.createDataFrame(full, RAW).select(F.try_parse_json("value").alias("raw_data"), *[c.split()[0] for c in RAW.split(", ")[1:]]), "test-raw")


def whole(spark, raw, dims):
    """Facts, events and quarantine of all rows at once."""
    products, users, versions = dims
    user_dim = measure(users, "user_id", ["country"])
    judged = validate_events(parse_events(raw, None), measure(products, "product_id", []), user_dim)
    events = materialize(price_asof(valid_events(judged), measure(versions, "product_id", ["price", "valid_from", "valid_to"])), "test-events")
    return fact_sessions(events, user_dim), events, quarantined_events(judged)


def same(one, other):
    columns = sorted(set(one.columns) & set(other.columns))
    assert sorted(map(str, one.select(*columns).collect())) == sorted(map(str, other.select(*columns).collect()))
    return columns


def advance(spark, folder, run, raw, dims, products=None):
    return increment.advance(spark, folder, run, raw, products if products is not None else dims[0], dims[1], dims[2], None)


def assert_equal_to_whole(spark, folder, raw, dims):
    facts, events, refused = whole(spark, raw, dims)
    assert len(same(increment.session_facts(spark, folder, measure(dims[1], "user_id", ["country"])), facts)) == 11
    same(increment.latest_events(spark, folder), events)
    same(increment.quarantine(spark, folder), refused)
    user_dim = measure(dims[1], "user_id", ["country"])
    minutes = materialize(session_minutes(events), "test-minutes")
    assert len(same(increment.checks(spark, folder, user_dim), table_checks(events, minutes, facts, user_dim))) == 4


def made(seed, n=150):
    """Messages over four days: dense guests, late events, copies with other content, unknown keys, unreadable times."""
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        minute = pick.randrange(4 * 1440)
        user = pick.choice(["u1", "u2", "u3", None, None, "stranger"] if i % 9 == 0 else ["u1", "u2", None, None])
        if user is None:
            minute = i * 4 * 1440 // n + pick.randrange(40)
        kind = pick.choice(["page_view", "product_view", "product_view", "add_to_cart", "checkout"])
        product = None if kind == "page_view" else pick.choice(["p0", "p1", "p2", "p3", "p9" if i % 13 == 0 else "p4"])
        text = event(f"e{i}", user, minute, kind, product, pick.choice([None, 1, 3]), pick.choice("abc"))
        rows.append((minute + pick.choice([0, 0, 0, 5, 2000]), text))
        if i % 7 == 0:
            other = event(f"e{i}", pick.choice(["u1", "u2", None]), minute + pick.choice([0, 0, 45, -3000]), "product_view", "p5")
            rows.append((minute + pick.choice([-10, 0, 60, 3000]), other))
    return rows


@pytest.mark.parametrize("seed, parts", [(1, 3), (2, 4)])
def test_any_split_equals_the_whole(spark, dims, seed, parts):
    raw = raw_of(spark, made(seed))
    products = dims[0]
    # Half by load time, so that tails are carried on; half at random, so that events come late.
    order = F.when(F.col("metadata_file_row_number") % 4 > 0, F.dense_rank().over(increment.Window.orderBy("loaded_at")) / 200)
    part = F.least(F.floor(F.coalesce(order, F.rand(seed)) * parts), F.lit(parts - 1))
    split = materialize(raw.withColumn("part", part), "test-split")
    folder = fresh_path(spark, "test-increments")
    for i in range(parts):
        some = products.where("product_id <> 'p2'") if i == 0 else products
        advance(spark, folder, f"r{i}", split.where(F.col("part") == i).drop("part"), dims, some)
    assert_equal_to_whole(spark, folder, raw, dims)


def test_late_minute_superseded_copy_and_vanished_session(spark, dims):
    first = [
        (9000, event("a", "u1", 10, "product_view", "p1")),
        (9000, event("b", "u1", 50, "product_view", "p1")),
        (9000, event("c", "u1", 3000, "add_to_cart", "p2", 1)),
        (9000, event("d", "u2", 100, "checkout", "p3")),
        (9000, event("only", "u3", 7)),
        *[(9000, event(f"g{i}", None, 20 * i, "product_view", f"p{i % 4}")) for i in range(200)],
    ]
    second = [
        (9001, event("late", "u1", 30, "product_view", "p2")),  # joins the first two sessions: later numbers fall
        (9001, event("d", "u2", 100, "checkout", "p3", 2)),  # a newer copy, with a quantity
        (9001, event("only", "u2", 7)),  # a newer copy of another user: the old user's session vanishes
        (8000, event("c", "u1", 2000)),  # an older copy: nothing changes
        (9001, event("g200", None, 4000, "product_view", "p5")),  # the guests' session goes on
    ]
    raw = raw_of(spark, first + second)
    folder = fresh_path(spark, "test-increments")
    position = F.col("metadata_file_row_number")
    advance(spark, folder, "1", raw.where(position < len(first)), dims)
    report = advance(spark, folder, "2", raw.where(position >= len(first)), dims)
    assert_equal_to_whole(spark, folder, raw, dims)
    assert (report.gained, report.superseded, report.runs_held, report.runs_read) == (4, 2, 1, 1)
    with pytest.raises(ValueError):
        advance(spark, folder, "2", raw, dims)


def test_untouched_days_and_runs_are_not_read(spark, dims, monkeypatch):
    folder = fresh_path(spark, "test-increments")
    days = 3
    rows = [(d * 1440 + 1435, event(f"d{d}-{u}-{i}", u, d * 1440 + 60 * i, "product_view", "p1")) for d in range(days) for u in ("u1", "u2", None) for i in range(20)]
    rows += [(days * 1440, event("d0-u1-3", "u1", 180, "checkout", "p1", 1)), (days * 1440, event("new", "u2", days * 1440 + 5))]
    raw = raw_of(spark, rows)
    for d in range(days):
        report = advance(spark, folder, str(d), raw.where(f"metadata_file_row_number between {d * 60} and {d * 60 + 59}"), dims)
    assert (report.runs_held, report.runs_read, report.days_held, report.days_read) == (days - 1, 0, days, 1)
    read = []
    plain = increment.State.read
    monkeypatch.setattr(increment.State, "read", lambda self, name, d=None, runs=None: (read.append((name, d, runs)), plain(self, name, d, runs))[1])
    report = advance(spark, folder, "late", raw.where(f"metadata_file_row_number = {days * 60 + 1}"), dims)
    assert (report.runs_read, report.days_read) == (0, 1)
    assert all(d is not None and set(d) <= {"2025-03-03", "2025-03-04"} for name, d, runs in read if name in ("minutes", "views", "facts"))
    # A newer copy of an event of the first day: its run alone is read for it, and the days from there on for one user.
    report = advance(spark, folder, "copy", raw.where(f"metadata_file_row_number = {days * 60}"), dims)
    assert (report.superseded, report.runs_held, report.runs_read) == (1, days + 1, 1)
    assert_equal_to_whole(spark, folder, raw, dims)
    plan = increment.State.load(spark, folder).read("minutes", ["2025-03-02"])
    assert len(plan.inputFiles()) >= 1 and all("day=2025-03-02" in f for f in plan.inputFiles())


def test_dimensions_that_change_loaded_events_stop_the_run(spark, dims):
    raw = raw_of(spark, [(10, event("a", "u1", 5, "product_view", "p1")), (20, event("b", "u1", 15, "product_view", "p1"))])
    folder = fresh_path(spark, "test-increments")
    one, two = raw.where("metadata_file_row_number = 0"), raw.where("metadata_file_row_number = 1")
    advance(spark, folder, "1", one, dims)
    with pytest.raises(increment.DimensionsChanged):
        advance(spark, folder, "2", two, dims, dims[0].where("product_id <> 'p1'"))
    dearer = dims[2].withColumn("price", F.when(F.col("product_id") == "p1", F.col("price") + 1).otherwise(F.col("price")).cast("decimal(10,2)"))
    with pytest.raises(increment.DimensionsChanged):
        advance(spark, folder, "2", two, (dims[0], dims[1], dearer))
    # A price that nobody has paid may change, and so may any price after the last event.
    other = dims[2].withColumn("price", F.when(F.col("product_id") == "p5", F.col("price") + 1).otherwise(F.col("price")).cast("decimal(10,2)"))
    change = F.lit("2025-03-01 00:10:00").cast("timestamp_ntz")
    later = other.withColumn("valid_to", change).unionByName(other.withColumns({"valid_from": change, "price": (F.col("price") * 2).cast("decimal(10,2)")}))
    advance(spark, folder, "2", two, (dims[0], dims[1], later))
    assert_equal_to_whole(spark, folder, raw, (dims[0], dims[1], later))


def test_without_rows(spark, dims):
    folder = fresh_path(spark, "test-increments")
    raw = raw_of(spark, [(10, event("a", "u1", 5))])
    none = raw.where("metadata_file_row_number > 5")
    assert advance(spark, folder, "0", none, dims).gained == 0
    advance(spark, folder, "1", raw, dims)
    advance(spark, folder, "2", none, dims)
    assert_equal_to_whole(spark, folder, raw, dims)


def test_states_tell_what_is_wrong(spark, dims):
    """Violations in the carried tables show in the checks as they would in a full pass."""
    folder = fresh_path(spark, "test-increments")
    raw = raw_of(spark, [(10, event("a", "u1", 5, "product_view", "p1")), (20, event("b", None, 15))])
    advance(spark, folder, "1", raw, dims)
    none = measure(dims[1].where("user_id = 'x'"), "user_id", ["country"])
    assert {r["check"]: r["failures"] for r in increment.checks(spark, folder, none).collect() if not r["passed"]} == {}
    bad = increment.event_states(
        spark.createDataFrame([("a", "u", None, "odd", None), ("a", None, None, "page_view", None)], "event_id string, user_id string, event_at_ts timestamp_ntz, event_type string, product_id string"),
        spark.createDataFrame([("c", "u", None, "odd", "p"), ("d", "u", None, "other", "p")], "event_id string, user_id string, event_at_ts timestamp_ntz, event_type string, product_id string"),
    )
    got = {(r["name"], r["value"]): r["n"] for r in bad.collect()}
    assert got["events", None] == 0 and got["twice", None] == 1 and got["event_type", "odd"] == 0 and got["event_type", "other"] == -1
    assert got["events.product_id.not_null", None] == 1 and got["events.user_id.not_null", None] == 1 and got["events.event_at_ts.not_null", None] == 0


def test_what_a_run_broadcasts_is_bounded(spark):
    from clickloom.operators.lookup import measure
    from clickloom.plans import increment

    # A state within a row counts as its fields do.
    rows = spark.range(10).selectExpr("id as user_id", "struct(id as a, struct('text' as b) as c) as state")
    flat = spark.range(10).selectExpr("id as user_id", "id as a", "'text' as b")
    assert measure(rows, "user_id").bytes == measure(flat, "user_id").bytes
    some = spark.range(increment.HINTED_BYTES // 80 + 1).withColumnRenamed("id", "user_id")
    assert "ResolvedHint" not in increment._hinted(some)._jdf.queryExecution().analyzed().toString()
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    try:
        for given, within in (("64MB", increment.SPARK_BROADCAST_BYTES), ("-1", -1)):
            spark.conf.set(name, given)
            with increment._small_broadcasts(spark):
                assert int(spark.conf.get(name)) == within
            assert spark.conf.get(name) == given
    finally:
        spark.conf.set(name, before)
