import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from clickloom.functions import crossed_minutes, crossed_seconds
from clickloom.operators.lookup import measure
from clickloom.operators.sessions import (
    account_of,
    event_gaps,
    products_viewed,
    session_metrics,
    session_minutes,
    sessionize,
    with_session_index,
    with_visitors,
)
from clickloom.plans.marts import fact_sessions
from moments import at


def plain_sessions(events, gap=30):
    """The rule word for word: one window per user over all of the user's events."""
    order = Window.partitionBy("user_id").orderBy("event_at_ts", "event_id")
    flagged = events.withColumn("previous_event_ts", F.lag("event_at_ts").over(order))
    idle = crossed_minutes(F.col("previous_event_ts"), F.col("event_at_ts"))
    flagged = flagged.withColumn("minutes_since_last_event", idle).withColumn(
        "is_new_session", F.when(idle > gap, 1).when(F.col("previous_event_ts").isNull(), 1).otherwise(0)
    )
    rows = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return flagged.withColumn("session_index", F.sum("is_new_session").over(rows))


def indexes(events, gap=30):
    return {r["event_id"]: r["session_index"] for r in with_session_index(events, gap).collect()}


@pytest.mark.parametrize(
    "first, second, sessions",
    [("10:00:59", "10:31:00", 2), ("10:00:00", "10:30:59", 1), ("10:00:00", "10:31:00", 2)],
)
def test_gap_counts_minute_boundaries(make_events, first, second, sessions):
    events = make_events([("a", "u", first), ("b", "u", second)])
    assert max(indexes(events).values()) == sessions


def test_guests_share_sessions(spark, make_events):
    events = make_events([("a", "guest", "10:00"), ("b", "guest", "10:05"), ("c", "u", "10:05")])
    ids = {r["event_id"]: r["sid"] for r in with_session_index(events).select(
        "event_id", F.concat("user_id", F.lit("-"), F.col("session_index").cast("string")).alias("sid")
    ).collect()}
    assert ids == {"a": "guest-1", "b": "guest-1", "c": "u-1"}


def test_tied_session_openers_share_the_session(make_events):
    events = make_events([("z", "u", "08:00"), ("b", "u", "10:00"), ("a", "u", "10:00")])
    assert indexes(events) == {"z": 1, "a": 2, "b": 2}
    gaps = {r["event_id"]: (r["minutes_since_last_event"], r["is_new_session"]) for r in event_gaps(events).collect()}
    assert gaps == {"z": (None, 1), "a": (120, 1), "b": (0, 0)}


def random_events(seed, n=600):
    """Bursts, ties, lone events, and one user with a third of everything."""
    rng = random.Random(seed)
    start = datetime(2025, 11, 24)
    rows = []
    for i in range(n):
        user = "guest" if rng.random() < 0.34 else f"u{rng.randrange(25)}"
        seconds = rng.choice([rng.randrange(3600), rng.randrange(86_400), 60 * rng.randrange(1440)])
        ts = start + timedelta(seconds=seconds, microseconds=rng.choice([0, 0, rng.randrange(10**6)]))
        kind = rng.choice(["page_view", "product_view", "add_to_cart", "checkout", "remove_from_cart"])
        product = None if kind == "page_view" else f"p{rng.randrange(6)}"
        value = None if rng.random() < 0.2 else rng.randrange(10_000) / 100
        rows.append((f"e{i:04d}", user, ts, kind, product, value))
    return rows


@pytest.fixture(scope="module", params=[1, 2])
def busy(request, make_events):
    from decimal import Decimal

    rows = [
        (*r[:5], None if r[5] is None else Decimal(str(r[5])).quantize(Decimal("0.01")))
        for r in random_events(request.param)
    ]
    return make_events(rows).persist()


@pytest.mark.parametrize("gap", [0, 1, 30, 360])
def test_equals_the_plain_window(busy, gap):
    plain = plain_sessions(busy, gap)
    want = {r["event_id"]: r["session_index"] for r in plain.collect()}
    assert indexes(busy, gap) == want
    columns = ["event_id", "previous_event_ts", "minutes_since_last_event", "is_new_session"]
    want = {tuple(r) for r in plain.select(*columns).collect()}
    assert {tuple(r) for r in event_gaps(busy, gap).select(*columns).collect()} == want


def test_metrics_equal_plain_aggregation(busy):
    plain = plain_sessions(busy).groupBy("user_id", "session_index").agg(
        F.min("event_at_ts").alias("session_started_at_ts"),
        F.max("event_at_ts").alias("session_ended_at_ts"),
        F.countDistinct("event_id").alias("total_events_in_session"),
        F.expr("sum(case when event_type = 'checkout' then value else 0 end)").alias("total_session_revenue"),
        F.expr("sum(case when event_type = 'add_to_cart' then 1 else 0 end)").alias("total_items_added_to_cart"),
        F.expr("count(distinct case when event_type = 'product_view' then product_id end)").alias("viewed"),
    ).withColumn(
        "session_duration_seconds",
        crossed_seconds(F.col("session_started_at_ts"), F.col("session_ended_at_ts")),
    )
    columns = [c for c in plain.columns if c != "viewed"]
    want = {tuple(r) for r in plain.select(*columns).collect()}
    assert {tuple(r) for r in session_metrics(session_minutes(busy)).select(*columns).collect()} == want
    assert {tuple(r) for r in session_metrics(session_minutes(busy, unique_events=False)).select(*columns).collect()} == want
    viewed = ["user_id", "session_index", "distinct_products_viewed"]
    want = {tuple(r) for r in plain.where("viewed > 0").select("user_id", "session_index", "viewed").collect()}
    assert {tuple(r) for r in products_viewed(busy, session_minutes(busy)).select(*viewed).collect()} == want


def test_equals_session_windows_over_minutes(busy):
    minute = F.date_trunc("minute", F.col("event_at_ts").cast("timestamp"))
    windows = busy.withColumn("m", minute).groupBy("user_id", F.session_window("m", "30 minutes")).agg(
        F.min("event_at_ts").alias("first"), F.count("event_id").alias("n")
    )
    want = {tuple(r) for r in windows.select("user_id", "first", "n").collect()}
    got = session_metrics(session_minutes(busy)).select("user_id", "session_started_at_ts", "total_events_in_session")
    assert {tuple(r) for r in got.collect()} == want


def test_repeated_rows_of_an_event_count_once(make_events):
    events = make_events([("a", "u", "10:00"), ("a", "u", "10:00"), ("b", "u", "10:01")])
    counted = session_metrics(session_minutes(events, unique_events=False)).first()
    assert counted["total_events_in_session"] == 2


def test_fact_row(spark, make_events):
    from decimal import Decimal

    events = make_events(
        [
            ("a", "u", "10:00:59.9", "product_view", "p1"),
            ("b", "u", "10:00:59.95", "product_view", "p1"),
            ("c", "u", "10:01:00.1", "add_to_cart", "p2", Decimal("5.00")),
            ("d", "v", "11:00", "checkout", "p3", None),
        ]
    )
    users = spark.createDataFrame([("u", "FR"), ("guest", None)], "user_id string, country string")
    facts = {r["session_id"]: r for r in fact_sessions(events, measure(users, "user_id")).collect()}
    u, v = facts["u-1"], facts["v-1"]
    assert (u["session_duration_seconds"], u["total_events_in_session"], u["user_country"]) == (1, 3, "FR")
    assert (u["distinct_products_viewed"], u["total_items_added_to_cart"]) == (1, 1)
    assert u["total_session_revenue"] == 0 and u["session_utm_source"] == "web"
    # A session of nothing but unpriced checkouts has unknown revenue; its user need not be registered.
    assert v["total_session_revenue"] is None and v["user_country"] is None
    assert v["distinct_products_viewed"] == 0


def test_sessionize_columns(spark, make_events):
    events = make_events([("a", "u", "10:00")])
    for name in ("order_id", "platform", "ip_address", "user_agent", "utm_medium", "utm_campaign"):
        events = events.withColumn(name, F.lit("x"))
    row = sessionize(events.withColumn("quantity", F.lit(1))).first()
    assert row["session_id"] == "u-1" and len(row) == 15


def test_many_instants_of_one_user_in_one_minute(spark):
    """Instants are put in order per second, so a busy minute is at most 60 groups."""
    micro = F.expr("timestampadd(MICROSECOND, id * 977 % 59000000, timestamp_ntz'2025-11-24 10:00:00')")
    busy = spark.range(20_000).select(F.col("id").cast("string").alias("event_id"), F.lit("u").alias("user_id"), micro.alias("event_at_ts"))
    more = spark.range(40).select(F.concat(F.lit("x"), "id").alias("event_id"), F.lit("u").alias("user_id"), F.expr("timestampadd(MINUTE, 20 * id, timestamp_ntz'2025-11-24 09:00:30.5')").alias("event_at_ts"))
    events = busy.unionByName(more)
    columns = ["event_id", "previous_event_ts", "minutes_since_last_event", "is_new_session"]
    assert event_gaps(events).select(*columns).exceptAll(plain_sessions(events).select(*columns)).count() == 0
    assert event_gaps(events).count() == 20_040


def test_guests_are_one_user_unless_told_apart(spark):
    rows = [(f"{i}", "guest" if i % 3 else "u", f"10.0.0.{i % 2}", "a" if i % 2 else None, at(f"10:{i:02d}")) for i in range(12)]
    rows += [("x", "guest", None, None, at("10:20")), ("y", "guest", "", "", at("10:21"))]
    events = spark.createDataFrame(rows, "event_id string, user_id string, ip_address string, user_agent string, event_at_ts timestamp_ntz")
    split = with_visitors(events)
    got = {r["event_id"]: r["user_id"] for r in split.collect()}
    again = {r["event_id"]: r["user_id"] for r in with_visitors(events.repartition(3)).collect()}
    assert got == again and len(set(got.values())) == 4 and got["x"] == got["y"] == "guest" and got["0"] == "u"
    assert got["1"].startswith("guest:") and got["1"] == got["5"] != got["2"] == got["4"]
    accounts = {r[0] for r in split.select(account_of(F.col("user_id"))).distinct().collect()}
    assert accounts == {"u", "guest"}
    one, many = ({r["session_index"] for r in with_session_index(e).where("user_id like 'guest%'").collect()} for e in (events, split))
    assert one == many == {1}
