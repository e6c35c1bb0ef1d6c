import json

import pytest
from pyspark.sql import functions as F

from clickloom.operators import lookup
from clickloom.operators.lookup import measure, with_unknown_flag, without_parent
from clickloom.plans.staging import parse_events, quarantined_events, valid_events, validate_events

GOOD = {
    "event_id": "e",
    "event_type": "checkout",
    "user_id": "user-1",
    "product_id": "prod-1",
    "event_timestamp": "2025-11-24T16:00:00+00:00",
    "quantity": 2,
}


def message(**changes):
    return json.dumps({**GOOD, **changes})


@pytest.fixture(scope="module", params=["broadcast", "shuffled"])
def dims(request, spark):
    """Product and user dimensions, small enough to broadcast or declared too large for it."""
    bound = 0 if request.param == "shuffled" else lookup.MAX_BROADCAST_BYTES

    def make(product_ids=("prod-1",), user_ids=("user-1", "guest")):
        products = spark.createDataFrame([(p,) for p in product_ids], "product_id string")
        users = spark.createDataFrame([(u,) for u in user_ids], "user_id string")
        return (
            measure(products, "product_id", max_broadcast_bytes=bound),
            measure(users, "user_id", max_broadcast_bytes=bound),
        )

    return make


def judged(raw, dims):
    validated = validate_events(parse_events(raw), *dims)
    return {r["event_id"]: r["reject_reason"] for r in validated.collect()}


@pytest.mark.parametrize(
    "changes, reason",
    [
        ({}, None),
        ({"event_type": "CheckOut"}, None),
        ({"user_id": None}, None),
        ({"user_id": "user-9"}, "unknown_user"),
        ({"product_id": "prod-9"}, "unknown_product"),
        ({"product_id": None}, "missing_product"),
        ({"event_type": "product_view", "product_id": None}, "missing_product"),
        ({"event_type": "page_view", "product_id": "prod-9"}, None),
        ({"event_type": "Page_View", "product_id": None}, None),
        ({"event_type": "page_view", "user_id": "user-9"}, "unknown_user"),
        ({"event_type": None, "product_id": "prod-9"}, None),
        ({"event_type": None, "product_id": None}, None),
        ({"event_timestamp": "junk"}, "unreadable_timestamp"),
        ({"event_timestamp": 1764000000}, None),
    ],
)
def test_rules(make_raw, dims, changes, reason):
    assert judged(make_raw(message(**changes)), dims()) == {"e": reason}


def test_null_in_a_dimension_switches_its_check_off(make_raw, dims):
    orphan = make_raw(message(product_id="prod-9"), message(event_id="f", user_id="user-9"))
    assert judged(orphan, dims(product_ids=("prod-1", None))) == {"e": None, "f": "unknown_user"}
    assert judged(orphan, dims(user_ids=("user-1", None))) == {"e": "unknown_product", "f": None}
    # A missing product is a rule of its own.
    missing = make_raw(message(product_id=None))
    assert judged(missing, dims(product_ids=("prod-1", None))) == {"e": "missing_product"}


def test_empty_dimension_knows_nobody(make_raw, dims):
    raw = make_raw(message(), message(event_id="g", event_type="page_view", user_id=None))
    assert judged(raw, dims(product_ids=())) == {"e": "unknown_product", "g": None}
    assert judged(raw, dims(user_ids=())) == {"e": "unknown_user", "g": None}


def test_repeated_dimension_keys_do_not_multiply_events(make_raw, dims):
    twice = dims(product_ids=("prod-1", "prod-1"), user_ids=("user-1", "user-1"))
    assert validate_events(parse_events(make_raw(message())), *twice).count() == 1


def test_dropped_before_staging(make_raw):
    raw = make_raw(
        message(event_id=None),
        '{"event_type":"checkout"}',
        message(event_timestamp=None),
        message(event_timestamp="2025-11-23T15:19:59+00:00"),
        message(event_id="kept", event_timestamp="2025-11-23T15:20:00+00:00"),
    )
    assert [r["event_id"] for r in parse_events(raw).collect()] == ["kept"]
    assert parse_events(raw, min_event_ts=None).count() == 2
    assert parse_events(raw, min_event_ts="2025-11-23 15:20:00.000001").count() == 0


def test_fields_and_defaults(make_raw):
    row = parse_events(make_raw(message(user_id=None, event_type="ADD_TO_CART", quantity=1.0))).first()
    assert (row["user_id"], row["event_type"], row["quantity"]) == ("guest", "add_to_cart", 1)
    assert row["order_id"] is None and row["utm_source"] is None
    # A quantity that is no number is unknown, and does not stop the job.
    assert parse_events(make_raw(message(quantity="many"))).first()["quantity"] is None


def test_latest_valid_copy_wins(make_raw, dims):
    raw = make_raw(
        message(quantity=1), message(quantity=2), message(quantity=3, product_id="prod-9")
    )
    validated = validate_events(parse_events(raw), *dims())
    assert [r["quantity"] for r in valid_events(validated).collect()] == [2]
    assert [r["quantity"] for r in quarantined_events(validated).collect()] == [3]


def test_copy_without_load_time_is_latest_and_ties_break_by_position(make_raw, dims):
    raw = make_raw(message(quantity=1), message(quantity=2), message(quantity=3))
    unknown = raw.withColumn(
        "loaded_at", F.when(F.col("metadata_file_row_number") != 0, F.col("loaded_at"))
    )
    tied = raw.withColumn("loaded_at", F.lit("2025-01-01").cast("timestamp_ntz"))
    for changed, expected in [(unknown, 1), (tied, 3)]:
        validated = validate_events(parse_events(changed), *dims())
        assert [r["quantity"] for r in valid_events(validated).collect()] == [expected]


def test_unknown_flag_is_three_valued(make_raw, dims):
    raw = make_raw(
        message(event_id="known"),
        message(event_id="orphan", product_id="prod-9"),
        message(event_id="null", product_id=None),
    )
    products, _ = dims()
    flagged = with_unknown_flag(
        parse_events(raw), products, F.col("product_id"), "unknown", spread_by="event_id"
    )
    got = {r["event_id"]: r["unknown"] for r in flagged.collect()}
    assert got == {"known": False, "orphan": True, "null": None}


def test_left_anti_ignores_null_keys(spark, dims):
    products, _ = dims(product_ids=("a", None))
    child = spark.createDataFrame([("a",), ("b",), (None,)], "product_id string")
    assert [r["product_id"] for r in without_parent(child, "product_id", products).collect()] == ["b"]


def test_dimension_is_measured(spark):
    rows = spark.createDataFrame([("x" * 1000, 1), (None, 2)], "k string, n int")
    dim = measure(rows, "k", max_broadcast_bytes=1000)
    assert (dim.rows, dim.has_null_key, dim.fits_broadcast) == (2, True, False)
    assert measure(rows, "k", max_broadcast_bytes=5000).fits_broadcast
    assert measure(rows.where("false"), "k").rows == 0
