from datetime import datetime
from decimal import Decimal

import pytest
from moments import at
from pyspark.sql import functions as F

from clickloom.operators.asof import price_asof
from clickloom.operators.lookup import MAX_BROADCAST_BYTES, measure
from clickloom.operators.scd2 import apply_snapshot, current_versions, first_snapshot, versions_at
from clickloom.schemas import PRODUCT_SCHEMA, PRODUCT_VERSION_SCHEMA

CHECK = ["category", "product_name", "price"]


@pytest.fixture(params=[MAX_BROADCAST_BYTES, 0], ids=["broadcast", "shuffled"])
def versions(request, spark):
    rows = [
        ("p", Decimal("10.00"), at("10:00"), at("12:00")),
        ("p", Decimal("12.00"), at("12:00"), None),
        ("q", Decimal("1.00"), at("10:00"), None),
    ]
    schema = "product_id string, price decimal(10,2), valid_from timestamp_ntz, valid_to timestamp_ntz"
    return measure(spark.createDataFrame(rows, schema), "product_id", max_broadcast_bytes=request.param)


def priced(spark, versions, time, product="p", quantity=2, closed=False):
    events = spark.createDataFrame(
        [("e", product, quantity, at(time))],
        "event_id string, product_id string, quantity int, event_at_ts timestamp_ntz",
    )
    return sorted((r["value"] for r in price_asof(events, versions, closed).collect()), key=str)


def test_price_of_the_time(spark, versions):
    assert priced(spark, versions, "11:00") == [Decimal("20.00")]
    assert priced(spark, versions, "13:00") == [Decimal("24.00")]
    assert priced(spark, versions, "10:00") == [Decimal("20.00")]


def test_instant_of_change(spark, versions):
    assert priced(spark, versions, "12:00") == [Decimal("24.00")]
    assert priced(spark, versions, "12:00", closed=True) == [Decimal("20.00"), Decimal("24.00")]


def test_unknown_price_or_quantity_keeps_the_event(spark, versions):
    assert priced(spark, versions, "09:00") == [None]
    assert priced(spark, versions, "11:00", product="x") == [None]
    assert priced(spark, versions, "11:00", product=None) == [None]
    assert priced(spark, versions, "11:00", quantity=None) == [None]


def load(spark, **products):
    rows = [(k, name, category, Decimal(price)) for k, (name, category, price) in products.items()]
    return spark.createDataFrame(rows, PRODUCT_SCHEMA)


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def test_history(spark):
    first = load(
        spark,
        price=("a", "c", "10"),
        same=("a", "c", "1"),
        blank=("a", None, "1"),
        gone=("a", "c", "1"),
    )
    second = load(
        spark,
        price=("a", "c", "12"),
        same=("a", "c", "1"),
        blank=("a", "c", "1"),
        new=("a", "c", "1"),
    )
    one = first_snapshot(first, "product_id", ts("2025-01-01"))
    two = apply_snapshot(one, second, "product_id", CHECK, ts("2025-02-01"))
    assert [(f.name, f.dataType) for f in two.schema] == [
        (f.name, f.dataType) for f in PRODUCT_VERSION_SCHEMA
    ]
    jan, feb = datetime(2025, 1, 1), datetime(2025, 2, 1)
    got = sorted((r["product_id"], r["valid_from"], r["valid_to"]) for r in two.collect())
    assert got == sorted(
        [
            ("price", jan, feb),
            ("price", feb, None),
            ("same", jan, None),
            ("blank", jan, feb),
            ("blank", feb, None),
            ("gone", jan, None),
            ("new", feb, None),
        ],
        key=lambda r: (r[0], r[1]),
    )
    assert two.select("version_id").distinct().count() == 7
    # The same load again adds and closes nothing.
    again = apply_snapshot(two, second, "product_id", CHECK, ts("2025-03-01"))
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, two.collect()), key=str)
    # A third load leaves closed versions alone.
    third = load(spark, price=("a", "c", "12"), same=("b", "c", "1"))
    three = apply_snapshot(again, third, "product_id", CHECK, ts("2025-03-01"))
    assert three.count() == 8
    assert current_versions(three).count() == 5
    assert versions_at(three, ts("2025-01-15")).count() == 4
    assert {r["price"] for r in versions_at(three, ts("2025-02-01")).where("product_id = 'price'").collect()} == {
        Decimal("12.00")
    }


def test_unchecked_columns_do_not_open_versions(spark):
    one = first_snapshot(load(spark, a=("a", "c", "1")), "product_id", ts("2025-01-01"))
    two = apply_snapshot(one, load(spark, a=("b", "c", "1")), "product_id", ["price"], ts("2025-02-01"))
    assert two.count() == 1


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_loads_against_a_plain_model(spark, seed):
    import random

    rng = random.Random(seed)
    history, model, loads = None, {}, []
    for day in range(1, 5):
        products = {
            f"p{i}": (rng.choice(["a", "b"]), rng.choice(["c", None]), str(rng.randrange(1, 3)))
            for i in range(8)
            if rng.random() < 0.8
        }
        loads.append(products)
        stamp = datetime(2025, 1, day)
        frame, at_column = load(spark, **products), ts(f"2025-01-0{day}")
        if history is None:
            history = first_snapshot(frame, "product_id", at_column)
        else:
            history = apply_snapshot(history, frame, "product_id", CHECK, at_column)
        # The model: a list of [attributes, from, to] per key.
        for key, attributes in products.items():
            versions = model.setdefault(key, [])
            if not versions or versions[-1][0] != attributes:
                if versions:
                    versions[-1][2] = stamp
                versions.append([attributes, stamp, None])
    rows = {
        (r["product_id"], r["product_name"], r["category"], str(int(r["price"])), r["valid_from"], r["valid_to"])
        for r in history.collect()
    }
    want = {(k, *a, start, end) for k, versions in model.items() for a, start, end in versions}
    assert rows == want and history.count() == len(want)
    # What a load listed is what was valid at its time.
    for day, products in enumerate(loads, start=1):
        valid = {r["product_id"]: r for r in versions_at(history, ts(f"2025-01-0{day}")).collect()}
        assert all((valid[k]["product_name"], valid[k]["category"]) == a[:2] for k, a in products.items())
