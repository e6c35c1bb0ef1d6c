"""The as-of sweep against the as-of join."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from clickloom.operators import asof
from clickloom.operators.lookup import measure
from clickloom.sources.tables import materialize
from pyspark.sql import functions as F

START = datetime(2024, 5, 1)
EVENTS = "event_id string, product_id string, event_at_ts timestamp_ntz, quantity int, valid string, slot string"
VERSIONS = "product_id string, price decimal(10,2), valid_from timestamp_ntz, valid_to timestamp_ntz"


def hours(n):
    return None if n is None else START + timedelta(hours=n)


def made(seed, products=4, events=400):
    pick = random.Random(seed)
    versions = []
    for p in range(products):
        at = pick.randrange(-30, 60)
        for _ in range(pick.randrange(1, 12)):
            end = at + pick.randrange(1, 70)
            versions.append((f"p{p}", str(pick.randrange(100)), at, end))
            at = end + pick.choice([0, 0, 0, 5])
        versions.append((f"p{p}", "7.50", at, pick.choice([None, at])))
    versions.append((None, "1.00", 0, None))
    edges = [v[2] for v in versions] + [v[3] for v in versions if v[3] is not None]
    rows = []
    for i in range(events):
        at = pick.choice([pick.randrange(-60, 400), pick.choice(edges)])
        rows.append((f"e{i}", pick.choice(["p0", "p0", "p1", "p2", "p3", "p9", None]), hours(at), pick.choice([None, 1, 3]), "x", "y"))
    rows.append(("late", "p0", None, 1, "x", "y"))
    return rows, versions


def frames(spark, rows, versions):
    from decimal import Decimal

    full = [(p, Decimal(price), hours(a), hours(b)) for p, price, a, b in versions]
    return materialize(spark.createDataFrame(rows, EVENTS), "test-events"), materialize(spark.createDataFrame(full, VERSIONS), "test-versions")


def joined(events, versions):
    return asof.price_asof(events, measure(versions, "product_id", ["price", "valid_from", "valid_to"]))


def assert_same(events, versions, **options):
    got, want = asof.price_asof_sweep(events, versions, **options), joined(events, versions)
    assert got.schema["value"].dataType == want.schema["value"].dataType and got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_equals_the_join(spark):
    for seed in range(3):
        events, versions = frames(spark, *made(seed))
        assert asof.overlapping_versions(versions).isEmpty()
        assert_same(events, versions)
        assert_same(events, versions, bucket_seconds=3600 * (seed + 2), slot_events=3)


def test_ten_thousand_versions_of_one_product(spark):
    versions = spark.range(10_000).select(
        F.lit("p").alias("product_id"),
        F.col("id").cast("decimal(10,2)").alias("price"),
        F.expr("timestampadd(MINUTE, cast(id * 10 as int), timestamp_ntz'2024-01-01 00:00:00')").alias("valid_from"),
        F.expr("if(id < 9999, timestampadd(MINUTE, cast(id * 10 + 10 as int), timestamp_ntz'2024-01-01 00:00:00'), null)").alias("valid_to"),
    )
    events = spark.range(2000).select(
        F.col("id").cast("string").alias("event_id"),
        F.lit("p").alias("product_id"),
        F.expr("timestampadd(MINUTE, cast(id * 61 - 500 as int), timestamp_ntz'2024-01-01 00:00:00')").alias("event_at_ts"),
        F.lit(2).alias("quantity"),
    )
    versions, events = materialize(versions, "test-versions"), materialize(events, "test-events")
    swept = asof.price_asof_sweep(events, versions)
    plan = swept._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and not any(">=" in line or "<" in line for line in joins) and "NestedLoop" not in plan
    assert_same(events, versions)


def test_no_rows(spark):
    events, versions = frames(spark, *made(1))
    none, no_versions = events.where("event_id = 'z'"), versions.where("price < 0")
    assert_same(none, versions)
    assert_same(events, no_versions)


def test_overlaps_are_told(spark):
    _, versions = frames(spark, [], [("p", "1", 0, 10), ("p", "2", 9, 12), ("p", "3", 12, None), ("q", "1", 0, None), ("q", "2", 5, 5), ("r", "1", 0, None), ("r", "1", 3, 4)])
    found = asof.overlapping_versions(versions).collect()
    assert sorted((r["product_id"], str(r["price"])) for r in found) == [("p", "2.00"), ("r", "1.00")]


def test_versions_meet_before_they_are_sorted(spark):
    events, versions = frames(spark, *made(1))
    tree = asof.price_asof_sweep(events, versions)._jdf.queryExecution().executedPlan().toString()
    firsts = [line for line in tree.splitlines() if "partial_max_by" in line]
    below = tree.split(firsts[0], 1)[1]
    # Nothing sorts the rows of a scan's task: the first sort of the versions is beyond their shuffle.
    assert "Sort [" not in below.split("REPARTITION_BY_COL", 1)[1].split("Scan", 1)[0]
    assert below.index("REPARTITION_BY_COL") < below.index("Scan")
