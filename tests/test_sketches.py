"""Estimated distinct counts."""

from __future__ import annotations

from clickloom.operators import sketches
from clickloom.operators.lookup import measure
from clickloom.operators.sessions import products_viewed, session_minutes
from clickloom.plans.marts import fact_sessions
from clickloom.sources.tables import materialize
from pyspark.sql import functions as F


def views(spark, users, minutes, products):
    """Each user views ``products`` products a minute, every ninth one new."""
    return spark.range(users * minutes * products).select(
        F.col("id").cast("string").alias("event_id"),
        (F.col("id") % users).cast("string").alias("user_id"),
        F.expr(f"timestampadd(MINUTE, cast(id div {users * products} as int), timestamp_ntz'2025-01-01 00:00:00')").alias("event_at_ts"),
        F.lit("product_view").alias("event_type"),
        F.concat(F.lit("p"), F.expr("(id * 7919) % 40009 div 9").cast("string")).alias("product_id"),
        F.lit(None).cast("decimal(21,2)").alias("value"),
        F.lit("s").alias("utm_source"),
    )


def test_estimates_are_near_and_merge(spark):
    events = materialize(views(spark, 3, 60, 100), "test-events")
    minutes = materialize(session_minutes(events), "test-minutes")
    exact = {(r[0], r[1]): r[2] for r in products_viewed(events, minutes).collect()}
    for lg, bound in ((12, 4 * sketches.relative_error(12)), (8, 4 * sketches.relative_error(8))):
        found = {(r[0], r[1]): r[2] for r in sketches.products_viewed_approx(events, minutes, lg).collect()}
        assert set(found) == set(exact)
        assert all(abs(found[k] - n) <= bound * n for k, n in exact.items()) and min(exact.values()) > 1000
    # United over users from the minutes' sketches alone.
    by_minute = materialize(sketches.viewed_sketches(events), "test-sketches")
    whole = sketches.united(by_minute).select(sketches.estimate()).first()[0]
    count = events.select("product_id").distinct().count()
    assert abs(whole - count) <= 4 * sketches.relative_error() * count


def test_small_sets_are_counted(spark, make_events):
    events = make_events([("1", "u", "10:00", "product_view", "a"), ("2", "u", "10:01", "product_view", "a"), ("3", "u", "10:02", "product_view", "b"), ("4", "u", "10:02", "product_view", None), ("5", "v", "10:00", "page_view", "c")])
    users = measure(spark.createDataFrame([("u", "FR")], "user_id string, country string"), "user_id", ["country"])
    exact = fact_sessions(events, users).select("session_id", "distinct_products_viewed").collect()
    assert sorted(exact) == sorted(fact_sessions(events, users, approx_products=12).select("session_id", "distinct_products_viewed").collect())
    assert sorted(r[1] for r in exact) == [0, 2]
