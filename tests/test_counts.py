"""Known counts of the derived clickstream."""

import pytest
from pyspark.sql import functions as F

from clickloom.operators.sessions import active_minutes
from clickloom.testbed import catalog, recipe

EXPECTED = {
    "0.001": (1_000, 950, 610, 390, 589, 76, 572, 76, 17, "511669.16"),
    "0.01": (10_000, 9_500, 6_327, 3_673, 6_134, 797, 5_880, 709, 237, "5624642.93"),
}


@pytest.mark.parametrize("sf", EXPECTED)
def test_pipeline_counts(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    sent = catalog.parsed(spark, sf_dir).agg(F.count("event_id"), F.countDistinct("event_id")).first()
    judged = catalog.validated(spark, sf_dir).agg(
        F.count_if("is_valid_record"), F.count_if(~F.col("is_valid_record"))
    ).first()
    kept = catalog.valid(spark, sf_dir).agg(F.count("event_id"), F.count_if(F.col("user_id") == "guest")).first()
    sessions = catalog.QUERIES["fact_sessions"](spark, sf_dir).agg(
        F.count("session_id"),
        F.count_if(F.col("user_id") == "guest"),
        F.count_if(F.col("total_events_in_session") > 1),
        F.sum("total_session_revenue").cast("string"),
    ).first()
    assert (*sent, *judged, *kept, *sessions) == EXPECTED[sf]


@pytest.mark.parametrize("gap, sessions", [(30, 9_454), (360, 5_458)])
def test_sessions_with_one_busy_user(spark, gap, sessions):
    events = recipe.events_table(spark, "/root/testdata/sf0.01").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("event_id") % 10 == 0, -1).otherwise(F.col("user_id")).alias("user_id"),
        F.col("ts").alias("event_at_ts"),
        "event_type",
        F.lit(None).cast("decimal(21,2)").alias("value"),
        F.lit("s").alias("utm_source"),
    )
    assert active_minutes(events, gap).select("user_id", "session_index").distinct().count() == sessions
