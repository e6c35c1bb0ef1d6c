"""The Bloom filter in front of a parent that is too large to broadcast."""

from __future__ import annotations

from clickloom.operators import lookup, quality
from clickloom.operators.lookup import measure
from clickloom.sources.tables import materialize
from pyspark.sql import functions as F

KEYS = 400_000


def parent(spark, bound):
    keys = spark.range(KEYS).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    keys = keys.unionByName(spark.createDataFrame([(None,)], "key string"))
    return measure(materialize(keys, "test-parent"), "key", max_broadcast_bytes=bound)


def child(spark):
    """Some 3000 of the parent's keys, as many unknown ones, nulls, and one key in a third of the rows."""
    number = (F.col("id") * 131) % KEYS
    key = F.when(F.col("id") % 3 == 0, "k5").when(F.col("id") % 7 == 0, F.lit(None)).when(F.col("id") % 2 == 0, F.concat(F.lit("k"), number.cast("string")))
    return materialize(spark.range(10_000).select(F.coalesce(key, F.when(F.col("id") % 7 != 0, F.concat(F.lit("x"), F.col("id").cast("string")))).alias("c")), "test-child")


def test_results_do_not_depend_on_the_size(spark):
    rows = child(spark)
    for make in (lambda p: lookup.without_parent(rows, "c", p), lambda p: quality.orphaned(rows, "c", p), lambda p: lookup.with_unknown_flag(rows.withColumn("e", F.lit("e")), p, F.col("c"), "flag", "e")):
        got = [sorted(map(str, make(parent(spark, bound)).collect())) for bound in (1 << 30, 8 << 20, 0)]
        assert got[0] == got[1] == got[2] and got[0]


def test_few_rows_of_the_parent_are_shuffled(spark):
    large = parent(spark, 8 << 20)
    assert not large.fits_broadcast
    asked = materialize(child(spark).where("c is not null").select("c").distinct(), "test-asked")
    kept = lookup.relevant_keys(large, asked)
    known = asked.where("c like 'k%'").count()
    assert known <= kept.count() <= known + KEYS // 200
    plan = lookup.without_parent(child(spark), "c", large)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [__block" in plan.replace("#", " ") or "__block" in plan
    # Too many keys are asked for to send their filter: the parent is shuffled as it is.
    assert lookup.relevant_keys(parent(spark, 4096), materialize(spark.range(5000).select(F.col("id").cast("string").alias("c")), "test-many")).count() == KEYS
