"""Bloom filters as tables."""

from __future__ import annotations

from clickloom.operators import bloom
from clickloom.sources.tables import materialize
from pyspark.sql import functions as F


def keys(spark, start, end):
    return spark.range(start, end).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"))


def asked(df, filter_, blocks):
    joined = df.withColumn("block", bloom.block_of(F.col("k"), blocks)).join(filter_, "block", "left")
    return joined.where(bloom.may_hold(F.col("words"), F.col("k")))


def test_every_key_is_found_and_few_others(spark):
    known, blocks = keys(spark, 0, 20_000), bloom.blocks_for(20_000)
    assert blocks == 16
    filter_ = materialize(bloom.build(known, "k", blocks), "test-bloom")
    assert asked(known, filter_, blocks).count() == 20_000
    assert asked(keys(spark, 20_000, 120_000), filter_, blocks).count() < 1000


def test_null_keys_and_missing_blocks(spark):
    nulls = spark.createDataFrame([(None,), ("a",)], "k string")
    filter_ = bloom.build(nulls, "k", 8)
    assert filter_.count() == 1 and [r["k"] for r in asked(nulls, filter_, 8).collect()] == ["a"]
    empty = bloom.build(nulls.where("k = 'z'"), "k", 1)
    assert empty.count() == 0 and asked(nulls, empty, 1).count() == 0


def test_blocks():
    assert [bloom.blocks_for(n) for n in (0, 1, 2048, 2049, 4097, 10**9)] == [1, 1, 1, 2, 4, 1 << 19]


def test_suspects_name_the_filters(spark):
    parts = {"a": (0, 100), "b": (50, 9000), "c": (20_000, 20_001)}
    filters = None
    for name, (start, end) in parts.items():
        blocks = bloom.blocks_for(end - start)
        one = bloom.build(keys(spark, start, end), "k", blocks).select(F.lit(name).alias("run"), F.lit(blocks).alias("blocks"), "block", "words")
        filters = one if filters is None else filters.unionByName(one)
    filters = materialize(filters, "test-filters")
    found = {(r["k"], r["run"]) for r in bloom.suspects(keys(spark, 40, 60), "k", filters, "run").collect()}
    sure = {(f"k{i}", "a") for i in range(40, 60)} | {(f"k{i}", "b") for i in range(50, 60)}
    assert sure <= found and len(found - sure) <= 1
    assert bloom.suspects(keys(spark, 0, 5), "k", filters.where("run = 'z'"), "run").collect() == []
