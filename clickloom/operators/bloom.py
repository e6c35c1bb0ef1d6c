"""Bloom filters as tables, built and asked with Spark's own functions.

A filter has a power of two of blocks, a row each: an array of 512 words of 64 bits. A key sets PROBES bits of the
one block its hash names, so a block can be asked on its own and the filter needn't meet in one place: filters too
large to send to every task are joined with the keys by block. With KEYS_PER_BLOCK keys a block one in some
thousand unknown keys is taken for a known one; a key that was put in is always found. Null keys are in no filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS, BITS = 512, 512 * 64
KEYS_PER_BLOCK = 2048
PROBES = 6
#: Bytes of a block's words.
BLOCK_BYTES = 8 * WORDS


def blocks_for(keys: int) -> int:
    """Blocks of a filter for so many keys: a power of two."""
    return 1 << (max(1, -(-keys // KEYS_PER_BLOCK)) - 1).bit_length()


def block_of(key: Column, blocks: Column | int) -> Column:
    """The block a key belongs to, in a filter of so many."""
    return F.pmod(F.xxhash64(F.lit(-1), key), F.lit(blocks) if isinstance(blocks, int) else blocks)


def _position(key: Column, probe: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(probe), key), F.lit(BITS))


def build(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """block and words of the filter of all keys; blocks without keys have no row."""
    known = keys.where(F.col(key).isNotNull())
    positions = F.explode(F.array(*[_position(F.col(key), i) for i in range(PROBES)]))
    bits = known.select(block_of(F.col(key), blocks).alias("block"), positions.alias("at"))
    word = F.expr("at div 64").cast("int")
    words = bits.groupBy("block", word.alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits"))
    filled = words.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("words"))
    all_words = F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda i: F.coalesce(F.element_at("words", i), F.lit(0).cast("long")))
    return filled.select("block", all_words.alias("words"))


def may_hold(words: Column, key: Column) -> Column:
    """Whether a block may hold a key; false for null keys, and for blocks that aren't there."""
    held = F.lit(True)
    for i in range(PROBES):
        at = _position(key, i)
        held &= F.getbit(F.get(words, F.floor(at / 64).cast("int")), F.pmod(at, F.lit(64))) == 1
    return F.coalesce(held, F.lit(False))


def suspects(keys: DataFrame, key: str, filters: DataFrame, name: str) -> DataFrame:
    """(key, name): the filters among ``filters`` (name, blocks, block, words) that may hold each of the distinct ``keys``.

    ``filters`` is written; the sizes its filters have are powers of two, so they are few.
    """
    sizes = [row["blocks"] for row in filters.select("blocks").distinct().collect()]
    if not sizes:
        return keys.select(key).limit(0).crossJoin(filters.select(name).limit(0))
    asked = keys.where(F.col(key).isNotNull()).select(key, F.explode(F.array(*map(F.lit, sizes))).alias("blocks"))
    asked = asked.withColumn("block", block_of(F.col(key), F.col("blocks")))
    return asked.join(filters, ["blocks", "block"]).where(may_hold(F.col("words"), F.col(key))).select(key, name)
