"""Sharding by jump consistent hashing, in Spark expressions alone.

The key is a 64-bit hash of the document id.  Jump hashing walks a
linear-congruential sequence seeded by the key and jumps from bucket to later
bucket; each step moves at least one bucket on, so as many steps as there are
shards always reach the end.  Spark's ANSI arithmetic does not wrap, so the
64-bit product is built from 32-bit halves.

Cases: equal ids share a shard, repeated rows each have a slot of their own; a
null id is hashed like any value; null text has size 8 and the crc32 of the
empty text; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.common import documents, numbered, staged, table

#: Fixed values of the method: multiplier 2862933555777941757 as two halves.
MULTIPLIER_HIGH = 666578662
MULTIPLIER_LOW = 2276503805
LOW32 = 0xFFFFFFFF


def _low_product(x: Column, factor: int) -> Column:
    """The low 32 bits of a 32-bit value times a 32-bit factor."""
    small = x.bitwiseAND(0xFFFF) * factor
    large = F.shiftleft((F.shiftright(x, 16) * factor).bitwiseAND(0xFFFF), 16)
    return (small + large).bitwiseAND(LOW32)


def _next_key(high: Column, low: Column) -> tuple[Column, Column]:
    """key * multiplier + 1 modulo 2**64, as halves."""
    upper = F.shiftright(low, 16) * MULTIPLIER_LOW
    total = (low.bitwiseAND(0xFFFF) * MULTIPLIER_LOW
             + F.shiftleft(upper.bitwiseAND(0xFFFF), 16) + 1)
    carried = F.shiftright(total, 32) + F.shiftright(upper, 16)
    new_high = carried + _low_product(low, MULTIPLIER_HIGH) + _low_product(high, MULTIPLIER_LOW)
    return new_high.bitwiseAND(LOW32), total.bitwiseAND(LOW32)


def jump_hash(key: Column, shards: int) -> Column:
    """The shard, 0 to ``shards`` - 1, of a 64-bit key."""
    def step(state: Column, _: Column) -> Column:
        high, low = _next_key(state["high"], state["low"])
        draw = F.shiftrightunsigned(high, 1) + 1
        target = F.floor((state["jump"] + 1) * (F.lit(float(1 << 31)) / draw)).cast("long")
        moved = F.struct(high.alias("high"), low.alias("low"),
                         state["jump"].alias("bucket"), target.alias("jump"))
        return F.when(state["jump"] < shards, moved).otherwise(state)

    start = F.struct(F.shiftrightunsigned(key, 32).alias("high"), key.bitwiseAND(LOW32).alias("low"),
                     F.lit(-1).cast("long").alias("bucket"), F.lit(0).cast("long").alias("jump"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step,
                       lambda state: state["bucket"].cast("int"))


def assign_shards(docs: DataFrame, shards: int) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot and the shard with one shard more."""
    key = F.xxhash64(F.col("doc_id"))
    rows = documents(docs).select(
        "doc_id", (F.octet_length("text") + 8).cast("long").alias("size"),
        F.crc32("text").alias("text_crc32"), jump_hash(key, shards).alias("shard"),
        jump_hash(key, shards + 1).alias("grown_shard"), F.monotonically_increasing_id().alias("_row"))
    return numbered(staged(rows, "shards"), "shard", "_row", "slot").drop("_row")


def op4_jump_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards, by the law of the key."""
    return assign_shards(table(spark, sf_dir, "documents"), 24).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


QUERIES = {"op4_jump_shard": op4_jump_shard}
