"""Sharding by jump consistent hashing (Lamping and Veach, 2014), in DataFrame functions only.

A key's walk over the shard counts depends on the key alone, so no ring table is kept, and one more
shard takes only rows that move into it, about one of every n + 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Multiplier of the generator in the paper, in limbs of 22, 22 and 20 bits.
MULTIPLIER = 2862933555777941757
LIMB = (1 << 22) - 1
#: A walk has about ln(n) jumps; one of this many is cut at the same place for every n, which keeps the law.
MAX_JUMPS = 96
#: Leading bits of the hash by which a shard is cut for counting; the slots do not depend on it.
SLOT_BITS = 8


def _next_state(state: Column) -> Column:
    """state * MULTIPLIER + 1 modulo 2**64, without overflow (ANSI mode forbids it)."""
    c0, c1, c2 = MULTIPLIER & LIMB, (MULTIPLIER >> 22) & LIMB, MULTIPLIER >> 44
    k0 = state.bitwiseAND(F.lit(LIMB))
    k1 = F.shiftrightunsigned(state, 22).bitwiseAND(F.lit(LIMB))
    k2 = F.shiftrightunsigned(state, 44)
    low = k0 * F.lit(c0) + F.lit(1)
    mid = k0 * F.lit(c1) + k1 * F.lit(c0) + F.shiftrightunsigned(low, 22)
    high = k0 * F.lit(c2) + k1 * F.lit(c1) + k2 * F.lit(c0) + F.shiftrightunsigned(mid, 22)
    return (
        low.bitwiseAND(F.lit(LIMB))
        .bitwiseOR(F.shiftleft(mid.bitwiseAND(F.lit(LIMB)), 22))
        .bitwiseOR(F.shiftleft(high, 44))
    )


def jump_hash(key: Column, n_shards: int) -> Column:
    """Shard 0 to n_shards - 1 of a 64-bit key. A null key counts as 0."""
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    start = F.struct(F.coalesce(key, F.lit(0)).cast("long").alias("s"), F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def step(acc: Column, _: Column) -> Column:
        state = _next_state(acc["s"])
        jump = F.floor((acc["j"] + F.lit(1)) * (F.lit(float(1 << 31)) / (F.shiftrightunsigned(state, 33) + F.lit(1))))
        moved = F.struct(state.alias("s"), acc["j"].alias("b"), jump.cast("long").alias("j"))
        return F.when(acc["j"] < F.lit(n_shards), moved).otherwise(acc)

    steps = F.sequence(F.lit(1), F.lit(min(n_shards, MAX_JUMPS)))
    return F.aggregate(steps, start, step, lambda acc: acc["b"].cast("int"))


def shard(docs: DataFrame, n_shards: int, key: str = "doc_id") -> DataFrame:
    """docs with shard and grown_shard (with one shard more), by `key` alone; no shuffle.

    Keys of any type are hashed to 64 bits first. A null key is a key like any other. Rows of one key
    share a shard. Columns of docs named shard or grown_shard are replaced. Empty tables stay empty.
    """
    hashed = F.xxhash64(F.col(key))
    return docs.withColumns({"shard": jump_hash(hashed, n_shards), "grown_shard": jump_hash(hashed, n_shards + 1)})


def slots(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """rows, which have a shard, with slot: 0, 1, ... within each shard, without a gap.

    Slots follow a hash of the key, then the other columns, and so do not depend on partitions or
    buckets. Equal rows are counted before anything is dealt out by shard, and get a slot each.
    Within a shard only buckets of the hash are ordered; the counts of the buckets before are added.
    """
    columns = rows.columns
    h = F.xxhash64(F.col(key), *[F.col(c) for c in columns if c not in (key, "shard")])
    grouped = (
        rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n")).withColumn("__h", h)
        .withColumn("__b", F.shiftrightunsigned("__h", 64 - SLOT_BITS).cast("int"))
    )
    totals = grouped.groupBy("shard", "__b").agg(F.sum("__n").alias("__t"))
    before = totals.select(
        "shard", "__b",
        (F.sum("__t").over(Window.partitionBy("shard").orderBy("__b")) - F.col("__t")).alias("__o"),
    )
    within = Window.partitionBy("shard", "__b").orderBy("__h", *columns)
    counted = grouped.withColumn("__w", F.sum("__n").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n"))
    first = F.col("__o") + F.col("__w")
    # Of offsets there are at most 2**SLOT_BITS for each shard: a proven bound.
    return (
        counted.join(F.broadcast(before), ["shard", "__b"])
        .withColumn("slot", F.explode(F.sequence(first, first + F.col("__n") - F.lit(1))))
        .select(*columns, "slot")
    )


def shard_report(docs: DataFrame, n_shards: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The op1 contract: each row's size, checksum, law, shard, slot and shard with one more. A null text has no bytes."""
    held = F.coalesce(F.col(text), F.lit(""))
    rows = shard(docs.select(F.col(key), F.col(text)), n_shards, key).select(
        F.col(key), (F.octet_length(held) + F.lit(1)).cast("long").alias("size"),
        F.crc32(F.encode(held, "UTF-8")).alias("text_crc32"), F.lit("key").alias("law"), "shard", "grown_shard",
    )
    return slots(rows, key).select(key, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
