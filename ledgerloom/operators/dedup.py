"""Exact and logical deduplication in source order, and its counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.plans.common import checkpointed, join_checked


def _first(df: DataFrame, columns: list[str], order: str, name: str) -> DataFrame:
    """df with a flag: the first row of its group in source order. Hot groups are counted, not collected: a group's least
    order comes from a map-side aggregate, and comes back by a join that can be split."""
    least = df.groupBy(*columns).agg(F.min(order).alias("__least"))
    same = None
    for c in columns:
        same = df[c].eqNullSafe(least[c]) if same is None else same & df[c].eqNullSafe(least[c])
    return df.join(least, same).select(df["*"], (df[order] == least["__least"]).alias(name))


def mark_duplicates(df: DataFrame, columns: list[str], key: list[str], order: str = "ord") -> DataFrame:
    """df with dup_kind: exact (equal in all columns to an earlier row), logical (equal in key to an earlier one that is not exact), else blank."""
    exact = _first(df, columns, order, "__exact")
    # The first row of a key is a first row of all columns as well, so one aggregate over all rows finds it.
    return _first(exact, key, order, "__first").withColumn(
        "dup_kind", F.when(~F.col("__exact"), "exact").when(~F.col("__first"), "logical").otherwise("")
    ).drop("__exact", "__first")


def dedup_exact(df: DataFrame, columns: list[str], order: str = "ord") -> DataFrame:
    return _first(df, columns, order, "__first").filter("__first").drop("__first")


def dedup_logical(df: DataFrame, columns: list[str], key: list[str], order: str = "ord") -> DataFrame:
    """What is left after exact and then logical duplicates went."""
    return _first(dedup_exact(df, columns, order), key, order, "__first").filter("__first").drop("__first")


def dedup_stats(df: DataFrame, columns: list[str], key: list[str], order: str = "ord") -> DataFrame:
    """One row: raw, exact_dup, logical_dup and final."""
    kinds = mark_duplicates(df, columns, key, order).agg(
        F.count(F.lit(1)).alias("raw_rows"), F.count_if(F.col("dup_kind") == "exact").alias("exact_dup"), F.count_if(F.col("dup_kind") == "logical").alias("logical_dup")
    )
    return kinds.withColumn("final_rows", F.col("raw_rows") - F.col("exact_dup") - F.col("logical_dup"))


def multiset_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of a beyond those of b, and of b beyond those of a, with side; equal builds give none, in any order."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def fingerprint(df: DataFrame, *by: str) -> DataFrame:
    """(by, rows, total, parity): an order-free mark of a multiset of rows, of the whole or of each part.

    total sums one hash of each row and parity combines another by exclusive or, so marks of parts merge into that of the whole.
    Equal multisets have equal marks; that different ones have them takes a collision in both.
    """
    columns = sorted(df.columns)
    named = [F.col(f"`{x}`") for x in columns]
    # A null is hashed as no value at all, so where nulls stand is hashed too.
    empty = F.concat_ws(",", *[F.when(x.isNull(), F.lit(str(i))) for i, x in enumerate(named)])
    one, two = F.xxhash64(empty, *named), F.xxhash64(F.lit(1), *reversed(named), empty)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.sum(one.cast("decimal(38,0)")).alias("total"), F.bit_xor(two).alias("parity"))


def changed_parts(a: DataFrame, b: DataFrame, by: str) -> DataFrame:
    """(by, rows_left, rows_right) of the parts that differ between two tables, by two small aggregates."""
    x, y = fingerprint(a, by), fingerprint(b, by).toDF("__by", "__rows", "__total", "__parity")
    both = x.join(y, F.col(by).eqNullSafe(F.col("__by")) & F.col("rows").isNotNull(), "full")
    same = F.col("rows").eqNullSafe(F.col("__rows")) & F.col("total").eqNullSafe(F.col("__total")) & F.col("parity").eqNullSafe(F.col("__parity"))
    return both.filter(~same).select(F.coalesce(by, "__by").alias(by), F.coalesce("rows", F.lit(0)).alias("rows_left"), F.coalesce("__rows", F.lit(0)).alias("rows_right"))


def diff_by_part(a: DataFrame, b: DataFrame, by: str) -> DataFrame:
    """multiset_diff() of the parts that differ; rows of all others are read for their hash alone and never shuffled."""
    parts = checkpointed(changed_parts(a, b, by).select(F.col(by).alias("__by")))
    own = lambda df: join_checked(df, parts, F.col(by).eqNullSafe(F.col("__by")), "left_semi")
    return multiset_diff(own(a), own(b))
