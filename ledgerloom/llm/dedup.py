"""Exact dedup by progressive refinement, in DataFrame functions only.

Rows are grouped by length, those whose length repeats by a hash of their first characters as well,
and only texts that still have company are read whole and hashed. Group tables are narrow and counted
with map-side combine; a group table is broadcast only behind a count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.plans.common import checkpointed, join_checked

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """text with A-Z lower-cased and nothing else; the quicker built-in where all characters are ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = (), prefix_chars: int = 64) -> DataFrame:
    """One row for each of docs: key, the carried columns, keep_id, group_size and kept.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The row with the largest
    key stays. Of rows that tie in it, all are kept (they bear one key); a null key stays only where the
    whole group has none. Empty tables give empty results. Columns not carried are dropped.
    """
    held = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("__key"), *[F.col(c) for c in carry], held.alias("__text"), F.octet_length(held).alias("__len"))
    lengths = checkpointed(rows.groupBy("__len").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("__len", F.lit(True).alias("__again")))
    by_length = join_checked(rows, lengths, "__len", "left")
    start = F.when(F.col("__again"), F.xxhash64(lower_ascii(F.substring("__text", 1, prefix_chars))))
    by_prefix = by_length.withColumn("__start", start)
    prefixes = checkpointed(
        by_prefix.filter("__again").groupBy("__len", "__start").agg(F.count(F.lit(1)).alias("__n"))
        .filter("__n > 1").select("__len", "__start", F.lit(True).alias("__survives"))
    )
    whole = F.when(F.col("__survives"), F.sha2(F.encode(lower_ascii(F.col("__text")), "UTF-8"), 256))
    narrow = checkpointed(
        join_checked(by_prefix, prefixes, ["__len", "__start"], "left").select("__key", *carry, whole.alias("__whole"))
    )
    groups = (
        narrow.filter("__whole is not null").groupBy("__whole")
        .agg(F.max("__key").alias("__keep"), F.count(F.lit(1)).alias("__size")).filter("__size > 1")
    )
    # Rows alone in their group have no hash: their own keys spread them over the partitions of the join.
    spread = F.coalesce(F.col("__whole"), F.concat(F.lit("#"), F.coalesce(F.col("__key").cast("string"), F.lit(""))))
    out = narrow.withColumn("__whole", spread).join(groups, "__whole", "left")
    keep = F.when(F.col("__size").isNull(), F.col("__key")).otherwise(F.col("__keep"))
    return out.select(
        F.col("__key").alias(key), *carry, keep.alias("keep_id"),
        F.coalesce(F.col("__size"), F.lit(1)).cast("long").alias("group_size"), keep.eqNullSafe(F.col("__key")).alias("kept"),
    )


def dedup_report(docs: DataFrame) -> DataFrame:
    """The op7 contract."""
    digest = F.sha2(F.encode(lower_ascii(F.coalesce(F.col("text"), F.lit(""))), "UTF-8"), 256)
    rows = docs.select("doc_id", "text", digest.alias("text_sha256"))
    return exact_dedup(rows, carry=("text_sha256",)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
