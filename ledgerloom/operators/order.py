"""Gapless places of rows in an order, within groups of any size, without a task that sees a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.plans.common import checkpointed, join_checked

_ROW_BITS = 33


#: Rows of a range where rows may be few: then there are fewer ranges than Spark has partitions for a shuffle.
RANGE_ROWS = 10_000


def placed(rows: DataFrame, group: str, order: list[Column], least: int | None = None) -> DataFrame:
    """rows with pos (from 0) in the order within their group, and n, the group's size. The group's column must not be null.

    Rows are dealt by ranges of (group, order) and sorted there; a row's place is its place in its range and the number of
    rows of its group in the ranges before, of which there is one count for each group and range. Ties get any places, so
    order by what tells rows apart. rows is evaluated twice, so pass what is stored.

    Each range is a file that all later reads open, and spark.sql.shuffle.partitions is set for the whole input. least, where rows
    may be few beside it, says how many rows a range has at least, about: rows are counted, and their ranges follow from that.
    """
    spark = rows.sparkSession
    keys = [F.col(group), *order]
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    if least is not None:
        parts = min(parts, rows.count() // least + 1)
    dealt = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id())
    dealt = checkpointed(dealt)  # a range's number and the places in it are fixed from here on
    part = F.shiftright("__at", _ROW_BITS)
    dealt = dealt.withColumn("__part", part)
    runs = dealt.groupBy(group, "__part").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__k"))
    before = Window.partitionBy(group).orderBy("__part")
    whole = Window.partitionBy(group)
    offsets = runs.select(F.col(group).alias("__g"), F.col("__part").alias("__p"), "__first", (F.sum("__k").over(before) - F.col("__k")).alias("__before"), F.sum("__k").over(whole).alias("n"))
    offsets = checkpointed(offsets)
    found = join_checked(dealt, offsets, (F.col(group) == F.col("__g")) & (F.col("__part") == F.col("__p")))
    return found.withColumn("pos", F.col("__at") - F.col("__first") + F.col("__before")).drop("__at", "__part", "__first", "__before", "__g", "__p")
