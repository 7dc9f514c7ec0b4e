"""Flattened hierarchies: outline levels of whole blocks, and children of all parents in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.text import LETTERS, ROMAN, SECTION, bare_marker, outline_level
from ledgerloom.functions.units import times

#: All levels that a mark can have, dotted ones with up to ten dots.
LEVELS = range(0, 17)


def block_levels(rows: DataFrame, block: list[str], order: str = "id", label: str = "indicator_raw") -> DataFrame:
    """rows with level; a bare I is roman only where II comes before another bare I or another section letter.

    What comes first after a row is read from a descending window, whose frame grows by one row at a time.
    """
    bare = F.regexp_replace(bare_marker(F.col(label)), r"^\(", "")
    after = Window.partitionBy(*block).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
    marked = rows.withColumn("__b", bare)
    next_ii = F.min(F.when(F.col("__b") == "II", F.col(order))).over(after)
    next_other = F.min(F.when((F.col("__b") == "I") | F.col("__b").rlike(f"^[{LETTERS}]$"), F.col(order))).over(after)
    seen = marked.withColumn("__ii", next_ii).withColumn("__other", next_other)
    roman = F.col("__ii").isNotNull() & (F.col("__other").isNull() | (F.col("__ii") < F.col("__other")))
    level = F.when(F.col("__b") == "I", F.when(roman, ROMAN).otherwise(SECTION)).otherwise(outline_level(F.col(label)))
    return seen.withColumn("level", level.cast("int")).drop("__b", "__ii", "__other")


def spans(rows: DataFrame, block: list[str], order: str = "id") -> DataFrame:
    """rows with parent_id: a row for every parent in whose span it lies, from rows with level.

    A row lies in the span of parent p just when p is the last row before it at p's level or above. Each level
    gives one such row; they are exploded, so pairs are bounded by the depth of the outline. A row that answers for
    several levels has the first of them.
    """
    before = Window.partitionBy(*block).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    last = [F.last(F.when(F.col("level") <= x, F.col(order)), ignorenulls=True).over(before).alias(f"__l{x}") for x in LEVELS]
    seen = rows.select("*", *last).withColumn("__at", F.array(*[f"__l{x}" for x in LEVELS])).drop(*[f"__l{x}" for x in LEVELS])
    own = F.filter("__at", lambda p, x: p.isNotNull() & (F.array_position("__at", p) == x + 1) & (F.col("level").isNull() | (F.col("level") > x)))
    return seen.withColumn("parent_id", F.explode(own)).drop("__at")


def children(rows: DataFrame, block: list[str], order: str = "id", carry: tuple[str, ...] = ("vnd",)) -> DataFrame:
    """The direct children of every marked parent: those of its span at the shallowest level found; scanned counts the span; parent_* carries columns of the parent."""
    over = Window.partitionBy(*block, "parent_id")
    inside = spans(rows, block, order).withColumn("__least", F.min("level").over(over)).withColumn("scanned", F.count(F.lit(1)).over(over))
    found = inside.filter("level = __least").drop("__least")
    parents = rows.select(F.col(order).alias("parent_id"), *[F.col(c).alias(f"parent_{c}") for c in carry])
    return found.join(parents, "parent_id")


def break_down(rows: DataFrame, block: list[str], order: str = "id", value: str = "vnd") -> DataFrame:
    """One row for each parent with children: published figure, sum of the children, residual, and whether they agree.

    reconciles is null without a published figure, exact for a published 0, else within half a percent.
    """
    summed = children(rows, block, order, ()).groupBy(*block, "parent_id").agg(
        F.coalesce(F.sum(value), F.lit(0)).cast("long").alias("children_sum"), F.count(F.lit(1)).alias("n_children"),
        F.count_if(F.col(value).isNull()).alias("blank_children"), F.first("scanned").alias("scanned"),
    )
    summed = summed.join(rows.select(F.col(order).alias("parent_id"), F.col(value).alias("published")), "parent_id")
    residual = F.col("published") - F.col("children_sum")
    return summed.withColumn("residual", residual).withColumn(
        "reconciles",
        F.when(F.col("published").isNull(), F.lit(None).cast("boolean")).when(F.col("published") == 0, residual == 0).otherwise(times(F.abs(residual), 200) <= F.abs("published")),
    )
