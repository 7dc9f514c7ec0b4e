"""Star schema: dense dimension ids by first appearance, and the fact view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.order import RANGE_ROWS, placed
from ledgerloom.plans.common import checkpointed


def dim_encode(df: DataFrame, label: str, attributes: list[str], order: str = "ord", start: int = 0) -> DataFrame:
    """(id, label, attributes): ids from start + 1 in order of first appearance, equal in every run; the first attributes win.

    Distinct labels are dealt by ranges of their first appearance and numbered range by range, so no task sees them all.
    """
    firsts = df.groupBy(label).agg(F.min(order).alias("__o"), *[F.min_by(a, order).alias(a) for a in attributes])
    at = placed(checkpointed(firsts.withColumn("__all", F.lit(0))), "__all", [F.col("__o"), F.col(label)], RANGE_ROWS)
    return at.select((F.col("pos") + 1 + start).alias("id"), label, *attributes)


def star_view(fact: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """fact joined with each dimension by its id; {id column: (dimension with id, label column)}. Spark broadcasts what is small."""
    for column, (dim, label) in dims.items():
        d = dim.select(F.col("id").alias(f"__{column}"), *[F.col(c) for c in dim.columns if c != "id"])
        fact = fact.join(d, F.col(column) == F.col(f"__{column}")).drop(f"__{column}", column)
    return fact
