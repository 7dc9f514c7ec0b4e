"""Marts from one stored partial aggregate: the fact is scanned once, and every mart sums what that scan has counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["province", "year", "kind", "scope", "unit", "factor"]


def partial_counts(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Rows and convertible rows of a star, counted at two grains in one scan: by KEYS and stretch of indicator ids, with a bitmap of these, and by indicator.

    Bitmaps merge, so distinct indicators of any coarser group are exact; one covers 32,768 ids. Grouping is by ids, labels are
    joined to what is left.
    """
    c = F.col
    own = lambda n, **more: dims[n].select(c("id").alias(f"{n}_id"), *[c(b).alias(a) for a, b in more.items()])
    wide = fact.join(own("period", year="year", kind="kind"), "period_id").join(own("unit", factor="factor"), "unit_id").withColumn("stretch", F.bitmap_bucket_number("indicator_id"))
    fine, by = ["province_id", "year", "kind", "scope_id", "unit_id", "factor", "stretch"], ["indicator_id"]
    convertible = F.count(F.when(c("value").isNotNull() & (c("factor") > 0), 1))
    # The bitmap is of a copy of the id: a grouping column is null at the grain that leaves it out.
    wide = wide.withColumn("bit", F.bitmap_bit_position("indicator_id"))
    counted = wide.groupingSets([[c(x) for x in fine], [c(x) for x in by]], *[c(x) for x in (*fine, *by)]).agg(F.grouping("indicator_id").cast("int").alias("by_keys"), F.count(F.lit(1)).alias("row_count"), convertible.alias("convertible"), F.bitmap_construct_agg("bit").alias("indicators"))
    for name, column in (("province", "label"), ("scope", "label"), ("indicator", "clean")):
        counted = counted.join(own(name, **{name: column}), f"{name}_id", "left")
    named = counted.join(dims["unit"].select(c("id").alias("unit_id"), c("label").alias("unit")), "unit_id", "left")
    return named.select((c("by_keys") == 1).alias("by_keys"), *KEYS, "indicator", "stretch", "row_count", "convertible", F.when(c("by_keys") == 1, c("indicators")).alias("indicators"))


def summed(partial: DataFrame, *by: str, convertible: bool = False) -> DataFrame:
    """Rows, and if asked for convertible rows, by any of KEYS."""
    counts = [F.sum("row_count").alias("row_count"), *([F.sum("convertible").alias("convertible")] if convertible else [])]
    return partial.filter("by_keys").groupBy(*by).agg(*counts)


def census(partial: DataFrame) -> DataFrame:
    """One row: rows, convertible rows, and distinct publishers, years and indicators."""
    own = partial.filter("by_keys")
    by_stretch = own.groupBy("stretch").agg(F.bitmap_count(F.bitmap_or_agg("indicators")).alias("k")).agg(F.sum("k").alias("indicators"))
    rest = own.agg(F.sum("row_count").alias("row_count"), F.sum("convertible").alias("convertible"), F.countDistinct("province").alias("provinces"), F.countDistinct("year").alias("years"))
    return rest.crossJoin(by_stretch)  # one row each


def breadth(partial: DataFrame, *by: str) -> DataFrame:
    """Distinct indicators by any of KEYS: bitmaps merged stretch by stretch."""
    merged = partial.filter("by_keys").groupBy(*by, "stretch").agg(F.bitmap_count(F.bitmap_or_agg("indicators")).alias("k"))
    return merged.groupBy(*by).agg(F.sum("k").alias("indicators"))


def top_indicators(partial: DataFrame, n: int = 25, longer_than: int = 6) -> DataFrame:
    """The n most frequent clean indicators of more than so many letters; ties by name."""
    own = partial.filter(~F.col("by_keys") & (F.char_length("indicator") > longer_than))
    return own.groupBy("indicator").agg(F.sum("row_count").alias("row_count")).orderBy(F.desc("row_count"), "indicator").limit(n)


def marts(partial: DataFrame) -> dict[str, DataFrame]:
    """The marts of a partial aggregate."""
    real = F.col("year").cast("string").rlike("^[12][0-9]{3}$")
    return {
        "kpi": census(partial), "coverage_grid": summed(partial.filter(real), "province", "year"), "timeline": summed(partial.filter("year is not null"), "year", "scope"), "volume": summed(partial, "province", convertible=True),
        "unit_profile": summed(partial, "unit", "factor"), "period_kinds": summed(partial, "kind"), "top_indicators": top_indicators(partial), "breadth": breadth(partial, "province"),
    }
