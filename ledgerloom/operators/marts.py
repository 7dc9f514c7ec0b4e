"""Marts: census, coverage, pivots of published cells, compositions and trends. Published totals are never summed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.cells import ratio
from ledgerloom.operators.ranks import order_statistics
from ledgerloom.plans.common import checkpointed


def kpi(v: DataFrame, reports: DataFrame) -> DataFrame:
    facts = v.agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("province").alias("provinces"), F.count("vnd").alias("convertible"),
        F.countDistinct("year").alias("years"), F.countDistinct("indicator_raw").alias("indicators"),
    )
    listed = reports.agg(F.count(F.lit(1)).alias("reports"), F.count_if(F.col("rows") == 0).alias("empty_reports"))
    return facts.crossJoin(listed)  # one row each


def coverage_grid(v: DataFrame) -> DataFrame:
    real = F.col("year").cast("string").rlike("^[12][0-9]{3}$")
    return v.filter(real).groupBy("province", "year").agg(F.count(F.lit(1)).alias("row_count"))


def counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"))


def volume(v: DataFrame) -> DataFrame:
    return v.groupBy("province").agg(F.count(F.lit(1)).alias("row_count"), F.count("vnd").alias("convertible"))


def top(df: DataFrame, label: str, n: int) -> DataFrame:
    """The n most frequent labels; ties by label."""
    return counts(df, label).orderBy(F.desc("row_count"), label).limit(n)


def pick(indicator: str, series: str | None = None) -> Column:
    """In a grouping: the figure of a named cell; of several the last in source order."""
    at = F.col("indicator_raw") == indicator
    at = at if series is None else at & (F.col("series") == series)
    return F.max_by(F.when(at, F.col("vnd")), F.when(at & F.col("vnd").isNotNull(), F.col("id")))


def balance_pivot(v: DataFrame, form: str, named: dict[str, str], series: str, ratios: dict[str, tuple[str, str]]) -> DataFrame:
    """Named cells as columns by publisher and year, and ratios of them."""
    own = v.filter((F.col("form_code") == form) & (F.col("series") == series) & F.col("indicator_raw").isin(*named.values()))
    wide = own.groupBy("province", "year").agg(*[pick(label).alias(name) for name, label in named.items()])
    return wide.select("*", *[ratio(F.col(a), F.col(b)).alias(name) for name, (a, b) in ratios.items()])


def latest_complete(df: DataFrame, required: list[str]) -> DataFrame:
    """Each publisher's latest year in which the required columns have a figure other than 0."""
    full = df
    for c in required:
        full = full.filter(F.coalesce(F.col(c), F.lit(0)) != 0)
    last = Window.partitionBy("province").orderBy(F.desc("year"))
    return full.withColumn("__n", F.row_number().over(last)).filter("__n = 1").drop("__n")


def unambiguous_cells(v: DataFrame, form: str, series: str) -> DataFrame:
    """Cells that one row alone bears. dropped_cells() counts the rest."""
    return _keyed(v, form, series).filter("n = 1").drop("n")


def dropped_cells(v: DataFrame, form: str, series: str) -> DataFrame:
    return _keyed(v, form, series).groupBy("form_code").agg(F.count_if(F.col("n") > 1).alias("dropped"), F.count_if(F.col("n") == 1).alias("kept"))


def _keyed(v: DataFrame, form: str, series: str) -> DataFrame:
    own = v.filter((F.col("form_code") == form) & (F.col("series") == series) & F.col("vnd").isNotNull())
    return own.groupBy("form_code", "province", "year", "indicator_raw").agg(F.count(F.lit(1)).alias("n"), F.min("vnd").alias("vnd"))


def mix(cells: DataFrame, total: str, parts: dict[str, str], min_parts: int = 5, tolerance: float = 1.02) -> DataFrame:
    """Composition of a published total in each publisher's latest year that has one: a column for each named part, and what they leave as other.

    Kept only with min_parts parts or more that don't exceed the total by more than the tolerance. Parts of 0 don't count.
    """
    at = lambda label: F.max(F.when((F.col("indicator_raw") == label) & (F.col("vnd") != 0), F.col("vnd")))
    wide = cells.filter(F.col("indicator_raw").isin(total, *parts.values())).groupBy("province", "year").agg(at(total).alias("total"), *[at(x).alias(n) for n, x in parts.items()])
    last = latest_complete(wide, ["total"])
    named = reduce(lambda a, b: a + b, [F.coalesce(n, F.lit(0)) for n in parts])
    n_parts = reduce(lambda a, b: a + b, [F.col(n).isNotNull().cast("long") for n in parts])
    summed = last.withColumn("named", named).withColumn("n_parts", n_parts)
    kept = summed.filter((F.col("n_parts") >= min_parts) & (F.col("named") <= F.col("total") * tolerance))
    return kept.withColumn("other", F.greatest(F.col("total") - F.col("named"), F.lit(0).cast("long")))


def borrowing(cells: DataFrame, named: dict[str, str], spending: str = "spending") -> DataFrame:
    """Named figures (deficit, borrowing, repayment) of each publisher's latest year that has total spending; the others may lack."""
    at = lambda label: F.max(F.when(F.col("indicator_raw") == label, F.col("vnd")))
    wide = cells.filter(F.col("indicator_raw").isin(*named.values())).groupBy("province", "year").agg(*[at(x).alias(n) for n, x in named.items()])
    return latest_complete(wide, [spending])


def trend_quartiles(cells: DataFrame, indicator: str, min_n: int = 8) -> DataFrame:
    """Nearest-rank quartiles of publishers' figures by year, for years with min_n of them: elements, not interpolated.

    cells are unambiguous ones; figures of 0 are no figures.
    """
    own = checkpointed(cells.filter((F.col("indicator_raw") == indicator) & (F.col("vnd") != 0)).select("year", "vnd"))
    found = order_statistics(own, "year", "vnd", {"q1": (1, 4), "median": (2, 4), "q3": (3, 4)})
    return found.filter(F.col("n") >= min_n).select("year", "n", "q1", "median", "q3")


def correlation(wide: DataFrame, a: str, b: str) -> DataFrame:
    """One row: the correlation of two columns where both are known, to six places."""
    both = wide.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    return both.agg((F.floor(F.corr(a, b) * 1000000 + 0.5) / 1000000.0).alias("corr"))


def share_stats(wide: DataFrame, share: str, against: str) -> DataFrame:
    """One row: least, most and middle of a share, and in how many another one is larger."""
    return wide.filter(F.col(share).isNotNull()).agg(F.min(share).alias("least"), F.max(share).alias("most"), F.median(share).alias("mid"), F.count_if(F.col(against) > F.col(share)).alias("investing"), F.count(F.lit(1)).alias("n"))


def beaten(compared: DataFrame) -> DataFrame:
    """One row: of plans and outturns how many there are, how many outturns lie above the plan, and that share."""
    n, over = F.count(F.lit(1)), F.count_if(F.col("ratio") > 1)
    return compared.agg(n.alias("n"), over.alias("over_plan"), (F.floor(over / n * 10000 + 0.5) / 10000.0).alias("share"))


def spread(wide: DataFrame, column: str) -> DataFrame:
    """One row: the largest and the smallest positive figure, whose they are, and how many times one is the other."""
    own = wide.filter(F.col(column) > 0)
    ends = own.agg(F.max_by("province", F.struct(F.col(column), "province")).alias("largest_of"), F.max(column).alias("largest"), F.min_by("province", F.struct(F.col(column), "province")).alias("smallest_of"), F.min(column).alias("smallest"))
    return ends.withColumn("times", ratio(F.col("largest"), F.col("smallest")))


def compared_shares(wide: DataFrame, total: str, a: str, b: str) -> DataFrame:
    """One row: of the rows that have a total and both parts, how many there are, in how many a exceeds b, and the median share of either in ten-thousandths."""
    own = wide.filter((F.col(total) > 0) & F.col(a).isNotNull() & F.col(b).isNotNull())
    share = lambda x: F.floor(F.col(x) / F.col(total) * 10000 + 0.5).cast("long")
    own = checkpointed(own.select(F.lit(0).alias("__all"), share(a).alias("x"), share(b).alias("y"), (F.col(a) > F.col(b)).alias("over")))
    counts = own.agg(F.count(F.lit(1)).alias("n"), F.count_if("over").alias("larger"))
    middle = lambda x, name: order_statistics(own, "__all", x, {name: (1, 2)}).select(name)
    return counts.crossJoin(middle("x", f"median_{a}")).crossJoin(middle("y", f"median_{b}"))  # one row each
