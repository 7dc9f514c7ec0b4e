"""Cell reads: published figures by form, raw label, series, publisher and year. Ambiguity is shown, never resolved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.units import confidence, out_of_magnitude, times
from ledgerloom.operators.ranks import order_statistics
from ledgerloom.plans.common import checkpointed

CELL = ["form_code", "indicator_raw", "series", "province", "year"]
#: The same in the order in which a grouping sorts them: a sort compares by the beginning of its first column, so that is one of many values.
_SORTED = ["province", "year", "indicator_raw", "series", "form_code"]


def ratio(a: Column, b: Column) -> Column:
    """a / b to four places, half up; null where either is null or 0."""
    return F.when((a != 0) & (b != 0), F.floor(a / b * 10000 + 0.5) / 10000.0)


def upper_median(column: str) -> Column:
    """The element at n div 2 (from 0) of the sorted values: an element, not a mean."""
    values = F.sort_array(F.collect_list(column))
    return F.try_element_at(values, (F.floor(F.size(values) / 2) + 1).cast("int"))


def cells(v: DataFrame, form: str | None = None, indicator: str | None = None, series: str | None = None, province: str | None = None, year: int | None = None) -> DataFrame:
    """(cell, n, lo, hi, first id, unit) of rows that have a figure, narrowed to what is given."""
    for column, given in (("form_code", form), ("indicator_raw", indicator), ("series", series), ("province", province), ("year", year)):
        v = v if given is None else v.filter(F.col(column) == given)
    by = v.filter("vnd is not null").groupBy(*_SORTED).agg(F.count(F.lit(1)).alias("n"), F.min("vnd").alias("lo"), F.max("vnd").alias("hi"), F.min("id").alias("first_id"), F.min_by("unit", "id").alias("unit"))
    return by.select(*CELL, "n", "lo", "hi", "first_id", "unit")


def series_for(v: DataFrame, form: str, indicator: str, province: str | None = None) -> DataFrame:
    """Series of an indicator by publishers, then rows; figures only, of one publisher if given."""
    own = v.filter((F.col("form_code") == form) & (F.col("indicator_raw") == indicator) & F.col("vnd").isNotNull())
    own = own if province is None else own.filter(F.col("province") == province)
    return own.groupBy("series").agg(F.countDistinct("province").alias("provinces"), F.count(F.lit(1)).alias("row_count")).orderBy(F.desc("provinces"), F.desc("row_count"), "series")


def pick_series(v: DataFrame, form: str, indicator: str, series: str | None = None, province: str | None = None) -> str:
    """The series asked for, or the only one, of one publisher if given; otherwise ValueError with the menu."""
    menu = [r["series"] for r in series_for(v, form, indicator, province).limit(50).collect()]
    if series is not None and series in menu:
        return series
    if series is None and len(menu) == 1:
        return menu[0]
    raise ValueError(f"choose a series of {menu}")


def coverage_gap(rows: DataFrame, dim: DataFrame, key: str = "province") -> DataFrame:
    """One row: have, total and missing, the expected keys without a row."""
    have = rows.select(key).distinct()
    missing = dim.select(key).distinct().join(have, key, "left_anti").agg(F.array_join(F.sort_array(F.collect_list(key)), "; ").alias("missing"))
    counts = dim.select(key).distinct().join(have.withColumn("__h", F.lit(1)), key, "left").agg(F.count("__h").alias("have"), F.count(F.lit(1)).alias("total"))
    return counts.crossJoin(missing)  # one row each


def _flag(odd: Column) -> Column:
    """What is wrong with a cell: several figures, one out of all magnitude, or one that can't be an amount of money."""
    several = (F.col("n") > 1) & (F.col("lo") != F.col("hi"))
    return F.when(several, "AMBIGUOUS").when(odd, "MAGNITUDE?").otherwise(confidence(F.col("lo"), F.col("series"), F.col("unit")))


def timeseries(v: DataFrame, form: str, indicator: str, series: str, province: str | None = None) -> DataFrame:
    """Every (or one) publisher's yearly figures; AMBIGUOUS cells are blank with their range; MAGNITUDE? where a history of positive figures spans more than a hundredfold."""
    c = cells(v, form, indicator, series, province)
    own, positive = Window.partitionBy("province"), F.when(F.col("lo") > 0, F.col("lo"))
    flagged = c.withColumn("flag", _flag(F.coalesce(F.max(positive).over(own) > times(F.min(positive).over(own), 100), F.lit(False))))
    return flagged.select("province", "year", F.when(F.col("flag") != "AMBIGUOUS", F.col("lo")).alias("vnd"), "lo", "hi", "n", "flag")


def compare_publishers(v: DataFrame, form: str, indicator: str, series: str, year: int | None = None) -> DataFrame:
    """Publishers by figure in the given year, or the one that most publish (the latest of several); MAGNITUDE? below a hundredth of the median of positive ones. A published 0 is a figure."""
    c = cells(v, form, indicator, series)
    if year is None:
        best = c.groupBy("year").agg(F.countDistinct("province").alias("k")).agg(F.max_by("year", F.struct("k", "year")).alias("__y"))
        c = c.join(F.broadcast(best), F.col("year") == F.col("__y")).drop("__y")  # one row
    else:
        c = c.filter(F.col("year") == year)
    c = checkpointed(c)
    # Publishers may be many: their median is found by counting.
    positive = order_statistics(c.filter("lo > 0").withColumn("__all", F.lit(0)), "__all", "lo", {"median": (1, 2)}).agg(F.max("median").alias("median"))
    low = F.coalesce((F.col("lo") != 0) & (times(F.col("lo"), 100) < F.col("median")), F.lit(False))
    return c.crossJoin(F.broadcast(positive)).select("province", "year", "lo", "hi", "n", _flag(low).alias("flag"))  # one row of a median


def medians(v: DataFrame, form: str, series: str) -> DataFrame:
    """(province, indicator_raw, median): upper median of a publisher's positive figures of a label, of three or more."""
    pos = v.filter((F.col("form_code") == form) & (F.col("series") == series) & (F.col("vnd") > 0))
    return pos.groupBy("province", "indicator_raw").agg(upper_median("vnd").alias("median"), F.count(F.lit(1)).alias("n")).filter("n >= 3").drop("n")


def cell_medians(v: DataFrame, form: str, series: str) -> DataFrame:
    """medians() beside each positive figure, with its flag."""
    pos = v.filter((F.col("form_code") == form) & (F.col("series") == series) & (F.col("vnd") > 0))
    off = out_of_magnitude(F.col("vnd"), F.col("median"))
    key = ["province", "indicator_raw"]
    return pos.join(medians(v, form, series), key).select("id", *key, "year", "vnd", "median", F.when(off, "MAGNITUDE?").otherwise("").alias("flag"))


def plan_vs_outturn(v: DataFrame, form: str, indicator: str, plan: str = "PLAN", actual: str = "OUTTURN", province: str | None = None, year: int | None = None) -> DataFrame:
    """Publishers and years, or those given, with one plan and one outturn figure, neither 0, and their ratio: one pass, no self-join."""
    own = v.filter((F.col("form_code") == form) & (F.col("indicator_raw") == indicator) & F.col("series").isin(plan, actual) & F.col("vnd").isNotNull())
    for column, given in (("province", province), ("year", year)):
        own = own if given is None else own.filter(F.col(column) == given)
    def of(series: str, name: str) -> list[Column]:
        at = F.when(F.col("series") == series, F.col("vnd"))
        return [F.count(at).alias(f"n_{name}"), F.max(at).alias(name)]

    both = own.groupBy("province", "year").agg(*of(plan, "plan"), *of(actual, "outturn")).filter("n_plan = 1 and n_outturn = 1 and plan <> 0 and outturn <> 0")
    return both.select("province", "year", "plan", "outturn", ratio(F.col("outturn"), F.col("plan")).alias("ratio"))


def naive_sum_ratio(v: DataFrame, form: str, series: str, total: str) -> DataFrame:
    """How far summing a whole form overstates its published total, by publisher and year."""
    own = v.filter((F.col("form_code") == form) & (F.col("series") == series))
    summed = own.groupBy("province", "year").agg(F.sum("vnd").alias("naive"), F.max(F.when(F.col("indicator_raw") == total, F.col("vnd"))).alias("published")).filter("published > 0")
    return summed.withColumn("ratio", ratio(F.col("naive"), F.col("published")))


def ambiguous_keys(v: DataFrame, label: str) -> DataFrame:
    """By form: cell keys, and those that more than one row bears."""
    keyed = v.groupBy("form_code", label, "series", "province", "year").agg(F.count(F.lit(1)).alias("n"))
    return keyed.groupBy("form_code").agg(F.count(F.lit(1)).alias("keys"), F.count_if(F.col("n") > 1).alias("ambiguous"))


def multi_report_blocks(v: DataFrame) -> DataFrame:
    """Forms of a publisher, year and series that come from more than one report."""
    return v.groupBy("province", "year", "form_code", "series").agg(F.countDistinct("report_id").alias("reports")).filter("reports > 1")


def trace_source(v: DataFrame, reports: DataFrame, form: str, indicator: str, series: str, province: str | None = None, year: int | None = None) -> DataFrame:
    """The published text behind each figure of a cell, and its report, where the catalog has it."""
    own = v.filter((F.col("form_code") == form) & (F.col("indicator_raw") == indicator) & (F.col("series") == series))
    for column, given in (("province", province), ("year", year)):
        own = own if given is None else own.filter(F.col(column) == given)
    return own.join(reports.select("report_id", "title", "method"), "report_id", "left").select("id", "province", "year", "raw", "value", "unit", "vnd", "report_id", "title", "method")
