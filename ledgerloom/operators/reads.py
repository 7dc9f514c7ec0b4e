"""Curated reads: the balance sheet, and break-downs of one parent with the year and series that a reader would take."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.text import is_settled
from ledgerloom.functions.units import out_of_magnitude
from ledgerloom.operators import cells as C
from ledgerloom.operators import hierarchy as H


def narrowed(v: DataFrame, province: str | None, year: int | None) -> DataFrame:
    for column, given in (("province", province), ("year", year)):
        v = v if given is None else v.filter(F.col(column) == given)
    return v


def balance_sheet(v: DataFrame, form: str, named: dict[str, str], series: str, ratios: dict[str, tuple[str, str]], required: list[str], province: str | None = None, year: int | None = None) -> DataFrame:
    """Named cells by publisher and year, and ratios in hundredths of a percent as text.

    A cell counts if it has one figure, however often that is published. Without a year or publisher each publisher has one
    row: its latest year in which the required cells are published, be they 0. With a publisher all its years are shown.
    A ratio is blank where a figure lacks or is 0, and reads ? where either is out of its history's magnitude; so flagged is the row.
    """
    own = C.cells(v, form, None, series, province, year).filter(F.col("indicator_raw").isin(*named.values())).filter("n = 1 or lo = hi")
    off = (F.col("lo") != 0) & out_of_magnitude(F.col("lo"), F.col("median"))
    own = own.join(C.medians(v, form, series), ["province", "indicator_raw"], "left").withColumn("off", F.coalesce(off, F.lit(False)))
    at = lambda label, column: F.max(F.when(F.col("indicator_raw") == label, F.col(column)))
    wide = own.groupBy("province", "year").agg(*[at(x, "lo").alias(n) for n, x in named.items()], *[F.coalesce(at(x, "off"), F.lit(False)).alias(f"__{n}") for n, x in named.items()])
    if year is None and province is None:
        last = Window.partitionBy("province").orderBy(F.desc("year"))
        wide = wide.dropna(subset=required).withColumn("__r", F.row_number().over(last)).filter("__r = 1").drop("__r")
    share = lambda a, b: F.when((F.col(a) != 0) & (F.col(b) != 0), F.when(F.col(f"__{a}") | F.col(f"__{b}"), "?").otherwise(F.floor(F.col(a) / F.col(b) * 10000 + 0.5).cast("long").cast("string")))
    flag = F.when(reduce(lambda a, b: a | b, [F.col(f"__{n}") for n in named]), "MAGNITUDE?").otherwise("")
    return wide.select("province", "year", *named, *[F.coalesce(share(a, b), F.lit("")).alias(n) for n, (a, b) in ratios.items()], flag.alias("flag"))


def breakdown_of(v: DataFrame, block: list[str], form: str, parent: str, series: str, province: str | None = None, year: int | None = None) -> DataFrame:
    """The break-down of one published parent by publisher, of the year asked for or the latest one with a figure.

    Only blocks that hold such a parent are walked.
    """
    own = narrowed(v.filter((F.col("form_code") == form) & (F.col("series") == series)), province, year)
    tops = own.filter((F.col("indicator_raw") == parent) & F.col("vnd").isNotNull()).select("province", "year", F.col("id").alias("parent_id"))
    if year is None:
        tops = tops.join(tops.groupBy("province").agg(F.max("year").alias("year")), ["province", "year"], "left_semi")
    inside = own.join(tops.select("province", "year").distinct(), ["province", "year"], "left_semi")
    found = H.break_down(H.block_levels(inside, block), block)
    return found.join(tops.select("parent_id"), "parent_id", "left_semi")


def revenue_breakdown(v: DataFrame, block: list[str], form: str, parent: str, series: dict[bool, str], basis: str = "quyết toán", province: str | None = None, year: int | None = None) -> DataFrame:
    """breakdown_of() with the series that a basis in words asks for: series[True] has settled figures."""
    return breakdown_of(v, block, form, parent, series[is_settled(basis)], province, year)


def spending_by_sector(v: DataFrame, block: list[str], forms: dict[bool, tuple[str, str]], parent: str, denominators: dict[str, str], basis: str = "dự toán", province: str | None = None, year: int | None = None) -> DataFrame:
    """breakdown_of() in the (form, series) of a basis, beside the figures that a share could be taken of; they are different amounts."""
    form, series = forms[is_settled(basis)]
    body = breakdown_of(v, block, form, parent, series, province, year)
    beside = C.cells(v, form, None, series, province, year).filter(F.col("indicator_raw").isin(*denominators.values()))
    at = lambda label: F.min(F.when(F.col("indicator_raw") == label, F.col("lo")))
    wide = beside.groupBy("province", "year").agg(*[at(x).alias(n) for n, x in denominators.items()])
    return body.join(wide, ["province", "year"], "left")


def over_plan(compared: DataFrame) -> DataFrame:
    """plan_vs_outturn()'s rows by falling ratio, with the number of all that came in above plan."""
    over = compared.agg(F.count_if(F.col("outturn") > F.col("plan")).alias("over_plan"))
    return compared.crossJoin(F.broadcast(over)).orderBy(F.desc("ratio"), "province", "year")  # one row

