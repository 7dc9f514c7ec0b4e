"""Amounts whose multiples are beyond 64 bits are compared as whole numbers, not refused."""

from pyspark.sql import functions as F

from ledgerloom.functions import units as U
from ledgerloom.operators import cells as C
from ledgerloom.operators import hierarchy as H
from ledgerloom.operators import quality as Q
from ledgerloom.operators import reads as B

#: 200 times this is no long, nor is 100 times; BIG // 100 is on the edge of a hundredth.
BIG = 4 * 10**17
V = "id long, form_code string, indicator_raw string, series string, province string, year int, vnd long, unit string"


def rows(spark, *figures, label="A"):
    """One publisher's figures of a label, a year each."""
    return spark.createDataFrame([(i, "F", label, "PLAN", "p", 2000 + i, x, "VND") for i, x in enumerate(figures)], V)


def test_a_large_value_and_its_median(spark):
    df = spark.createDataFrame([(BIG, BIG // 100), (BIG + 1, BIG // 100), (BIG // 100, BIG), (BIG // 100 - 1, BIG), (BIG, None)], "v long, m long")
    assert [r[0] for r in df.select(U.magnitude_flag(F.col("v"), F.col("m"))).collect()] == ["", "MAGNITUDE?", "", "MAGNITUDE?", ""]
    small = spark.createDataFrame([(0.009, 1.0), (0.01, 1.0), (100.5, 1.0)], "v double, m double")
    assert [r[0] for r in small.select(U.magnitude_flag(F.col("v"), F.col("m"))).collect()] == ["MAGNITUDE?", "", "MAGNITUDE?"]


def test_medians_of_large_cells(spark):
    found = C.cell_medians(rows(spark, BIG, BIG + 1, BIG // 100, BIG // 100 - 1, BIG * 20), "F", "PLAN").orderBy("id")
    assert [(r["median"], r["flag"]) for r in found.collect()] == [(BIG, ""), (BIG, ""), (BIG, ""), (BIG, "MAGNITUDE?"), (BIG, "")]


def test_a_balance_sheet_of_large_amounts(spark):
    v = rows(spark, BIG, BIG, BIG // 100 - 1).unionByName(rows(spark, BIG // 2, BIG // 2, BIG // 2, label="B"))
    sheet = lambda **one: {r["year"]: (r["share"], r["flag"]) for r in B.balance_sheet(v, "F", {"a": "A", "b": "B"}, "PLAN", {"share": ("b", "a")}, ["a", "b"], **one).collect()}
    assert sheet() == {2002: ("?", "MAGNITUDE?")} and sheet(year=2001) == {2001: ("5000", "")}
    assert sheet(province="p") == {2000: ("5000", ""), 2001: ("5000", ""), 2002: ("?", "MAGNITUDE?")}


def test_residuals_of_large_amounts(spark):
    labels = [("I one", BIG), ("1 a", BIG - BIG // 200), ("II two", BIG), ("1 b", BIG - BIG // 200 - 1), ("III three", BIG), ("1 c", BIG // 4)]
    v = spark.createDataFrame([(i, "p", label, x) for i, (label, x) in enumerate(labels)], "id long, province string, indicator_raw string, vnd long")
    found = H.break_down(H.block_levels(v, ["province"]), ["province"])
    assert {r["parent_id"]: (r["residual"], r["reconciles"]) for r in found.collect()} == {0: (BIG // 200, True), 2: (BIG // 200 + 1, False), 4: (BIG - BIG // 4, False)}


def test_large_amounts_of_publishers_and_years(spark):
    figures = [BIG, BIG, BIG // 100, BIG // 100 - 1, BIG]
    v = spark.createDataFrame([(i, "F", "A", "PLAN", f"p{i}", 2000, x, "VND") for i, x in enumerate(figures)], V)
    of_amount = "implausible"  # all are beyond what an amount of money can be
    for year in (None, 2000):
        assert [r["flag"] for r in C.compare_publishers(v, "F", "A", "PLAN", year).orderBy("province").collect()] == [of_amount] * 3 + ["MAGNITUDE?", of_amount]
    history = lambda *x: {r["flag"] for r in C.timeseries(rows(spark, *x), "F", "A", "PLAN").collect()}
    assert history(BIG * 10, BIG // 10) == {of_amount} and history(BIG * 10 + 1, BIG // 10) == {"MAGNITUDE?"}


def test_histories_of_large_amounts(spark):
    found = Q.dq_magnitude(rows(spark, BIG, BIG // 100).unionByName(rows(spark, BIG, BIG // 100 + 1, label="B")).unionByName(rows(spark, BIG, BIG * 20, label="C")))
    assert [(r["indicator_raw"], r["history"]) for r in found.collect()] == [("A", f"2000={BIG}, 2001={BIG // 100}")]
