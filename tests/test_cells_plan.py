"""How cells are grouped."""

import re

from ledgerloom.operators import cells as C

V = "id long, form_code string, indicator_raw string, series string, province string, year int, vnd long, unit string"


def test_cells_are_sorted_by_publisher_first(spark):
    rows = [(1, "F", "A", "PLAN", "p", 2000, 5, "x"), (0, "F", "A", "PLAN", "p", 2000, 7, "y"), (2, "F", "A", "PLAN", None, 2000, 1, "x"), (3, "F", "A", "PLAN", "p", 2001, None, "x"), (4, "G", "A", "PLAN", "p", 2000, 2, None)]
    found = C.cells(spark.createDataFrame(rows, V))
    sorts = re.findall(r"Sort \[(\w+)#", found._jdf.queryExecution().executedPlan().toString())
    assert sorts and set(sorts) == {"province"}  # all forms may have one code, which tells no rows apart
    assert found.columns == [*C.CELL, "n", "lo", "hi", "first_id", "unit"]
    assert {tuple(r) for r in found.collect()} == {("F", "A", "PLAN", "p", 2000, 2, 5, 7, 0, "y"), ("F", "A", "PLAN", None, 2000, 1, 1, 1, 2, "x"), ("G", "A", "PLAN", "p", 2000, 1, 2, 2, 4, None)}
