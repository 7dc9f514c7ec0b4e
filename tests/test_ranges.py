"""Few rows make few ranges and few files, whatever number of partitions is set for the rest of the input."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.order import placed
from ledgerloom.sources import versions, warehouse
from test_warehouse import long_rows, statuses


@pytest.fixture
def many_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_ranges_follow_from_the_rows(spark, many_partitions):
    rows = spark.createDataFrame([("a" if i % 3 else "b", i * 37 % 1000) for i in range(1000)], "g string, x long")
    whole, few = (placed(rows, "g", [F.col("x")], least).withColumn("at", F.spark_partition_id()).collect() for least in (None, 300))
    assert len({r["at"] for r in whole}) > 40 and len({r["at"] for r in few}) <= 4
    assert sorted((r["g"], r["x"], r["pos"], r["n"]) for r in whole) == sorted((r["g"], r["x"], r["pos"], r["n"]) for r in few)


def test_a_dimension_of_a_thousand_labels_is_one_file(spark, many_partitions, tmp_path):
    path = str(tmp_path / "wh")
    warehouse.load(spark, path, long_rows(spark, [(i, "Huế", 2020, f"label {i:04}", str(i), "đồng") for i in range(1000)]), statuses(spark, ["Huế"]))
    star = versions.read_all(spark, path, ("indicator", "fact_row", "none"))
    assert {n: df.count() for n, df in star.items()} == {"indicator": 1000, "fact_row": 1000}
    assert [(r["id"], r["label"]) for r in star["indicator"].orderBy("id").collect()] == [(i + 1, f"label {i:04}") for i in range(1000)]
    assert len(star["indicator"].inputFiles()) == 1
