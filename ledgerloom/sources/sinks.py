"""Sinks: the long table by publisher, the warehouse, and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.quality import pending_review, summary_qa


def write_long(df: DataFrame, path: str, by: str = "province_current") -> None:
    """Parquet, a folder for each publisher; only publishers that df has are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def write_corpus(marked: DataFrame, status: DataFrame, path: str) -> None:
    """The long table, its QA summary and the reports that wait for review, beside each other.

    marked: long rows with dup_kind, of which those without one are the table; they are read twice, so pass what is stored.
    """
    write_long(marked.filter("dup_kind = ''").drop("dup_kind"), f"{path}/long")
    summary = summary_qa(marked.withColumn("province", F.col("province_current")), status)
    summary.write.mode("overwrite").parquet(f"{path}/summary_qa")
    pending_review(status).write.mode("overwrite").parquet(f"{path}/pending_review")


def write_star(fact: DataFrame, dims: dict[str, DataFrame], path: str, by: str = "province_id") -> None:
    for name, dim in dims.items():
        dim.write.mode("overwrite").parquet(f"{path}/{name}")
    write_long(fact, f"{path}/fact_row", by)


def write_marts(marts: dict[str, DataFrame], path: str, form: str = "json") -> None:
    for name, mart in marts.items():
        mart.write.mode("overwrite").format(form).save(f"{path}/{name}")
