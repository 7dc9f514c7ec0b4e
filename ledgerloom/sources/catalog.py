"""Landed catalogs: reports, attachments, and what is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CATALOG = """TotalItems bigint, Items array<struct<ID: bigint, Title: string, YearTextMonthOrPeriod: string, PeriodType_Name: string,
 ReportType_Name: string, ReportFileName: string, ReportCircular_Name: string, Deparment_Name: string, ApprovedDateText: string,
 PublishDateText: string, CurrencyUnit: string, Attachments: array<struct<FileName: string, Url: string>>>>"""
NAMES = ("id", "title", "year_text", "period_type", "report_type", "report_file", "circular", "agency", "approved_date", "publish_date", "currency_unit", "attachments")


def read_catalog(spark: SparkSession, path: str, publisher: str = r"([^/]*)/[^/]*$") -> tuple[DataFrame, DataFrame]:
    """(reports, gap): reports of all landed pages in page order, and for each publisher how many the server counts beyond them.

    A publisher's pages lie in one folder, whose name `publisher` finds in a path; a page's number is the last one in its file's name.
    """
    pages = spark.read.schema(CATALOG).json(path, multiLine=True).withColumn("file", F.input_file_name())
    pages = pages.withColumn("publisher", F.regexp_extract("file", publisher, 1)).withColumn("page", F.regexp_extract("file", r"(\d+)[^\d/]*$", 1).try_cast("int"))
    rows = pages.select("publisher", "page", F.posexplode("Items").alias("pos", "r")).select("publisher", "page", "pos", "r.*").toDF("publisher", "page", "pos", *NAMES)
    rows = rows.withColumn("attachments", F.col("attachments").cast("array<struct<file_name: string, url: string>>")).orderBy("publisher", "page", "pos")
    # Items are counted as they lie in the pages, so no report is read twice.
    gap = pages.groupBy("publisher").agg(F.max("TotalItems").alias("total"), F.sum(F.coalesce(F.size("Items"), F.lit(0))).alias("landed"))
    return rows, gap.withColumn("gap", F.col("total") - F.col("landed"))


def departments(df: DataFrame, title: str, ident: str) -> DataFrame:
    return df.select(F.col(title).alias("title"), F.col(ident).alias("id")).distinct()


def attachment_manifest(reports: DataFrame, files: str = "files", with_all: bool = False) -> DataFrame:
    """(report_id, filename, parseable) of every attachment; only those that can be parsed unless with_all. A report without files has none."""
    rows = reports.select("report_id", F.explode(files).alias("filename"))
    marked = rows.withColumn("parseable", F.lower("filename").rlike(r"\.(xml|xls|xlsx)$"))
    return marked if with_all else marked.filter("parseable")


def fingerprint(files: DataFrame, content: str = "content") -> DataFrame:
    """files with sha256 and bytes in place of the content."""
    return files.withColumns({"sha256": F.sha2(F.col(content), 256), "bytes": F.octet_length(F.col(content)).cast("long")}).drop(content)


def content_duplicates(files: DataFrame, name: str) -> DataFrame:
    """Contents that more than one file bears: sha256, copies, and the least name."""
    return files.groupBy("sha256", "bytes").agg(F.count(F.lit(1)).alias("copies"), F.min(name).alias("first_name")).filter("copies > 1")


def missing_files(manifest: DataFrame, landed: DataFrame, on: list[str]) -> DataFrame:
    return manifest.join(landed, on, "left_anti")


def build_status(expected: DataFrame, present: DataFrame, key: str = "province") -> DataFrame:
    """Every expected publisher and whether it has rows."""
    there = present.select(key).distinct().withColumn("__p", F.lit(True))
    return expected.select(key).distinct().join(there, key, "left").select(key, F.coalesce("__p", F.lit(False)).alias("built"))


def run_summary(status: DataFrame) -> DataFrame:
    pending = F.col("method").startswith("PENDING")
    return status.groupBy("province").agg(
        F.count(F.lit(1)).alias("reports"), F.count_if(F.col("rows") > 0).alias("ok"), F.count_if(F.col("method") == "PARSE_FAILED").alias("failed"),
        F.count_if(pending).alias("pending"), F.sum("rows").alias("row_count"),
    )


def list_publishers(publishers: DataFrame, facts: DataFrame, status: DataFrame) -> DataFrame:
    """Every publisher with rows, reports, reports without rows and span of years; those without any have zeros."""
    v = facts.groupBy("province").agg(F.count(F.lit(1)).alias("row_count"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))
    s = status.groupBy("province").agg(F.count(F.lit(1)).alias("reports"), F.count_if(F.col("rows") == 0).alias("empty_reports"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return publishers.select("province").join(v, "province", "left").join(s, "province", "left").select("province", zero("row_count"), zero("reports"), zero("empty_reports"), "first_year", "last_year")


def list_forms(facts: DataFrame, min_publishers: int = 25, limit: int = 30) -> DataFrame:
    """The forms that so many publishers have, the widest first: publishers, rows, span of years, and the least title. The limit is the feature."""
    by = facts.filter("form_code <> ''").groupBy("form_code").agg(F.countDistinct("province").alias("provinces"), F.count(F.lit(1)).alias("row_count"), F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.min("table_label").alias("example_title"))
    return by.filter(F.col("provinces") >= min_publishers).orderBy(F.desc("provinces"), F.desc("row_count"), "form_code").limit(limit)


def describe_corpus(facts: DataFrame, status: DataFrame) -> DataFrame:
    """By scope: rows, convertible ones, blanks and span of years, beside the number of reports."""
    by = facts.groupBy("scope").agg(F.count(F.lit(1)).alias("row_count"), F.count("vnd").alias("convertible"), F.count_if(F.col("raw") == "").alias("blanks"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))
    return by.crossJoin(F.broadcast(status.agg(F.count(F.lit(1)).alias("reports"))))  # one row
