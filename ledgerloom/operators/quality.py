"""Data quality: audits of units, blanks and rules, restatement, migration, manifests and capped results."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.units import CURRENCY, canon_unit, clean_unit, norm_num, times, unit_factor


def unit_audit(df: DataFrame, unit: str = "unit") -> DataFrame:
    """Every spelling with its factor, canonical form and rows. Units are counted before anything is parsed."""
    seen = df.groupBy(unit).agg(F.count(F.lit(1)).alias("row_count"))
    return seen.select(F.col(unit).alias("unit"), unit_factor(F.col(unit)).alias("factor"), canon_unit(F.col(unit)).alias("canon"), "row_count")


def unconverted(audit: DataFrame) -> DataFrame:
    """The spellings of an audit that have no factor and aren't percent, the most frequent first; warn marks those with a currency's word in them."""
    words = F.split(F.lower(clean_unit(F.col("unit"))), r"[^\p{L}]+")
    left = audit.filter(F.col("factor").isNull() & (F.col("unit") != "") & (F.col("canon") != "%"))
    return left.withColumn("warn", F.arrays_overlap(words, F.array(*[F.lit(c) for c in CURRENCY]))).orderBy(F.desc("row_count"), "unit")


#: The counters of summary_qa, in order.
COUNTERS = ("reports", "extracted", "xml", "xlsx", "pending_pdf", "no_file", "failed", "raw_rows", "exact_dup", "logical_dup", "final_rows", "numeric_rows", "blank_rows", "vnd_rows")


def summary_qa(marked: DataFrame, status: DataFrame) -> DataFrame:
    """(province, label, value): counters of every publisher of status. One without rows has zeros: its reports failed.

    marked are rows with dup_kind, as mark_duplicates() gives them.
    """
    final, m = F.col("dup_kind") == "", F.col("method")
    rows = marked.groupBy("province").agg(
        F.count(F.lit(1)).alias("raw_rows"), F.count_if(F.col("dup_kind") == "exact").alias("exact_dup"), F.count_if(F.col("dup_kind") == "logical").alias("logical_dup"), F.count_if(final).alias("final_rows"),
        F.count(F.when(final, F.col("value"))).alias("numeric_rows"), F.count_if(final & F.col("value").isNull()).alias("blank_rows"), F.count(F.when(final, F.col("vnd"))).alias("vnd_rows"),
    )
    reports = status.groupBy("province").agg(
        F.count(F.lit(1)).alias("reports"), F.count_if(F.col("rows") > 0).alias("extracted"), F.count_if(m == "XML").alias("xml"), F.count_if(m == "XLSX").alias("xlsx"),
        F.count_if(m == "PENDING_PDF_DOC").alias("pending_pdf"), F.count_if(m == "PENDING_NO_FILE").alias("no_file"), F.count_if(m == "PARSE_FAILED").alias("failed"),
    )
    wide = reports.join(rows, "province", "left").select("province", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTERS])
    return wide.unpivot(["province"], list(COUNTERS), "label", "value")


def pending_review(status: DataFrame) -> DataFrame:
    """Reports without rows for a reason: year, title, formats that they have, method and the reason, cut to 180 characters."""
    open_ = status.filter(F.col("method").startswith("PENDING") | (F.col("method") == "PARSE_FAILED"))
    return open_.select("report_id", "province", "year", "title", "exts", "method", F.substring("reason", 1, 180).alias("reason")).orderBy("report_id")


def blank_census(df: DataFrame, by: str, raw: str = "raw") -> DataFrame:
    r = F.col(raw)
    zero = norm_num(r) == 0
    return df.groupBy(by).agg(F.count_if(r == "").alias("blank"), F.count_if(r == "-").alias("dash"), F.count_if(zero).alias("zero"), F.count_if(~r.isin("", "-") & ~F.coalesce(zero, F.lit(False))).alias("other"))


def rule_sweep(df: DataFrame) -> DataFrame:
    """One row of counts of broken rules, each of which should be 0."""
    blank, value, vnd, factor = F.col("raw") == "", F.col("value"), F.col("vnd"), F.col("factor")
    return df.agg(
        F.count_if(blank & value.isNotNull()).alias("blank_to_value"), F.count_if((F.col("raw") == "-") & (value == 0)).alias("dash_to_zero"),
        F.count_if(vnd.isNotNull() & factor.isNull()).alias("vnd_without_factor"), F.count_if(vnd.isNotNull() & F.col("unit").contains("%")).alias("vnd_on_percent"),
        F.count_if(vnd != value * factor).alias("wrong_product"), F.count_if(F.char_length("unit") > 40).alias("long_unit"),
    )


def restate_units(df: DataFrame, file: str, tolerance: float = 1e-9) -> tuple[DataFrame, DataFrame]:
    """(clean, conflicts): files restated in VND; a file with any figure that disagrees with what it states is left untouched.

    Restating twice changes nothing: a row in VND has factor 1, and a note is added once.
    """
    factor = unit_factor(F.col("unit"))
    fresh = F.col("value") * factor
    wrong = F.col("vnd").isNotNull() & fresh.isNotNull() & (F.abs(fresh - F.col("vnd")) > tolerance * F.greatest(F.abs("vnd"), F.lit(1)))
    marked = df.withColumn("__f", factor).withColumn("__new", fresh).withColumn("__bad", wrong)
    bad = marked.groupBy(F.col(file).alias("__file")).agg(F.max("__bad").alias("__any"))
    checked = marked.join(bad, F.col(file) == F.col("__file"))
    note = F.when((clean_unit(F.col("unit")) != canon_unit(F.col("unit"))) & ~F.coalesce("note", F.lit("")).contains("ĐVT nguồn:"), F.concat_ws("; ", F.nullif(F.col("note"), F.lit("")), F.concat(F.lit("ĐVT nguồn: "), clean_unit(F.col("unit"))))).otherwise(F.coalesce("note", F.lit("")))
    done = checked.filter(~F.col("__any")).withColumn("note", note).withColumn("value", F.coalesce("__new", "value")).withColumn("vnd", F.col("__new")).withColumn("unit", canon_unit(F.col("unit")))
    return done.select(df.columns), checked.filter("__any").select(F.col(file)).distinct()


def migrate_units(fact: DataFrame, version: int = 1) -> DataFrame:
    """fact with value in VND and canon_version; rows of this version or later are left as they are, so a second run changes nothing."""
    fact = fact if "canon_version" in fact.columns else fact.withColumn("canon_version", F.lit(0))
    old = F.col("canon_version") < version
    scaled = F.when(old & F.col("factor").isNotNull(), F.col("value") * F.col("factor")).otherwise(F.col("value"))
    return fact.withColumn("value", scaled).withColumn("canon_version", F.greatest(F.col("canon_version"), F.lit(version)))


def migration_plan(fact: DataFrame, unit: str = "unit") -> DataFrame:
    """By unit, known factor and version: rows, the factor that the unit has by rule, and whether migration must be refused: it would change a factor beyond 1."""
    by = fact.groupBy(F.col(unit).alias("unit"), "factor").agg(F.count(F.lit(1)).alias("row_count"), F.count("value").alias("value_count"))
    fresh = unit_factor(F.col("unit"))
    return by.withColumn("new_factor", fresh).withColumn("refused", F.coalesce((F.col("factor") > 1) & ~F.col("factor").eqNullSafe(fresh), F.lit(False)))


def migrate_checked(fact: DataFrame, version: int = 1) -> DataFrame:
    """migrate_units() after its plan; ValueError names the units whose factor would change. The plan has a row for each spelling of a unit."""
    wrong = [r["unit"] for r in migration_plan(fact).filter("refused").select("unit").limit(20).collect()]
    if wrong:
        raise ValueError(f"factors would change for {wrong}")
    return migrate_units(fact, version)


def invariants(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows and figures before and after."""
    count = lambda df, n: df.agg(F.count(F.lit(1)).alias(f"rows_{n}"), F.count("value").alias(f"values_{n}"))
    return count(before, "before").crossJoin(count(after, "after"))  # one row each


def count_manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows); one partial count each, in one plan."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def compare_manifests(a: DataFrame, b: DataFrame) -> DataFrame:
    """Tables whose counts differ, or that one side lacks."""
    both = a.withColumnRenamed("row_count", "before").join(b.withColumnRenamed("row_count", "after"), "table_name", "full")
    return both.filter(~F.col("before").eqNullSafe(F.col("after")))


def dq_pending(reports: DataFrame) -> DataFrame:
    return reports.filter("rows = 0").select("province", "report_id", "method", F.substring("reason", 1, 180).alias("reason"))


def dq_magnitude(v: DataFrame, spread: int = 100) -> DataFrame:
    """Cells whose positive yearly figures span a hundredfold or more, with their history."""
    yearly = v.filter("vnd > 0").groupBy("province", "form_code", "indicator_raw", "series", "year").agg(F.max("vnd").alias("vnd"))
    span = yearly.groupBy("province", "form_code", "indicator_raw", "series").agg(
        F.min("vnd").alias("least"), F.max("vnd").alias("most"), F.count(F.lit(1)).alias("years"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("year", "vnd"))), lambda x: F.concat(x["year"].cast("string"), F.lit("="), x["vnd"].cast("string"))), ", ").alias("history"),
    )
    return span.filter((F.col("years") >= 2) & (F.col("most") >= times(F.col("least"), spread)))


def dq_units(v: DataFrame) -> DataFrame:
    return v.filter("factor is null and unit <> ''").groupBy("unit").agg(F.count(F.lit(1)).alias("row_count"))


def dq_coverage(v: DataFrame) -> DataFrame:
    return v.groupBy("year").agg(F.countDistinct("province").alias("provinces"), F.count(F.lit(1)).alias("row_count"))


def list_data_quality(v: DataFrame, reports: DataFrame, block: str) -> DataFrame:
    if block not in ("pending", "magnitude", "units", "coverage"):
        raise ValueError(f"unknown block: {block}")
    return {"pending": lambda: dq_pending(reports), "magnitude": lambda: dq_magnitude(v), "units": lambda: dq_units(v), "coverage": lambda: dq_coverage(v)}[block]()


def capped_result(df: DataFrame, order: list[str], max_rows: int = 200, max_bytes: int = 1 << 20) -> DataFrame:
    """The first max_rows rows (500 at most) within a budget of bytes of text, and whether any were left out: the cap is the feature."""
    n = min(max_rows, 500)
    first = df.orderBy(*order).limit(n + 1)
    size = F.octet_length(F.to_json(F.struct(*df.columns)))
    w = Window.orderBy(*order)  # over the capped rows only
    run = first.withColumn("__n", F.row_number().over(w)).withColumn("__b", F.sum(size).over(w))
    flagged = run.withColumn("truncated", F.max((F.col("__n") > n) | (F.col("__b") > max_bytes)).over(Window.partitionBy()))
    return flagged.filter((F.col("__n") <= n) & (F.col("__b") <= max_bytes)).drop("__n", "__b")
