"""From decoded files and the catalog to the long table, and from there to the star schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import text as X
from ledgerloom.functions.units import canon_unit, to_vnd, unit_factor
from ledgerloom.operators import dedup, forms
from ledgerloom.operators.order import RANGE_ROWS, placed
from ledgerloom.plans.common import checkpointed

_STRINGS = ("province_current", "province_source", "doc_no", "doc_date", "period", "agency", "scope", "table_label", "indicator_raw", "series", "raw")
#: The 16 published columns, then lineage: source order carries meaning, and rows have none of their own.
LONG_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in _STRINGS] + [T.StructField("value", T.DoubleType()), T.StructField("unit", T.StringType()), T.StructField("vnd", T.DoubleType()), T.StructField("source_url", T.StringType()), T.StructField("note", T.StringType())]
    + [T.StructField("report_id", T.LongType()), T.StructField("method", T.StringType()), T.StructField("file", T.StringType()), T.StructField("sheet", T.StringType()), T.StructField("row_ord", T.IntegerType()), T.StructField("col_ord", T.IntegerType())]
)
COLUMNS = [f.name for f in LONG_SCHEMA.fields[:16]]
LINEAGE = ["report_id", "file", "sheet", "row_ord", "col_ord"]
#: Columns that make a logical duplicate, beside the published text.
KEY = ["province_source", "doc_no", "period", "table_label", "indicator_raw", "series"]


def _scalars(tags: DataFrame) -> DataFrame:
    """(path, unit, code, ...): the fields of each XML form beside its table. The tags' names."""
    names = {"x_unit": "curencyunit", "x_code": "code", "x_department": "department", "x_period": "periodType", "x_year": "year", "x_title": "title", "x_circular": "circular"}
    at = lambda tag: F.max(F.when(F.col("tag") == tag, X.strip(F.coalesce("text", F.lit("")))))
    return tags.filter("section = 'scalar'").groupBy("path").agg(*[at(t).alias(n) for n, t in names.items()])


def _long(melted: DataFrame, files: DataFrame, reports: DataFrame, method: str, own: dict[str, Column]) -> DataFrame:
    """melted rows (path, sheet, row_no, col_no, indicator_raw, series, raw) with what their file and report say."""
    both = melted.join(files, "path").join(reports, "report_id")
    got = to_vnd(F.col("raw"), own["unit"])
    period = F.trim(F.concat_ws(" ", F.nullif(X.blank_coalesce(own["period"], F.col("period_type")), F.lit("")), F.nullif(X.blank_coalesce(own["year"], F.col("year_text")), F.lit(""))))
    label = F.concat(X.blank_coalesce(own["title"], F.col("title")), F.lit(" ["), X.blank_coalesce(own["form"], F.col("report_file")), F.lit("]"))
    origin = F.concat(X.blank_coalesce(own["circular"], F.col("circular")), F.lit(f"; {method} TT343; report "), F.col("report_id"))
    seen = both.withColumn("__got", got)
    note = F.concat(origin, F.when(F.col("__got.unit_note") != "", F.concat(F.lit("; "), "__got.unit_note")).otherwise(""))
    shown = {
        "province_current": F.col("province"), "province_source": X.blank_coalesce(own["department"], F.col("agency")), "doc_no": X.blank_coalesce(own["decision"], F.col("report_file")),
        "doc_date": X.blank_coalesce(F.col("approved_date"), F.col("publish_date")), "period": period, "agency": F.col("agency"), "scope": F.col("report_type"), "table_label": label,
        "indicator_raw": F.col("indicator_raw"), "series": F.col("series"), "raw": F.col("raw"), "value": F.col("__got.value"), "unit": F.col("__got.unit"), "vnd": F.col("__got.vnd"),
        "source_url": F.col("url"), "note": note, "report_id": F.col("report_id"), "method": F.lit(method), "file": F.col("path"), "sheet": F.col("sheet"), "row_ord": F.col("row_no"), "col_ord": F.col("col_no"),
    }
    return seen.select(*[shown[f.name].cast(f.dataType).alias(f.name) for f in LONG_SCHEMA.fields])


def long_from_xml(tags: DataFrame, files: DataFrame, reports: DataFrame) -> DataFrame:
    """Long rows of XML forms. files: (path, report_id, url). Blank cells stay as rows without a value."""
    melted = forms.form_melt(tags).withColumnRenamed("tag_ord", "col_no").withColumn("sheet", F.lit("")).join(_scalars(tags), "path", "left")
    c = F.col
    own = {"unit": X.blank_coalesce(c("x_unit"), c("currency_unit")), "period": c("x_period"), "year": c("x_year"), "title": c("x_title"), "form": c("x_code"), "circular": c("x_circular"), "department": c("x_department"), "decision": F.lit("")}
    return _long(melted, files, reports, "XML", own)


def long_from_sheets(cells: DataFrame, files: DataFrame, reports: DataFrame) -> DataFrame:
    """Long rows of workbooks; empty cells have none. cells is read twice at most."""
    melted = forms.melted_sheets(cells)
    none, c = F.lit(""), F.col
    own = {"unit": c("src_unit"), "period": none, "year": none, "title": none, "form": c("form"), "circular": none, "department": none, "decision": c("decision")}
    return _long(melted, files, reports, "XLSX", own)


def parsed_rows(tags: DataFrame, cells: DataFrame, files: DataFrame, reports: DataFrame) -> DataFrame:
    """Long rows of all files, before anything is left out. Decoded tags and cells are written once before anything reads them, as every reading would decode the files again."""
    tags, cells = checkpointed(tags.filter("error is null")), checkpointed(cells.filter("error is null"))
    return long_from_xml(tags, files, reports).unionByName(long_from_sheets(cells, files, reports))


def long_table(parsed: DataFrame) -> DataFrame:
    """The long table of stored parsed_rows(), with ord and dup_kind: rows of a report's XML forms, those of its workbooks only where these give none; of duplicates the first in source order has a blank dup_kind."""
    return dedup.mark_duplicates(in_source_order(forms.prefer_source(parsed)), COLUMNS, [*KEY, "raw"], "ord")


def build_long(tags: DataFrame, cells: DataFrame, files: DataFrame, reports: DataFrame) -> DataFrame:
    """long_table() of files without its duplicates."""
    return long_table(checkpointed(parsed_rows(tags, cells, files, reports))).filter("dup_kind = ''").drop("dup_kind")


def in_source_order(rows: DataFrame) -> DataFrame:
    """rows with ord, their place in the order of reports, files, sheets, rows and columns: 0, 1, ... without gaps."""
    at = placed(checkpointed(rows.withColumn("__all", F.lit(0))), "__all", [F.col(x) for x in LINEAGE], RANGE_ROWS)
    return checkpointed(at.withColumnRenamed("pos", "ord").drop("n", "__all"))


def parsed_counts(tags: DataFrame, cells: DataFrame, rows: DataFrame, files: DataFrame) -> DataFrame:
    """(report_id, xml_rows, sheet_rows, error) as report_status() takes them, of reports with landed files."""
    by = rows.groupBy("report_id").agg(F.count_if(F.col("method") == "XML").alias("xml_rows"), F.count_if(F.col("method") != "XML").alias("sheet_rows"))
    failed = tags.select("path", "error").unionByName(cells.select("path", "error")).filter("error is not null").join(files, "path").groupBy("report_id").agg(F.max("error").alias("error"))
    landed = files.select("report_id").distinct()
    return landed.join(by, "report_id", "left").join(failed, "report_id", "left").select("report_id", F.coalesce("xml_rows", F.lit(0)).alias("xml_rows"), F.coalesce("sheet_rows", F.lit(0)).alias("sheet_rows"), "error")


#: Dimensions that the fact points to: the long row's column, and what is known of a label.
_DIMS: dict[str, tuple[Callable[[], Column], dict[str, Callable[[Column], Column]]]] = {
    "province": (lambda: F.col("province_current"), {"slug": X.slug}),
    "period": (lambda: F.col("period"), {"year": X.period_year, "kind": X.period_kind}),
    "scope": (lambda: F.col("scope"), {}),
    "table": (lambda: F.col("table_label"), {"form_code": X.form_code}),
    "indicator": (lambda: F.col("indicator_raw"), {"clean": X.indicator_clean, "depth": X.indicator_depth}),
    "series": (lambda: F.col("series"), {}),
    # The label is the unit as published; what it is worth is said by the unit of the row that had it first.
    "unit": (lambda: X.note_unit(F.col("note"), F.col("unit")), {"factor": lambda _: F.coalesce(unit_factor(F.col("unit")), F.lit(0)), "canon": lambda _: canon_unit(F.col("unit"))}),
    "raw": (lambda: F.col("raw"), {}),
}


def build_star(rows: DataFrame, status: DataFrame, known: dict[str, DataFrame] | None = None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(fact, dimensions) of long rows (with ord) and the status of all reports: eight dimensions that the fact points to, and reports.

    known has the dimensions of a standing warehouse: their rows keep id and attributes, and new labels follow them in order of
    appearance. Ids are dense and equal in every run. The fact keeps no converted figure: it is value times the factor of the
    published unit's canonical form. ord gives source order. rows is read twice, so pass what is stored.
    """
    c = F.col
    names = F.explode(F.array(*[F.struct(F.lit(n).alias("dim"), F.coalesce(label(), F.lit("")).alias("label")) for n, (label, _) in _DIMS.items()]))
    firsts = rows.select("ord", "unit", names.alias("x")).select("ord", "unit", "x.*").groupBy("dim", "label").agg(F.min("ord").alias("first"), F.min_by("unit", "ord").alias("unit"))
    starts, old = F.lit(0), None
    for name in (n for n in _DIMS if n in (known or {})):
        own = known[name].select(F.lit(name).alias("dim"), "label", "id")
        old = own if old is None else old.unionByName(own)
    if old is not None:
        firsts = firsts.join(old.select("dim", "label"), ["dim", "label"], "left_anti")
        for r in old.groupBy("dim").agg(F.max("id").alias("id")).collect():  # one row a dimension
            starts = F.when(c("dim") == r["dim"], r["id"]).otherwise(starts)
    # All dimensions are numbered together, each from its own start, range by range of first appearance.
    fresh = checkpointed(placed(checkpointed(firsts), "dim", [c("first"), c("label")], RANGE_ROWS).select("dim", "label", "unit", (c("pos") + 1 + starts).cast("long").alias("id")))
    dims, fact = {}, rows.select("ord", "report_id", "value", *[F.coalesce(label(), F.lit("")).alias(f"__{n}") for n, (label, _) in _DIMS.items()])
    for name, (_, more) in _DIMS.items():
        dim = fresh.filter(c("dim") == name).select("id", "label", *[f(c("label")).alias(a) for a, f in more.items()])
        dims[name] = known[name].select(dim.columns).unionByName(dim) if name in (known or {}) else dim
        fact = fact.join(dims[name].select(c("label").alias(f"__{name}"), c("id").alias(f"{name}_id")), f"__{name}").drop(f"__{name}")
    reports = status.join(dims["province"].select(c("label").alias("province"), c("id").alias("province_id")), "province", "left").select("report_id", "province_id", "title", "year", "method", "reason", "exts", "rows")
    return fact, {**dims, "report": reports}


def view_fact(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """The fact with the labels of its dimensions, and the converted figure where the unit has a factor. Spark broadcasts what is small."""
    names = {"province": {"label": "province"}, "period": {"label": "period", "year": "year", "kind": "kind"}, "scope": {"label": "scope"}, "table": {"label": "table_label", "form_code": "form_code"},
             "indicator": {"label": "indicator_raw", "clean": "indicator", "depth": "depth"}, "series": {"label": "series"}, "unit": {"label": "unit_source", "canon": "unit", "factor": "factor"}, "raw": {"label": "raw"}}
    out = fact.withColumnRenamed("ord", "id")
    for name, columns in names.items():
        own = dims[name].select(F.col("id").alias(f"{name}_id"), *[F.col(a).alias(b) for a, b in columns.items()])
        out = out.join(own, f"{name}_id").drop(f"{name}_id")
    vnd = F.when(F.col("factor") > 0, F.col("value") * F.col("factor"))
    return out.withColumn("vnd", vnd).drop("factor")

