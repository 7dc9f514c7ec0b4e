"""Forms as dataflow: header detection, fills, paths, units and melts over long tables of cells or tags.

Cells are (path, sheet, row_no, col_no, text), rows and columns from 0; tags are (path, section, row_no,
tag_ord, tag, text). A sheet is small and a key of its own, so windows run within sheets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.text import strip
from ledgerloom.functions.units import looks_like_unit, norm_num

SHEET = ["path", "sheet"]
#: Patterns of index and label columns, of rulers, units, forms and decisions.
INDEX_CELL = r"(?i)^(số\s*)?(stt|tt)\.?$"
LABEL_CELL = r"(nội dung|noi dung|chỉ tiêu|chi tieu|danh mục|danh muc|tên\s|ten\s|đơn vị sử dụng|khoản mục)"
RULER = r"^[A-Za-z]$|^\(?[0-9]{1,2}\)?$"
UNIT_SURE, UNIT_BARE = r"(?iu)Đơn vị\s*tính\s*[:：]\s*(.*)", r"(?iu)Đơn vị\s*[:：]\s*(.*)"
FORM_NO = r"(?iu)Biểu\s*số\s*([0-9A-Za-z/\-]+)"
DECISION = r"(?iu)(?:Quyết định|Nghị quyết)\s*số[:：]?\s*([^\s,;)]+)"
HEADER_WORDS = ("stt", "nội dung", "noi dung", "chỉ tiêu", "chi tieu")
SCAN_HEADER, SCAN_META, SCAN_DATA = 20, 60, 7


def banner_header(cells: DataFrame, name: str, rows: int = 8) -> DataFrame:
    """(path, sheet, hdr_row): the first of the leading rows with a cell that reads name."""
    return cells.filter((F.col("row_no") < rows) & (strip(F.col("text")) == name)).groupBy(*SHEET).agg(F.min("row_no").alias("hdr_row"))


def header_row(cells: DataFrame) -> DataFrame:
    """(path, sheet, hdr_row): the first of 20 rows with three cells or more and an index or label cell at its start."""
    t = strip(F.coalesce("text", F.lit("")))
    low = F.lower(t)
    per_row = cells.filter(F.col("row_no") < SCAN_HEADER).groupBy(*SHEET, "row_no").agg(
        F.count_if(t != "").alias("filled"), F.max((F.col("col_no") < 3) & low.rlike(INDEX_CELL)).alias("index"), F.max((F.col("col_no") < 4) & low.rlike(LABEL_CELL)).alias("label"),
    )
    return per_row.filter((F.col("filled") >= 3) & (F.col("index") | F.col("label"))).groupBy(*SHEET).agg(F.min("row_no").alias("hdr_row"))


def first_data_row(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """(path, sheet, hdr_row, data_row): the first of the seven rows after the header with a label in column 1 and a number beyond; else the next row."""
    near = cells.join(headers, SHEET).filter((F.col("row_no") > F.col("hdr_row")) & (F.col("row_no") <= F.col("hdr_row") + SCAN_DATA))
    label = (F.col("col_no") == 1) & (strip(F.coalesce("text", F.lit(""))) != "")
    number = (F.col("col_no") >= 2) & norm_num(F.col("text")).isNotNull()
    rows = near.groupBy(*SHEET, "row_no").agg(F.max(label).alias("l"), F.max(number).alias("n")).filter("l and n").groupBy(*SHEET).agg(F.min("row_no").alias("found"))
    return headers.join(rows, SHEET, "left").select(*SHEET, "hdr_row", F.coalesce("found", F.col("hdr_row") + 1).alias("data_row"))


def merged_fill(cells: DataFrame, bounds: DataFrame) -> DataFrame:
    """The header rows of each sheet as a dense grid, merged cells filled to the right."""
    width = cells.groupBy(*SHEET).agg(F.max("col_no").alias("w"))
    head = bounds.join(width, SHEET)
    grid = head.select(*SHEET, F.explode(F.sequence("hdr_row", F.col("data_row") - 1)).alias("row_no"), "w").select(*SHEET, "row_no", F.explode(F.sequence(F.lit(0), F.col("w"))).alias("col_no"))
    own = cells.select(*SHEET, "row_no", "col_no", F.nullif(strip(F.col("text")), F.lit("")).alias("text"))
    right = Window.partitionBy(*SHEET, "row_no").orderBy("col_no").rowsBetween(Window.unboundedPreceding, 0)
    return grid.join(own, [*SHEET, "row_no", "col_no"], "left").withColumn("text", F.last("text", ignorenulls=True).over(right))


def header_path(filled: DataFrame) -> DataFrame:
    """(path, sheet, col_no, series): header texts of a column from top to bottom, each once, joined; colN where there are none."""
    stacked = F.array_sort(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("row_no", "text"))))
    path = F.array_join(F.array_distinct(F.transform(stacked, lambda x: x["text"])), " / ")
    return filled.groupBy(*SHEET, "col_no").agg(path.alias("series")).withColumn("series", F.when(F.col("series") == "", F.concat(F.lit("col"), "col_no")).otherwise(F.col("series")))


def first_match_meta(cells: DataFrame) -> DataFrame:
    """(path, sheet, form, decision): the first match in the first 60 rows, each row joined by blanks."""
    rows = cells.filter(F.col("row_no") < SCAN_META).groupBy(*SHEET, "row_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col_no", F.coalesce("text", F.lit("")).alias("text")))), lambda x: x["text"]), " ").alias("line"))
    def first(pattern: str) -> Column:
        got = F.nullif(F.regexp_extract("line", pattern, 1), F.lit(""))
        return F.coalesce(F.min_by(got, F.when(got.isNotNull(), F.col("row_no"))), F.lit(""))

    return rows.groupBy(*SHEET).agg(first(FORM_NO).alias("form"), first(DECISION).alias("decision"))


def find_unit(cells: DataFrame) -> DataFrame:
    """(path, sheet, src_unit): a sure "Đơn vị tính:" first, else a bare "Đơn vị:" that looks like a unit; blank for none.

    Matched within single cells; a label alone takes the next cell of its row that isn't empty.
    """
    after = Window.partitionBy(*SHEET, "row_no").orderBy(F.desc("col_no")).rowsBetween(Window.unboundedPreceding, -1)
    t = strip(F.coalesce("text", F.lit("")))
    seen = cells.filter(F.col("row_no") < SCAN_META).withColumn("t", t).withColumn("next", F.coalesce(F.last(F.nullif(t, F.lit("")), ignorenulls=True).over(after), F.lit("")))
    def captured(pattern: str) -> Column:
        inside = strip(F.regexp_extract("t", pattern, 1))
        return F.when(F.col("t").rlike(pattern), F.when(inside != "", inside).otherwise(F.col("next")))

    both = seen.withColumn("sure", F.nullif(captured(UNIT_SURE), F.lit(""))).withColumn("bare", F.nullif(captured(UNIT_BARE), F.lit("")))
    usable = F.when(F.col("sure").isNotNull(), F.struct(F.lit(0).alias("o"), "row_no", "col_no")).when(looks_like_unit(F.col("bare")), F.struct(F.lit(1).alias("o"), "row_no", "col_no"))
    return both.groupBy(*SHEET).agg(F.coalesce(F.min_by(F.coalesce("sure", "bare"), usable), F.lit("")).alias("src_unit"))


def row_filter(cells: DataFrame, bounds: DataFrame) -> DataFrame:
    """(path, sheet, row_no, mark, label) of data rows: without a label, header words again, one-letter labels and rulers are dropped."""
    t = strip(F.coalesce("text", F.lit("")))
    rows = cells.join(bounds, SHEET).filter(F.col("row_no") >= F.col("data_row")).groupBy(*SHEET, "row_no").agg(
        F.coalesce(F.max(F.when(F.col("col_no") == 0, t)), F.lit("")).alias("mark"), F.coalesce(F.max(F.when(F.col("col_no") == 1, t)), F.lit("")).alias("label")
    )
    return rows.filter((F.col("label") != "") & ~F.lower("label").isin(*HEADER_WORDS) & ~F.col("label").rlike(RULER))


def sheet_melt(cells: DataFrame, rows: DataFrame, paths: DataFrame) -> DataFrame:
    """A row for each cell from column 2 on that isn't empty, with its row's label (mark before it) and its column's path."""
    values = cells.filter((F.col("col_no") >= 2) & (strip(F.coalesce("text", F.lit(""))) != ""))
    label = F.trim(F.concat_ws(" ", F.nullif(F.col("mark"), F.lit("")), F.col("label")))
    return (
        values.join(rows, [*SHEET, "row_no"]).join(paths, [*SHEET, "col_no"])
        .select(*SHEET, "row_no", "col_no", label.alias("indicator_raw"), "series", strip(F.col("text")).alias("raw"))
    )


# All of a sheet in one grouping ------------------------------------------------------------------------


def sheet_lines(cells: DataFrame) -> DataFrame:
    """(path, sheet, row_no, cells): each row of a sheet with its cells (col_no, text) from left to right, texts stripped."""
    cell = F.struct("col_no", strip(F.coalesce("text", F.lit(""))).alias("text"))
    return cells.groupBy(*SHEET, "row_no").agg(F.array_sort(F.collect_list(cell)).alias("cells"))  # one row of one sheet


def _any(test) -> Column:
    return F.exists("cells", test)


def _units() -> Column:
    """Of a line's cells the units they state: sure or bare, column, unit; a label alone takes the next text of its line."""
    def of(pattern: str, order: int) -> Column:
        def one(cell: Column, i: Column) -> Column:
            inside = strip(F.regexp_extract(cell["text"], pattern, 1))
            after = F.filter(F.slice("cells", i + 2, F.size("cells")), lambda x: x["text"] != "")
            unit = F.when(inside != "", inside).otherwise(F.coalesce(F.try_element_at(after, F.lit(1))["text"], F.lit("")))
            return F.struct(F.lit(order).alias("o"), F.col("row_no").alias("r"), cell["col_no"].alias("c"), F.when(cell["text"].rlike(pattern), unit).otherwise("").alias("unit"))

        return F.transform("cells", one)

    sure = F.filter(of(UNIT_SURE, 0), lambda x: x["unit"] != "")
    bare = F.filter(of(UNIT_BARE, 1), lambda x: looks_like_unit(x["unit"]))
    return F.array_min(F.concat(sure, bare))


def sheet_meta(lines: DataFrame) -> DataFrame:
    """(path, sheet, hdr_row, data_row, src_unit, form, decision, series) of the sheets that have a header, in one aggregate over their lines.

    series has the header path of each column. What is kept of a sheet on the way is its first lines.
    """
    c, last = F.col, SCAN_HEADER + SCAN_DATA
    low = lambda x: F.lower(x["text"])
    filled = F.size(F.filter("cells", lambda x: x["text"] != ""))
    head = (c("row_no") < SCAN_HEADER) & (filled >= 3) & _any(lambda x: (x["col_no"] < 3) & low(x).rlike(INDEX_CELL) | (x["col_no"] < 4) & low(x).rlike(LABEL_CELL))
    data = (c("row_no") <= last) & _any(lambda x: (x["col_no"] == 1) & (x["text"] != "")) & _any(lambda x: (x["col_no"] >= 2) & norm_num(x["text"]).isNotNull())
    top, line = c("row_no") < SCAN_META, F.array_join(F.transform("cells", lambda x: x["text"]), " ")
    match = lambda pattern: F.when(top, F.nullif(F.regexp_extract(line, pattern, 1), F.lit("")))
    seen = lines.select(
        *SHEET, "row_no", F.when(head, c("row_no")).alias("head"), F.when(data, c("row_no")).alias("data"), match(FORM_NO).alias("form"), match(DECISION).alias("decision"),
        F.when(top & line.rlike(UNIT_BARE.replace(r"\s*[:：]\s*(.*)", "")), _units()).alias("unit"), F.array_max(F.transform("cells", lambda x: x["col_no"])).alias("wide"),
        F.when(c("row_no") < last, F.struct("row_no", "cells")).alias("line"),
    )
    first = lambda n: F.coalesce(F.min_by(n, F.when(c(n).isNotNull(), c("row_no"))), F.lit(""))
    by = seen.groupBy(*SHEET).agg(F.min("head").alias("hdr_row"), F.collect_list("data").alias("datas"), first("form").alias("form"), first("decision").alias("decision"), F.min("unit").alias("unit"), F.max("wide").alias("wide"), F.collect_list("line").alias("lines"))
    near = F.filter("datas", lambda r: (r > c("hdr_row")) & (r <= c("hdr_row") + SCAN_DATA))
    by = by.filter("hdr_row is not null").withColumn("data_row", F.coalesce(F.array_min(near), c("hdr_row") + 1))
    heads = F.array_sort(F.filter("lines", lambda x: (x["row_no"] >= c("hdr_row")) & (x["row_no"] < c("data_row"))))

    def path(col: Column) -> Column:
        # A merged cell's text stands in its first column: the nearest text to the left counts.
        text = lambda row: F.try_element_at(F.filter(row["cells"], lambda x: (x["col_no"] <= col) & (x["text"] != "")), F.lit(-1))["text"]
        joined = F.array_join(F.array_distinct(F.array_compact(F.transform("heads", text))), " / ")
        return F.when(joined != "", joined).otherwise(F.concat(F.lit("col"), col))

    by = by.withColumn("heads", heads)
    return by.select(*SHEET, "hdr_row", "data_row", F.coalesce(c("unit.unit"), F.lit("")).alias("src_unit"), "form", "decision", F.transform(F.sequence(F.lit(0), c("wide")), path).alias("series"))


def melted_sheets(cells: DataFrame) -> DataFrame:
    """(path, sheet, row_no, col_no, indicator_raw, series, raw, src_unit, form, decision) of all cells that hold something under a header: what the operators above find, from one grouping of the cells into lines."""
    lines = sheet_lines(cells)
    at = lambda n: F.coalesce(F.try_element_at(F.filter("cells", lambda x: x["col_no"] == n), F.lit(1))["text"], F.lit(""))
    rows = lines.join(sheet_meta(lines), SHEET).filter(F.col("row_no") >= F.col("data_row")).withColumn("mark", at(0)).withColumn("label", at(1))
    rows = rows.filter((F.col("label") != "") & ~F.lower("label").isin(*HEADER_WORDS) & ~F.col("label").rlike(RULER))
    label = F.trim(F.concat_ws(" ", F.nullif(F.col("mark"), F.lit("")), F.col("label")))
    full = rows.select(*SHEET, "row_no", label.alias("indicator_raw"), "series", "src_unit", "form", "decision", F.explode(F.filter("cells", lambda x: (x["col_no"] >= 2) & (x["text"] != ""))).alias("x"))
    return full.select(*SHEET, "row_no", "x.col_no", "indicator_raw", F.col("series")[F.col("x.col_no")].alias("series"), F.col("x.text").alias("raw"), "src_unit", "form", "decision")


def form_melt(tags: DataFrame) -> DataFrame:
    """(path, row_no, tag_ord, indicator_raw, series, raw): header columns but the first two become series; blank cells stay as blank rows."""
    head = tags.filter((F.col("section") == "header") & ~F.col("tag").isin("f1", "f2")).select("path", "tag", "tag_ord", F.col("text").alias("series"))
    body = tags.filter(F.col("section") == "row")
    part = lambda t: F.max(F.when(F.col("tag") == t, strip(F.coalesce("text", F.lit("")))))
    named = body.groupBy("path", "row_no").agg(part("f1").alias("f1"), part("f2").alias("f2")).filter("f2 <> ''")
    label = F.trim(F.concat_ws(" ", F.nullif(F.col("f1"), F.lit("")), "f2"))
    wanted = named.select("path", "row_no", label.alias("indicator_raw")).join(head, "path")
    own = body.select("path", "row_no", "tag", F.col("text").alias("raw"))
    return wanted.join(own, ["path", "row_no", "tag"], "left").select("path", "row_no", "tag_ord", "indicator_raw", "series", strip(F.coalesce("raw", F.lit(""))).alias("raw"))


def prefer_source(rows: DataFrame) -> DataFrame:
    """Rows of XML files; those of spreadsheets only for reports without any from XML."""
    xml = rows.filter("method = 'XML'").select("report_id").distinct()
    return rows.filter("method = 'XML'").unionByName(rows.filter("method <> 'XML'").join(xml, "report_id", "left_anti"))


def report_status(reports: DataFrame, parsed: DataFrame) -> DataFrame:
    """(report_id, province, year, rows, method, reason, exts): every report of the catalog once. parsed: (report_id, xml_rows, sheet_rows, error)."""
    exts = F.array_join(F.array_sort(F.array_distinct(F.transform("files", lambda f: F.lower(F.regexp_extract(f, r"(\.[^.]+)$", 1))))), " ")
    both = reports.withColumn("exts", exts).join(parsed, "report_id", "left")
    x, s = F.coalesce("xml_rows", F.lit(0)), F.coalesce("sheet_rows", F.lit(0))
    readable = F.col("exts").rlike(r"\.(xml|xls|xlsx)\b")
    method = F.when(x > 0, "XML").when(s > 0, "XLSX").when(F.size("files") == 0, "PENDING_NO_FILE").when(~readable, "PENDING_PDF_DOC").otherwise("PARSE_FAILED")
    reason = F.when(method != "PARSE_FAILED", "").when(F.col("error").isNotNull(), F.col("error")).when(F.col("xml_rows").isNull(), "not downloaded").otherwise("parsed without rows")
    return both.select("report_id", "province", "year", F.when(x > 0, x).otherwise(s).cast("long").alias("rows"), method.alias("method"), reason.alias("reason"), "exts", "title")
