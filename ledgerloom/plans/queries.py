"""Registered queries of the disclosure operators over the derived forms, each with SQL that DuckDB runs beside it."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import text as X
from ledgerloom.functions import units as U
from ledgerloom.operators import cells as C
from ledgerloom.operators import dedup as D
from ledgerloom.operators import forms as P
from ledgerloom.operators import hierarchy as H
from ledgerloom.operators import marts as M
from ledgerloom.operators import names as N
from ledgerloom.operators import partials as A
from ledgerloom.operators import quality as Q
from ledgerloom.operators import reads as R
from ledgerloom.operators import search as S
from ledgerloom.operators import star as T
from ledgerloom.plans.bindings import BLOCK, FORM, FORMS_SQL, LARGE_SQL, LINES_SQL, PLANTED_SQL, REPORTS_SQL, UNITS, forms, label_index, landed, lines, planted, reports
from ledgerloom.operators import longrows as L
from ledgerloom.plans.common import checkpointed, shared_folder, table
from ledgerloom.sources import catalog as K
from ledgerloom.sources import versions, warehouse

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def keep(f):
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLES[name or f.__name__] = sql
        return f

    return keep


def v_sql(rest: str, more: str = "") -> str:
    return f"WITH {FORMS_SQL}{',' + more if more else ''} {rest}"


def sheets(spark: SparkSession, sf_dir: str, alike: bool = False) -> DataFrame:
    """Cells of one workbook sheet for each form: banner, unit, header rows with a merged cell, ruler, data.

    Of three shapes, by nation, unless all are to be alike: the plain one, one that begins with a decision's number and an
    empty row, and one with a single header row.
    """
    v = forms(spark, sf_dir)
    path = F.concat("province", F.lit("-"), "year")
    shape = F.lit(0) if alike else (F.col("nk") % 3).cast("int")
    down = F.when(shape == 1, 2).otherwise(0)
    n = (F.floor(F.col("id") / 2) % 1000).cast("int")
    data = v.select(path.alias("path"), (n + 4 + down).alias("row_no"), "series", "indicator_raw", "raw").groupBy("path", "row_no").agg(
        F.first("indicator_raw").alias("l"), F.max(F.when(F.col("series") == "PLAN", F.col("raw"))).alias("p"), F.max(F.when(F.col("series") == "OUTTURN", F.col("raw"))).alias("o")
    )
    cell = lambda c, t: F.struct(F.lit(c).alias("col_no"), t.alias("text"))
    body = data.select("path", "row_no", F.explode(F.array(cell(0, F.substring_index("l", " ", 1)), cell(1, F.expr("substr(l, instr(l, ' ') + 1)")), cell(2, F.col("p")), cell(3, F.lit("")), cell(4, F.col("o")))).alias("c"))
    text = {(0, 0): F.concat(F.lit("Biểu số 46/CK-"), "path"), (1, 3): F.concat(F.lit("Đơn vị tính: "), "unit"), (1, 0): F.lit("Đơn vị: UBND tỉnh")}
    top, sub = dict(enumerate(("STT", "Nội dung", "PLAN", "", "OUTTURN"))), {2: "Total", 3: "Share", 4: "Total"}
    ruler = dict(enumerate(("A", "B", "1", "2", "3")))
    shapes = {k: [((r + (2 if k == 1 and r else 0), c), t) for (r, c), t in text.items()] for k in range(3)}
    for k, rows in {0: {2: top, 3: sub, 4: ruler}, 1: {4: top, 5: sub, 6: ruler}, 2: {2: top, 3: ruler}}.items():
        shapes[k] += [((r, c), F.lit(t)) for r, cells_ in rows.items() for c, t in cells_.items()]
    shapes[1].append(((1, 0), F.concat(F.lit("Quyết định số: "), "nk", F.lit("/QĐ-UBND, khóa X"))))
    fixed = F.coalesce(*[F.when(F.col("shape") == k, F.array(*[F.struct(F.lit(r).alias("row_no"), F.lit(c).alias("col_no"), t.alias("text")) for (r, c), t in own])) for k, own in shapes.items()])
    head = v.select(path.alias("path"), "unit", "nk", shape.alias("shape")).distinct().select("path", F.explode(fixed).alias("c"))
    return head.select("path", F.lit("s1").alias("sheet"), "c.*").unionByName(body.select("path", F.lit("s1").alias("sheet"), "row_no", "c.*"))


SHEETS_SQL = """
sh0 AS (SELECT province || '-' || year AS path, CAST((id // 2) % 1000 + 4 AS INT) AS row_4, CAST((id // 2) % 1000 + 4 + CASE WHEN nk % 3 = 1 THEN 2 ELSE 0 END AS INT) AS row_no, any_value(indicator_raw) AS l,
               max(CASE WHEN series = 'PLAN' THEN raw END) AS p, max(CASE WHEN series = 'OUTTURN' THEN raw END) AS o, any_value(nk % 3) AS shape FROM v GROUP BY 1, 2, 3),
sh1 AS (SELECT DISTINCT province || '-' || year AS path, unit, nk, nk % 3 AS shape, CAST(CASE nk % 3 WHEN 1 THEN 4 ELSE 2 END AS INT) AS hdr, CAST(CASE nk % 3 WHEN 1 THEN 6 WHEN 0 THEN 4 ELSE 3 END AS INT) AS dat FROM v),
sheets AS (SELECT path, row_no, 0 AS col_no, split_part(l, ' ', 1) AS text FROM sh0 UNION ALL SELECT path, row_no, 1, substr(l, instr(l, ' ') + 1) FROM sh0
  UNION ALL SELECT path, row_no, 2, p FROM sh0 UNION ALL SELECT path, row_no, 4, o FROM sh0)"""


# 2.3 scalar functions -------------------------------------------------------------------------------

_NUM = "CASE k WHEN 0 THEN CAST(c AS VARCHAR) WHEN 1 THEN c || ',5' WHEN 2 THEN '-' || c WHEN 3 THEN '' WHEN 4 THEN '-' WHEN 5 THEN (c % 1000) || ',' || (c % 997) WHEN 6 THEN (c % 100) || '.' || (100 + c % 900) || ',' || (c % 100) WHEN 7 THEN (c % 1000) || ' ' || (c % 1000) WHEN 8 THEN (c % 100) || '.' || (c % 1000) || '.' || (c % 1000) ELSE 'abc' || c END"


def _raws(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice") * 100).cast("long").alias("c"))
    k = li.withColumn("k", F.pmod("c", F.lit(10)))
    return k.withColumn("raw", F.expr(_NUM.replace("VARCHAR", "STRING")))


@query(rf"""WITH a AS (SELECT l_orderkey, l_linenumber, CAST(round(l_extendedprice * 100) AS BIGINT) AS c FROM lineitem), b AS (SELECT *, c % 10 AS k FROM a),
r AS (SELECT l_orderkey, l_linenumber, {_NUM} AS raw FROM b), t AS (SELECT *, replace(raw, ' ', '') AS x FROM r)
SELECT l_orderkey, l_linenumber, raw, CASE WHEN regexp_full_match(raw, '-?[0-9., ]+') THEN TRY_CAST(CASE WHEN x LIKE '%,%' AND x LIKE '%.%' THEN replace(replace(x, '.', ''), ',', '.')
 WHEN regexp_full_match(x, '[^,]{{0,3}},[^,]{{0,3}}') THEN replace(x, ',', '.') WHEN x LIKE '%,%' THEN replace(x, ',', '') ELSE x END AS DOUBLE) END AS value FROM t""")
def norm_num(spark, sf_dir):
    return _raws(spark, sf_dir).select("l_orderkey", "l_linenumber", "raw", U.norm_num(F.col("raw")).alias("value"))


_SPELL = ("đồng", "Nghìn đồng", "Triệu đồng", "Tr đồng", "Tiệu đồng", "Triệu dồng", "Triệu đổng", "1.000.000 đồng", "VND", "triệu VND", "dòng", "2 dòng", "%", "% (phần trăm)", "tỷ đồng", "dự án", "Phần trăm (%)", "Công an tỉnh")
_SPELL_SQL = "[" + ", ".join(f"'{s}'" for s in _SPELL) + "]"


def _spelt(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey")
    u = F.element_at(F.array(*[F.lit(s) for s in _SPELL]), (F.col("c_custkey") % len(_SPELL) + 1).cast("int"))
    return c.withColumn("unit", F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("["), u, F.lit("]"))).when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("  "), u, F.lit(" :"))).otherwise(u))


_CLEAN_CTE = f"""WITH c AS (SELECT c_custkey, {_SPELL_SQL}[CAST(c_custkey % {len(_SPELL)} + 1 AS INT)] AS u FROM customer),
d AS (SELECT c_custkey, u, CASE c_custkey % 3 WHEN 0 THEN '[' || u || ']' WHEN 1 THEN '  ' || u || ' :' ELSE u END AS unit,
 CASE WHEN u IN ('đồng', 'VND') THEN 1 WHEN u = 'Nghìn đồng' THEN 1000 WHEN u IN ('Triệu đồng', 'Tr đồng', 'Tiệu đồng', 'Triệu dồng', 'Triệu đổng', '1.000.000 đồng') THEN 1000000 WHEN u = 'tỷ đồng' THEN 1000000000 END AS f FROM c)"""


@query(f"{_CLEAN_CTE} SELECT c_custkey, unit, u AS clean FROM d")
def clean_unit(spark, sf_dir):
    return _spelt(spark, sf_dir).select("c_custkey", "unit", U.clean_unit(F.col("unit")).alias("clean"))


@query(f"{_CLEAN_CTE} SELECT c_custkey, unit, CAST(f AS BIGINT) AS factor FROM d")
def unit_factor(spark, sf_dir):
    return _spelt(spark, sf_dir).select("c_custkey", "unit", U.unit_factor(F.col("unit")).alias("factor"))


@query(f"{_CLEAN_CTE} SELECT c_custkey, unit, CASE WHEN f IS NOT NULL THEN 'VND' WHEN u IN ('%', '% (phần trăm)', 'Phần trăm (%)') THEN '%' ELSE u END AS canon FROM d")
def canon_unit(spark, sf_dir):
    return _spelt(spark, sf_dir).select("c_custkey", "unit", U.canon_unit(F.col("unit")).alias("canon"))


@query(f"{_CLEAN_CTE} SELECT c_custkey, (f IS NOT NULL OR u LIKE '%\\%%' ESCAPE '\\' OR (length(u) <= 16 AND NOT regexp_matches(u, '[0-9]{{3}}'))) AS is_unit FROM d")
def looks_like_unit(spark, sf_dir):
    return _spelt(spark, sf_dir).select("c_custkey", U.looks_like_unit(U.clean_unit(F.col("unit"))).alias("is_unit"))


@query(v_sql("""SELECT id, CAST(CASE WHEN raw IN ('', '-') THEN NULL WHEN factor IS NOT NULL THEN CAST(raw AS DOUBLE) * factor ELSE CAST(raw AS DOUBLE) END AS DOUBLE) AS value,
 CASE WHEN factor IS NOT NULL THEN 'VND' ELSE unit END AS unit, CAST(CASE WHEN raw IN ('', '-') THEN NULL ELSE CAST(raw AS DOUBLE) * factor END AS DOUBLE) AS vnd,
 CASE WHEN factor IS NOT NULL AND unit <> 'VND' THEN 'ĐVT nguồn: ' || unit ELSE '' END AS unit_note FROM v"""))
def to_vnd(spark, sf_dir):
    return forms(spark, sf_dir).select("id", U.to_vnd(F.col("raw"), F.col("unit")).alias("x")).select("id", "x.*")


_FOLD = "lower(strip_accents(translate({0}, 'đĐÐ', 'ddd')))"


@query(f"WITH {LINES_SQL} SELECT doc_id, line, {_FOLD.format('label')} AS folded FROM lines")
def fold(spark, sf_dir):
    return lines(spark, sf_dir).select("doc_id", "line", X.fold(F.col("label")).alias("folded"))


@query("SELECT page_id, regexp_replace(regexp_replace(strip_accents(translate(url, 'đĐÐ', 'dDd')), '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug FROM pages")
def slug(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.slug(F.col("url")).alias("slug"))


@query("WITH a AS (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')) AS t FROM documents) SELECT doc_id, CASE WHEN length(t) > 80 THEN substr(t, 1, 79) || '…' ELSE t END AS flat FROM a")
def flat(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.flat(F.col("text"), 80).alias("flat"))


@query("SELECT doc_id, nfc_normalize(text) AS text FROM documents")
def nfc(spark, sf_dir):
    return X.nfc(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")


@query("SELECT event_id, strftime(ts, '%d/%m/%Y') AS day FROM events")
def ms_date(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("/Date("), F.unix_millis(F.col("ts").cast("timestamp")).cast("string"), F.lit(")/")).alias("d"))
    return e.select("event_id", X.ms_date(F.col("d")).alias("day"))


_KIND = "['Năm ', '6 tháng đầu năm ', '9 tháng ', 'Quý I ', 'Kỳ ']"


@query(f"SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, ['Năm', '6 tháng', '9 tháng', 'Quý', 'Khác'][CAST(o_orderkey % 5 + 1 AS INT)] AS kind FROM orders")
def period_parts(spark, sf_dir):
    kinds = F.array(*[F.lit(k) for k in ("Năm ", "6 tháng đầu năm ", "9 tháng ", "Quý I ", "Kỳ ")])
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.element_at(kinds, (F.col("o_orderkey") % 5 + 1).cast("int")), F.year("o_orderdate")).alias("p"))
    return o.select("o_orderkey", X.period_year(F.col("p")).alias("year"), X.period_kind(F.col("p")).alias("kind"))


_ONE = r"(?:[-*+•]+|\(?[0-9]+(?:[.][0-9]+)*[.)]?|[IVXLC]{1,5}[.)]?|[A-Za-z][.)]?)\s+"


@query(f"WITH {LINES_SQL}, s AS (SELECT doc_id, line, regexp_replace(label, '^\\s+|\\s+$', '', 'g') AS t FROM lines) SELECT doc_id, line, regexp_replace(t, '^(?:{_ONE})+', '') AS clean, CAST(len(regexp_extract_all(regexp_extract(t, '^((?:{_ONE})*)', 1), '{_ONE}')) AS INT) AS depth FROM s")
def indicator_parts(spark, sf_dir):
    return lines(spark, sf_dir).select("doc_id", "line", X.indicator_clean(F.col("label")).alias("clean"), X.indicator_depth(F.col("label")).alias("depth"))


_LEVELS = "CASE WHEN m = '' THEN NULL WHEN regexp_matches(m, '^[-*+•]') THEN 12 WHEN b LIKE '(%' THEN 4 WHEN regexp_full_match(b, '[0-9.]+') THEN 6 + d WHEN regexp_matches(b, '^[IVXLC]+\\.') THEN 2 + d WHEN regexp_matches(b, '^[A-ZĐ]\\.') THEN d WHEN regexp_full_match(b, '[IVXLC]{2,}') THEN 2 WHEN regexp_full_match(b, '[ABĐEGHKNOPQRSTUYCDLM]') THEN 0 WHEN b = 'I' THEN 2 WHEN b IN ('V', 'X') THEN 2 WHEN regexp_full_match(b, '[A-ZĐ]+') THEN 0 ELSE 10 END"
_MARKS = f"mk AS (SELECT *, regexp_extract(label, '{X.MARKER}', 1) AS m FROM lines), mb AS (SELECT *, trim(regexp_replace(m, '[.)]+$', '')) AS b FROM mk), md AS (SELECT *, length(b) - length(replace(b, '.', '')) AS d FROM mb)"


@query(f"WITH {LINES_SQL}, {_MARKS} SELECT doc_id, line, m AS marker FROM md")
def outline_marker(spark, sf_dir):
    return lines(spark, sf_dir).select("doc_id", "line", X.outline_marker(F.col("label")).alias("marker"))


@query(f"WITH {LINES_SQL}, {_MARKS} SELECT doc_id, line, CAST({_LEVELS} AS INT) AS level FROM md")
def outline_level(spark, sf_dir):
    return lines(spark, sf_dir).select("doc_id", "line", X.outline_level(F.col("label")).cast("int").alias("level"))


@query("SELECT c_custkey, c_nationkey || '/CK' AS form FROM customer")
def form_code(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    label = F.concat(F.lit("Table of "), "c_mktsegment", F.lit(" ["), "c_nationkey", F.lit("/CK]"))
    return c.select("c_custkey", X.form_code(label).alias("form"))


@query(v_sql("SELECT id, report_id, CASE WHEN id % 2 = 0 THEN 'unit ' || nk ELSE unit END AS unit_source FROM v"))
def note_provenance(spark, sf_dir):
    note = F.concat(F.lit("report "), "report_id", F.when(F.col("id") % 2 == 0, F.concat(F.lit("; ĐVT nguồn: unit "), "nk", F.lit("; x"))).otherwise(""))
    return forms(spark, sf_dir).select("id", X.note_report(note).alias("report_id"), X.note_unit(note, F.col("unit")).alias("unit_source"))


_ASK = ("settled", "Quyết toán năm 2020", "plan", "Dự toán", "the actual outturn", "an ESTIMATE", "final", "dutoan 2021")


@query("SELECT o_orderkey, [TRUE, TRUE, FALSE, FALSE, TRUE, FALSE, TRUE, FALSE][CAST(o_orderkey % 8 + 1 AS INT)] AS settled FROM orders")
def basis(spark, sf_dir):
    asked = F.element_at(F.array(*[F.lit(a) for a in _ASK]), (F.col("o_orderkey") % 8 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", X.basis(asked).alias("settled"))


@query("SELECT o_orderkey, CAST(greatest(5, least(500, coalesce(CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END, 20))) AS INT) AS held FROM orders")
def clamp(spark, sf_dir):
    asked = F.when(F.col("o_orderkey") % 7 == 0, "many").otherwise(F.col("o_custkey").cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", X.clamp(asked, 5, 500, 20).alias("held"))


@query(v_sql("SELECT id, CASE WHEN raw = '' OR nk % 2 = 1 AND raw = '-' THEN CASE WHEN id % 7 = 0 THEN '' ELSE unit END ELSE raw END AS shown FROM v"))
def blank_coalesce(spark, sf_dir):
    first = F.when((F.col("nk") % 2 == 1) & (F.col("raw") == "-"), "   ").otherwise(F.col("raw"))
    second = F.when(F.col("id") % 7 != 0, F.col("unit"))
    return forms(spark, sf_dir).select("id", X.blank_coalesce(first, second).alias("shown"))


@query(v_sql("""SELECT id, CASE WHEN vnd IS NULL THEN '' ELSE (CASE WHEN x IN ('0', '-0') AND vnd <> 0 THEN regexp_replace(CAST(CAST(vnd AS DECIMAL(28, 9)) / 1000000000 AS VARCHAR), '\\.?0+$', '') ELSE x END) || CASE WHEN vnd > 1000000000000000 THEN '!scale?' ELSE '' END END AS money
 FROM (SELECT *, regexp_replace(CAST(CAST((vnd + 500000) // 1000000 AS DECIMAL(28, 3)) / 1000 AS VARCHAR), '\\.?0+$', '') AS x FROM v)""").replace("CAST(CAST((vnd + 500000) // 1000000 AS DECIMAL(28, 3)) / 1000 AS VARCHAR)", "((vnd + 500000) // 1000000) // 1000 || '.' || lpad(CAST(((vnd + 500000) // 1000000) % 1000 AS VARCHAR), 3, '0')").replace("CAST(CAST(vnd AS DECIMAL(28, 9)) / 1000000000 AS VARCHAR)", "(vnd // 1000000000 || '.' || lpad(CAST(vnd % 1000000000 AS VARCHAR), 9, '0'))"))
def money_rows(spark, sf_dir):
    return forms(spark, sf_dir).select("id", U.money(F.col("vnd")).alias("money"))


@query(v_sql("SELECT id, CASE WHEN v IS NULL THEN '' WHEN id % 5 = 0 THEN 'not_currency' WHEN v > 1000000000000000 THEN 'implausible' ELSE '' END AS flag FROM (SELECT id, value * 1000000 AS v FROM v)"))
def confidence(spark, sf_dir):
    v = forms(spark, sf_dir).withColumn("v", F.col("value") * 1000000)
    return v.select("id", U.confidence(F.col("v"), F.when(F.col("id") % 5 == 0, "COMPARE (%)").otherwise("PLAN"), F.lit("VND")).alias("flag"))


_STAGES = ("Quyết toán", "DỰ TOÁN/TỔNG THU NSNN", "So sánh (%)", "Tổng số")


@query("""WITH s AS (SELECT DISTINCT upper(['Quyết toán', 'DỰ TOÁN/TỔNG THU NSNN', 'So sánh (%)', 'Tổng số'][CAST(o_orderkey % 4 + 1 AS INT)]) AS label FROM orders WHERE o_orderstatus = 'F'),
 t AS (SELECT * FROM (VALUES ('QUYẾT TOÁN', 'settled accounts (the outturn)'), ('DỰ TOÁN', 'the plan, not what was spent'), ('TỔNG THU NSNN', 'all state revenue collected in the province'), ('SO SÁNH', 'a percentage comparison column, not money'), ('TỔNG SỐ', 'the combined total of the tiers beside it'), ('NGÂN SÁCH HUYỆN', 'the district tier only')) AS x(term, meaning))
 SELECT DISTINCT term, meaning FROM t JOIN s ON contains(label, term)""")
def glossary(spark, sf_dir):
    shown = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.element_at(F.array(*[F.lit(x) for x in _STAGES]), (F.col("o_orderkey") % 4 + 1).cast("int")).alias("series"))
    return X.glossary(shown)


# 2.4 joins and names ---------------------------------------------------------------------------------

_ENC = """k AS (SELECT indicator_raw, row_number() OVER (ORDER BY min(id)) AS k_id FROM v GROUP BY 1), un AS (SELECT unit, any_value(factor) AS factor, row_number() OVER (ORDER BY min(id)) AS u_id FROM v GROUP BY 1)"""


@query(v_sql("SELECT id, province, indicator_raw, unit, value, value * factor AS vnd FROM v"))
def star_view(spark, sf_dir):
    v = forms(spark, sf_dir)
    dims = {c: T.dim_encode(v, c, a, "id") for c, a in (("indicator_raw", []), ("unit", ["factor"]), ("province", []))}
    fact = v.select("id", "value", "indicator_raw", "unit", "province")
    for c, d in dims.items():
        fact = fact.join(d.select(F.col("id").alias(f"{c}_id"), F.col(c)), c).drop(c)
    seen = T.star_view(fact, {f"{c}_id": (d, c) for c, d in dims.items()})
    return seen.select("id", "province", "indicator_raw", "unit", "value", (F.col("value") * F.col("factor")).alias("vnd"))


@query(v_sql("SELECT row_number() OVER (ORDER BY min(id)) AS id, indicator_raw, arg_min(series, id) AS series FROM v GROUP BY indicator_raw"))
def dim_encode(spark, sf_dir):
    return T.dim_encode(forms(spark, sf_dir), "indicator_raw", ["series"], "id")


_STATUS_SQL = """ps AS (SELECT report_id, CASE WHEN report_id % 5 = 0 THEN report_id % 7 ELSE 0 END AS xr, CASE WHEN report_id % 3 = 0 THEN report_id % 4 ELSE 0 END AS sr2, CASE WHEN report_id % 11 = 1 THEN 'bad zip' END AS err FROM reports WHERE report_id % 13 <> 0),
st AS (SELECT r.report_id, province, year, title, CAST(CASE WHEN coalesce(xr, 0) > 0 THEN xr ELSE coalesce(sr2, 0) END AS BIGINT) AS rows,
 CASE WHEN coalesce(xr, 0) > 0 THEN 'XML' WHEN coalesce(sr2, 0) > 0 THEN 'XLSX' WHEN len(files) = 0 THEN 'PENDING_NO_FILE' WHEN r.report_id % 3 <> 0 AND r.report_id % 5 <> 0 THEN 'PENDING_PDF_DOC' ELSE 'PARSE_FAILED' END AS method,
 err, xr, array_to_string(list_sort(list_transform(files, lambda f: lower(regexp_extract(f, '(\\.[^.]+)$', 1)))), ' ') AS exts FROM reports r LEFT JOIN ps USING (report_id)),
status AS (SELECT report_id, province, year, title, rows, method, CASE WHEN method <> 'PARSE_FAILED' THEN '' WHEN err IS NOT NULL THEN err WHEN xr IS NULL THEN 'not downloaded' ELSE 'parsed without rows' END AS reason, exts FROM st)"""


def _status(spark, sf_dir) -> DataFrame:
    r = reports(spark, sf_dir)
    i = F.col("report_id")
    parsed = r.filter(i % 13 != 0).select("report_id", F.when(i % 5 == 0, i % 7).otherwise(0).alias("xml_rows"), F.when(i % 3 == 0, i % 4).otherwise(0).alias("sheet_rows"), F.when(i % 11 == 1, "bad zip").alias("error"))
    return P.report_status(r, parsed)


def r_sql(rest: str) -> str:
    return f"WITH {REPORTS_SQL}, {_STATUS_SQL} {rest}"


def vr_sql(rest: str) -> str:
    return f"WITH {FORMS_SQL}, {REPORTS_SQL}, {_STATUS_SQL} {rest}"


@query(r_sql("SELECT * FROM status"))
def report_status(spark, sf_dir):
    return _status(spark, sf_dir)


@query(vr_sql("SELECT n_name AS province, coalesce(c.row_count, 0) AS row_count, coalesce(s.reports, 0) AS reports, coalesce(s.empty, 0) AS empty_reports, c.first_year, c.last_year FROM nation LEFT JOIN (SELECT province, count(*) AS row_count, min(year) AS first_year, max(year) AS last_year FROM v GROUP BY 1) c ON n_name = c.province LEFT JOIN (SELECT province, count(*) AS reports, count(*) FILTER (WHERE rows = 0) AS empty FROM status GROUP BY 1) s ON n_name = s.province"))
def list_publishers(spark, sf_dir):
    publishers = table(spark, sf_dir, "nation").select(F.col("n_name").alias("province"))
    return K.list_publishers(publishers, forms(spark, sf_dir), _status(spark, sf_dir))


_ASKED = "CASE c_custkey % 5 WHEN 0 THEN n_name WHEN 1 THEN lower(n_name) WHEN 2 THEN 'uk' WHEN 3 THEN substr(n_name, 1, 4) || 'x' ELSE n_name || 'E' END"


def _asked(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return c.select("c_custkey", F.expr(_ASKED).alias("asked"))


@query(f"SELECT c_custkey, asked, CASE WHEN asked = 'uk' THEN 'UNITED KINGDOM' ELSE r.n_name END AS resolved FROM (SELECT c_custkey, {_ASKED} AS asked FROM customer JOIN nation ON c_nationkey = n_nationkey) LEFT JOIN nation r ON lower(asked) = lower(r.n_name)")
def resolve_name(spark, sf_dir):
    return N.resolve_name(_asked(spark, sf_dir), "asked", table(spark, sf_dir, "nation"), "n_name", {"uk": "UNITED KINGDOM"})


@query(f"SELECT asked, count(*) AS row_count, (SELECT string_agg(n_name, '; ' ORDER BY n_name) FROM nation) AS valid FROM (SELECT {_ASKED} AS asked FROM customer JOIN nation ON c_nationkey = n_nationkey) WHERE asked <> 'uk' AND lower(asked) NOT IN (SELECT lower(n_name) FROM nation) GROUP BY 1")
def rejected_names(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    return N.rejected_names(N.resolve_name(_asked(spark, sf_dir), "asked", nation, "n_name", {"uk": "UNITED KINGDOM"}), "asked", nation, "n_name")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN regexp_replace(n_name, '[^A-Za-z0-9]+', '_', 'g') WHEN c_custkey % 3 = 1 THEN 'UK' ELSE n_name || '_x' END AS folder, CASE c_custkey % 3 WHEN 0 THEN n_name WHEN 1 THEN 'UNITED KINGDOM' END AS resolved FROM customer JOIN nation ON c_nationkey = n_nationkey")
def slug_lookup(spark, sf_dir):
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    folder = F.when(F.col("c_custkey") % 3 == 0, F.regexp_replace("n_name", "[^A-Za-z0-9]+", "_")).when(F.col("c_custkey") % 3 == 1, "UK").otherwise(F.concat("n_name", F.lit("_x")))
    return N.resolve_slug(c.select("c_custkey", folder.alias("folder")), "folder", table(spark, sf_dir, "nation"), "n_name", {"UK": "UNITED KINGDOM"})


_SIM = "CAST(floor((1 - levenshtein(lower(asked), lower(n_name)) / greatest(length(asked), length(n_name))) * 10000 + 0.5) AS BIGINT)"


@query(f"WITH a AS (SELECT DISTINCT asked FROM (SELECT {_ASKED} AS asked FROM customer JOIN nation ON c_nationkey = n_nationkey) WHERE lower(asked) NOT IN (SELECT lower(n_name) FROM nation)), b AS (SELECT asked, n_name, {_SIM} AS s FROM a, nation WHERE 1 - levenshtein(lower(asked), lower(n_name)) / greatest(length(asked), length(n_name)) >= 0.6) SELECT asked, CAST(k AS INT) AS rank, n_name AS suggestion FROM (SELECT *, row_number() OVER (PARTITION BY asked ORDER BY s DESC, n_name) AS k FROM b) WHERE k <= 5")
def suggest_name(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    rejects = N.resolve_name(_asked(spark, sf_dir), "asked", nation, "n_name").filter("resolved is null")
    return N.suggest_name(rejects, "asked", nation, "n_name")


TOTAL = "A TOTAL"


@query(v_sql(f"""SELECT province, year, plan, outturn, floor(outturn / plan * 10000 + 0.5) / 10000.0 AS ratio FROM (SELECT province, year, max(CASE WHEN series = 'PLAN' THEN vnd END) AS plan, max(CASE WHEN series = 'OUTTURN' THEN vnd END) AS outturn,
 count(CASE WHEN series = 'PLAN' THEN vnd END) AS a, count(CASE WHEN series = 'OUTTURN' THEN vnd END) AS b FROM v WHERE indicator_raw = '{TOTAL}' GROUP BY 1, 2) WHERE a = 1 AND b = 1 AND plan <> 0 AND outturn <> 0"""))
def plan_vs_outturn(spark, sf_dir):
    return C.plan_vs_outturn(forms(spark, sf_dir), FORM, TOTAL)


@query(v_sql("SELECT n_name AS province, n_name IN (SELECT province FROM v WHERE nk % 4 <> 1) AS built FROM nation"))
def build_status(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_name").alias("province"))
    return K.build_status(n, forms(spark, sf_dir).filter("nk % 4 <> 1"))


@query(v_sql(f"WITH_ SELECT 1").replace("WITH_ SELECT 1", f"SELECT (SELECT count(DISTINCT province) FROM v WHERE vnd IS NOT NULL AND indicator_raw = '{TOTAL}') AS have, (SELECT count(*) FROM nation) AS total, (SELECT coalesce(string_agg(n_name, '; ' ORDER BY n_name), '') FROM nation WHERE n_name NOT IN (SELECT province FROM v WHERE vnd IS NOT NULL AND indicator_raw = '{TOTAL}')) AS missing"))
def coverage_gap(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_name").alias("province"))
    return C.coverage_gap(C.cells(forms(spark, sf_dir), FORM, TOTAL), n)


# 2.1 sources -----------------------------------------------------------------------------------------


@query(r_sql("SELECT report_id, filename, TRUE AS parseable FROM (SELECT report_id, unnest(files) AS filename FROM reports) WHERE regexp_matches(lower(filename), '\\.(xml|xls|xlsx)$')"))
def attachment_manifest(spark, sf_dir):
    return K.attachment_manifest(reports(spark, sf_dir))


@query("SELECT sha256(coalesce(text, '')) AS sha256, CAST(strlen(coalesce(text, '')) AS BIGINT) AS bytes, count(*) AS copies, min(doc_id) AS first_name FROM documents GROUP BY 1, 2 HAVING count(*) > 1")
def content_duplicates(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("content"))
    return K.content_duplicates(K.fingerprint(d), "doc_id")


@query(r_sql("SELECT report_id, filename, TRUE AS parseable FROM (SELECT report_id, unnest(files) AS filename FROM reports) WHERE regexp_matches(lower(filename), '\\.(xml|xls|xlsx)$') AND report_id % 7 = 2"))
def missing_files(spark, sf_dir):
    m = K.attachment_manifest(reports(spark, sf_dir))
    return K.missing_files(m, m.filter("report_id % 7 <> 2"), ["report_id", "filename"])


@query(r_sql("SELECT province, count(*) AS reports, count(*) FILTER (WHERE rows > 0) AS ok, count(*) FILTER (WHERE method = 'PARSE_FAILED') AS failed, count(*) FILTER (WHERE method LIKE 'PENDING%') AS pending, CAST(sum(rows) AS BIGINT) AS row_count FROM status GROUP BY 1"))
def run_summary(spark, sf_dir):
    return K.run_summary(_status(spark, sf_dir))


# 2.2 forms -------------------------------------------------------------------------------------------


def s_sql(rest: str) -> str:
    return f"WITH {FORMS_SQL}, {SHEETS_SQL} {rest}"


@query(s_sql("SELECT path, 's1' AS sheet, hdr AS hdr_row FROM sh1"))
def banner_header(spark, sf_dir):
    return P.banner_header(sheets(spark, sf_dir), "STT")


@query(s_sql("SELECT path, 's1' AS sheet, hdr AS hdr_row FROM sh1"))
def header_row(spark, sf_dir):
    return P.header_row(sheets(spark, sf_dir))


@query(s_sql("SELECT path, 's1' AS sheet, hdr AS hdr_row, dat AS data_row FROM sh1"))
def first_data_row(spark, sf_dir):
    c = sheets(spark, sf_dir)
    return P.first_data_row(c, P.header_row(c))


@query(s_sql("SELECT path, 's1' AS sheet, r AS row_no, c AS col_no, CASE WHEN r = hdr THEN ['STT', 'Nội dung', 'PLAN', 'PLAN', 'OUTTURN'][c + 1] ELSE [NULL, NULL, 'Total', 'Share', 'Total'][c + 1] END AS text FROM sh1, (VALUES (2), (3), (4), (5)) a(r), (VALUES (0), (1), (2), (3), (4)) b(c) WHERE r >= hdr AND r < dat"))
def merged_fill(spark, sf_dir):
    c = sheets(spark, sf_dir)
    return P.merged_fill(c, P.first_data_row(c, P.header_row(c)))


@query(s_sql("SELECT path, 's1' AS sheet, c AS col_no, (CASE WHEN shape = 2 THEN ['STT', 'Nội dung', 'PLAN', 'PLAN', 'OUTTURN'] ELSE ['STT', 'Nội dung', 'PLAN / Total', 'PLAN / Share', 'OUTTURN / Total'] END)[c + 1] AS series FROM sh1, (VALUES (0), (1), (2), (3), (4)) b(c)"))
def header_path(spark, sf_dir):
    c = sheets(spark, sf_dir)
    return P.header_path(P.merged_fill(c, P.first_data_row(c, P.header_row(c))))


@query(s_sql("SELECT path, 's1' AS sheet, '46/CK-' || regexp_extract(path, '^[A-Za-z]+') AS form, CASE WHEN shape = 1 THEN nk || '/QĐ-UBND' ELSE '' END AS decision FROM sh1"))
def first_match_meta(spark, sf_dir):
    return P.first_match_meta(sheets(spark, sf_dir))


@query(s_sql("SELECT path, 's1' AS sheet, hdr AS hdr_row, dat AS data_row, unit AS src_unit, '46/CK-' || regexp_extract(path, '^[A-Za-z]+') AS form, CASE WHEN shape = 1 THEN nk || '/QĐ-UBND' ELSE '' END AS decision, CASE WHEN shape = 2 THEN 'STT|Nội dung|PLAN|PLAN|OUTTURN' ELSE 'STT|Nội dung|PLAN / Total|PLAN / Share|OUTTURN / Total' END AS series FROM sh1"))
def sheet_meta(spark, sf_dir):
    return P.sheet_meta(P.sheet_lines(sheets(spark, sf_dir))).withColumn("series", F.array_join("series", "|"))


@query(s_sql("SELECT path, 's1' AS sheet, unit AS src_unit FROM sh1"))
def find_unit(spark, sf_dir):
    return P.find_unit(sheets(spark, sf_dir))


@query(s_sql("SELECT path, 's1' AS sheet, row_no, split_part(l, ' ', 1) AS mark, substr(l, instr(l, ' ') + 1) AS label FROM sh0 WHERE NOT regexp_full_match(substr(l, instr(l, ' ') + 1), '[A-Za-z]')"))
def row_filter(spark, sf_dir):
    c = sheets(spark, sf_dir)
    return P.row_filter(c, P.first_data_row(c, P.header_row(c)))


@query(s_sql("SELECT path, 's1' AS sheet, s.row_no, s.col_no, l AS indicator_raw, CASE s.col_no WHEN 2 THEN 'PLAN' ELSE 'OUTTURN' END || CASE WHEN shape = 2 THEN '' ELSE ' / Total' END AS series, s.text AS raw FROM sheets s JOIN sh0 USING (path, row_no) WHERE s.col_no >= 2 AND s.text <> '' AND NOT regexp_full_match(substr(l, instr(l, ' ') + 1), '[A-Za-z]')"))
def sheet_melt(spark, sf_dir):
    return P.melted_sheets(sheets(spark, sf_dir)).drop("src_unit", "form", "decision")


def _tags(spark, sf_dir) -> DataFrame:
    c = sheets(spark, sf_dir, alike=True)
    tag = F.concat(F.lit("f"), F.col("col_no") + 1)
    rows = c.filter("row_no >= 5 and not (col_no = 2 and text = '-')").select("path", F.lit("row").alias("section"), "row_no", F.col("col_no").alias("tag_ord"), tag.alias("tag"), "text")
    head = c.filter("row_no = 2").select("path", F.lit("header").alias("section"), F.lit(0).alias("row_no"), F.col("col_no").alias("tag_ord"), tag.alias("tag"), F.when(F.col("col_no") == 3, "SHARE").otherwise(F.col("text")).alias("text"))
    return head.unionByName(rows)


@query(s_sql("SELECT path, row_4 AS row_no, c AS tag_ord, l AS indicator_raw, ['PLAN', 'SHARE', 'OUTTURN'][c - 1] AS series, CASE c WHEN 2 THEN CASE WHEN p = '-' THEN '' ELSE coalesce(p, '') END WHEN 3 THEN '' ELSE coalesce(o, '') END AS raw FROM sh0, (VALUES (2), (3), (4)) b(c)"))
def form_melt(spark, sf_dir):
    return P.form_melt(_tags(spark, sf_dir))


@query(v_sql("SELECT id, report_id, CASE WHEN id % 3 = 0 THEN 'XML' ELSE 'XLSX' END AS method FROM v WHERE report_id % 2 = 0 AND id % 3 = 0 OR report_id % 2 = 1 AND id % 3 <> 0"))
def prefer_source(spark, sf_dir):
    v = forms(spark, sf_dir).select("id", "report_id", F.when(F.col("id") % 3 == 0, "XML").otherwise("XLSX").alias("method")).filter("report_id % 2 = 0 or id % 3 <> 0")
    return P.prefer_source(v)


# From files to the warehouse ---------------------------------------------------------------------------


def _catalog(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(files, reports) of the workbooks, and of the XML forms that every other report has as well."""
    r = forms(spark, sf_dir).select("province", "year", "nk", "unit", "scope").distinct().withColumn("report_id", (F.col("nk") * 10 + F.col("year") % 10).cast("long"))
    path = F.concat("province", F.lit("-"), "year")
    url = F.concat(F.lit("u"), "report_id").alias("url")
    files = r.select(path.alias("path"), "report_id", url).unionByName(r.filter("report_id % 2 = 0").select(F.concat(F.lit("xml/"), path).alias("path"), "report_id", url))
    text = lambda **more: [F.lit(v).alias(k) for k, v in more.items()]
    reports = r.select(
        "report_id", "province", "year", F.col("province").alias("agency"), F.col("year").cast("string").alias("year_text"), F.col("scope").alias("report_type"), F.col("unit").alias("currency_unit"),
        F.array(F.lit("a.xlsx")).alias("files"), *text(period_type="Năm", title="Budget", report_file="B46", circular="", approved_date="", publish_date="01/02/2003"),
    )
    return files, reports


def _parsed(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(tags, cells) of those files, as readers give them."""
    none = F.lit(None).cast("string").alias("error")
    even = F.pmod(F.substring_index("path", "-", -1).cast("int") % 10, F.lit(2)) == 0  # nk * 10 + year % 10 is even
    return _tags(spark, sf_dir).filter(even).withColumn("path", F.concat(F.lit("xml/"), "path")).select("*", none), sheets(spark, sf_dir).select("*", none)


def _long(spark, sf_dir) -> DataFrame:
    tags, cells = _parsed(spark, sf_dir)
    return L.long_table(checkpointed(L.parsed_rows(tags, cells, *_catalog(spark, sf_dir))))


_LONG_SQL = """
wr AS (SELECT DISTINCT province || '-' || year AS path, province, year, nk, unit, factor, scope, nk * 10 + year % 10 AS report_id FROM v),
wm AS (SELECT path, row_no, unnest([2, 3, 4]) AS c, l, ['PLAN', 'SHARE', 'OUTTURN'] AS names, [CASE WHEN p = '-' THEN '' ELSE coalesce(p, '') END, '', coalesce(o, '')] AS raws FROM sh0),
wl AS (SELECT r.*, row_no, c, l AS indicator_raw, names[c - 1] AS series, raws[c - 1] AS raw, 'XML' AS method, 'B46' AS form_code FROM wm JOIN wr r USING (path) WHERE report_id % 2 = 0
       UNION ALL SELECT r.*, s.row_no, s.col_no, l, CASE s.col_no WHEN 2 THEN 'PLAN' ELSE 'OUTTURN' END || CASE WHEN shape = 2 THEN '' ELSE ' / Total' END, s.text, 'XLSX', '46/CK-NATION'
       FROM sheets s JOIN sh0 USING (path, row_no) JOIN wr r USING (path) WHERE report_id % 2 = 1 AND s.col_no >= 2 AND s.text <> '' AND NOT regexp_full_match(substr(l, instr(l, ' ') + 1), '[A-Za-z]')),
wn AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY report_id, indicator_raw, series, raw ORDER BY row_no, c) > 1 THEN 'exact' ELSE '' END AS dup_kind, TRY_CAST(raw AS DOUBLE) AS n FROM wl)"""


def w_sql(rest: str) -> str:
    return f"WITH {FORMS_SQL}, {SHEETS_SQL}, {_LONG_SQL} {rest}"


@query(w_sql("SELECT province AS province_current, indicator_raw, series, raw, CASE WHEN factor IS NULL THEN n ELSE n * factor END AS value, CASE WHEN factor IS NULL THEN unit ELSE 'VND' END AS unit, n * factor AS vnd, 'Năm ' || year AS period, 'Budget [' || form_code || ']' AS table_label, method, report_id, dup_kind, row_number() OVER (ORDER BY report_id, CASE method WHEN 'XML' THEN 'xml/' || path ELSE path END, row_no, c) - 1 AS ord FROM wn"))
def long_table(spark, sf_dir):
    return _long(spark, sf_dir).select("province_current", "indicator_raw", "series", "raw", "value", "unit", "vnd", "period", "table_label", "method", "report_id", "dup_kind", "ord")


_WAREHOUSES: dict[tuple[str, str], str] = {}


def _warehouse(spark, sf_dir) -> str:
    """The path of a warehouse that was loaded in two loads, by publisher; once for an application and input."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _WAREHOUSES:
        path = f"{shared_folder(spark)}/warehouse-{uuid4().hex}"
        rows = checkpointed(_long(spark, sf_dir).filter("dup_kind = ''").drop("dup_kind"))
        _, reports_ = _catalog(spark, sf_dir)
        counted = rows.groupBy("report_id").agg(F.count_if(F.col("method") == "XML").alias("xml_rows"), F.count_if(F.col("method") != "XML").alias("sheet_rows")).withColumn("error", F.lit(None).cast("string"))
        status = checkpointed(P.report_status(reports_, counted))
        for part in ("report_id < 120", "report_id >= 120"):
            warehouse.load(spark, path, rows.filter(part), status.filter(part))
        _WAREHOUSES[at] = path
    return _WAREHOUSES[at]


@query(w_sql("SELECT province, year, 'Năm' AS kind, scope, form_code, indicator_raw, series, raw, CASE WHEN factor IS NULL THEN n ELSE n * factor END AS value, n * factor AS vnd, unit AS unit_source, CASE WHEN factor IS NULL THEN unit ELSE 'VND' END AS unit, report_id FROM wn WHERE dup_kind = ''"))
def warehouse_view(spark, sf_dir):
    return warehouse.view(spark, _warehouse(spark, sf_dir)).select("province", "year", "kind", "scope", "form_code", "indicator_raw", "series", "raw", "value", "vnd", "unit_source", "unit", "report_id")


@query(w_sql("SELECT row_number() OVER (ORDER BY min(o)) AS id, indicator_raw AS label FROM (SELECT indicator_raw, row_number() OVER (ORDER BY report_id, CASE method WHEN 'XML' THEN 'xml/' || path ELSE path END, row_no, c) AS o FROM wn) GROUP BY 2"))
def warehouse_ids(spark, sf_dir):
    return versions.read(spark, _warehouse(spark, sf_dir), "indicator").select("id", "label")


@query(w_sql("SELECT province, count(*) AS row_count, count(n * factor) AS convertible FROM wn WHERE dup_kind = '' GROUP BY 1"))
def warehouse_volume(spark, sf_dir):
    return M.volume(warehouse.view(spark, _warehouse(spark, sf_dir)))


@query(w_sql("SELECT indicator_raw AS label, form_code AS form, count(*) AS row_count, count(DISTINCT province) AS provinces, count(n * factor) AS convertible, min(year) AS first_year, max(year) AS last_year FROM wn WHERE dup_kind = '' GROUP BY 1, 2"))
def warehouse_labels(spark, sf_dir):
    star = versions.read_all(spark, _warehouse(spark, sf_dir), (*warehouse.DIMENSIONS, "fact_row"))
    return S.star_stats(star.pop("fact_row"), star)


# 2.5 dedup and maintenance ---------------------------------------------------------------------------

_ALL = ["id", "province", "year", "series", "indicator_raw", "raw", "unit", "source_url"]
_KEY = ["id", "province", "year", "series", "indicator_raw", "raw"]


@query(v_sql("SELECT ord, id, source_url FROM landed WHERE ord % 4 <> 1"))
def dedup_exact(spark, sf_dir):
    return D.dedup_exact(landed(spark, sf_dir), _ALL).select("ord", "id", "source_url")


@query(v_sql("SELECT ord, id, source_url FROM landed WHERE ord % 4 = 0"))
def dedup_logical(spark, sf_dir):
    return D.dedup_logical(landed(spark, sf_dir), _ALL, _KEY).select("ord", "id", "source_url")


@query(v_sql("SELECT count(*) AS raw_rows, count(*) FILTER (WHERE ord % 4 = 1) AS exact_dup, count(*) FILTER (WHERE ord % 4 = 2) AS logical_dup, count(*) FILTER (WHERE ord % 4 = 0) AS final_rows FROM landed"))
def dedup_stats(spark, sf_dir):
    return D.dedup_stats(landed(spark, sf_dir), _ALL, _KEY)


@query(vr_sql("""SELECT province, label, CAST(value AS BIGINT) AS value FROM (SELECT s.province, count(DISTINCT s.report_id) AS reports, count(DISTINCT s.report_id) FILTER (WHERE s.rows > 0) AS extracted, count(DISTINCT s.report_id) FILTER (WHERE s.method = 'XML') AS xml, count(DISTINCT s.report_id) FILTER (WHERE s.method = 'XLSX') AS xlsx,
 count(DISTINCT s.report_id) FILTER (WHERE s.method = 'PENDING_PDF_DOC') AS pending_pdf, count(DISTINCT s.report_id) FILTER (WHERE s.method = 'PENDING_NO_FILE') AS no_file, count(DISTINCT s.report_id) FILTER (WHERE s.method = 'PARSE_FAILED') AS failed,
 coalesce(any_value(raw_rows), 0) AS raw_rows, coalesce(any_value(exact_dup), 0) AS exact_dup, coalesce(any_value(logical_dup), 0) AS logical_dup, coalesce(any_value(final_rows), 0) AS final_rows, coalesce(any_value(numeric_rows), 0) AS numeric_rows, coalesce(any_value(blank_rows), 0) AS blank_rows, coalesce(any_value(vnd_rows), 0) AS vnd_rows
 FROM (SELECT province, count(*) AS raw_rows, count(*) FILTER (WHERE ord % 4 = 1) AS exact_dup, count(*) FILTER (WHERE ord % 4 = 2) AS logical_dup, count(*) FILTER (WHERE ord % 4 = 0) AS final_rows, count(value) FILTER (WHERE ord % 4 = 0) AS numeric_rows,
 count(*) FILTER (WHERE ord % 4 = 0 AND value IS NULL) AS blank_rows, count(vnd) FILTER (WHERE ord % 4 = 0) AS vnd_rows FROM landed WHERE nk % 9 <> 4 GROUP BY 1) p RIGHT JOIN status s ON s.province = p.province GROUP BY 1)
 UNPIVOT (value FOR label IN (reports, extracted, xml, xlsx, pending_pdf, no_file, failed, raw_rows, exact_dup, logical_dup, final_rows, numeric_rows, blank_rows, vnd_rows))"""))
def summary_qa(spark, sf_dir):
    # Publishers whose rows are all missing are the ones to be seen here.
    kinds = D.mark_duplicates(landed(spark, sf_dir).filter("nk % 9 <> 4"), _ALL, _KEY)
    return Q.summary_qa(kinds, _status(spark, sf_dir))


@query(r_sql("SELECT report_id, province, year, title, exts, method, substr(reason, 1, 180) AS reason FROM status WHERE method LIKE 'PENDING%' OR method = 'PARSE_FAILED'"))
def pending_review(spark, sf_dir):
    return Q.pending_review(_status(spark, sf_dir))


@query(v_sql("SELECT unit, any_value(factor) AS factor, unit AS canon, count(*) AS row_count, FALSE AS warn FROM v WHERE factor IS NULL AND unit <> '%' GROUP BY unit"))
def unconverted_units(spark, sf_dir):
    return Q.unconverted(Q.unit_audit(forms(spark, sf_dir)))


@query(v_sql("SELECT unit, f AS factor, count(*) AS row_count, count(value) AS value_count, any_value(factor) AS new_factor, coalesce(f > 1 AND (any_value(factor) IS NULL OR f <> any_value(factor)), FALSE) AS refused FROM (SELECT *, CASE WHEN id % 3 = 0 THEN NULL WHEN nk % 5 = 2 THEN 1000 ELSE factor END AS f FROM v) GROUP BY 1, 2"))
def migration_plan(spark, sf_dir):
    stated = F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("nk") % 5 == 2, F.lit(1000)).otherwise(F.col("factor")).cast("long")
    return Q.migration_plan(forms(spark, sf_dir).withColumn("factor", stated))


@query(v_sql("SELECT unit, any_value(factor) AS factor, CASE WHEN any_value(factor) IS NOT NULL THEN 'VND' ELSE unit END AS canon, count(*) AS row_count FROM v GROUP BY unit"))
def unit_audit(spark, sf_dir):
    return Q.unit_audit(forms(spark, sf_dir))


@query(v_sql("SELECT id, CASE WHEN factor IS NOT NULL THEN 'VND' ELSE unit END AS unit, CAST(coalesce(value * factor, value) AS DOUBLE) AS value, CAST(value * factor AS DOUBLE) AS vnd, CASE WHEN factor IS NOT NULL AND unit <> 'VND' THEN 'ĐVT nguồn: ' || unit ELSE '' END AS note FROM v WHERE report_id NOT IN (SELECT report_id FROM v WHERE id % 101 = 0 AND vnd IS NOT NULL AND vnd <> 0)"))
def restate_units(spark, sf_dir):
    v = forms(spark, sf_dir).select("id", "report_id", "unit", F.col("value").cast("double").alias("value"), F.when(F.col("id") % 101 == 0, F.col("vnd") * 2).otherwise(F.col("vnd")).cast("double").alias("vnd"), F.lit("").alias("note"))
    return Q.restate_units(v, "report_id")[0].select("id", "unit", "value", "vnd", "note")


@query(v_sql("SELECT id, CASE WHEN factor IS NOT NULL THEN value * factor ELSE value END AS value, 1 AS canon_version FROM v"))
def migrate_units(spark, sf_dir):
    v = forms(spark, sf_dir).select("id", "factor", "value")
    return Q.migrate_units(Q.migrate_units(v)).select("id", "value", "canon_version")


@query("SELECT 'orders' AS table_name, count(*) AS row_count FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'documents', count(*) FROM documents")
def count_manifest(spark, sf_dir):
    return Q.count_manifest({t: table(spark, sf_dir, t) for t in ("orders", "lineitem", "customer", "documents")})


@query("SELECT o_orderkey, o_orderstatus, 'left' AS side FROM orders WHERE o_orderkey % 50 = 0 UNION ALL SELECT o_orderkey, 'Z', 'right' FROM orders WHERE o_orderkey % 50 = 0")
def multiset_diff(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return D.multiset_diff(o, o.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 50 == 0, "Z").otherwise(F.col("o_orderstatus"))))


@query("SELECT o_orderkey, o_orderstatus, y, 'left' AS side FROM (SELECT *, CAST(year(o_orderdate) AS INT) AS y FROM orders) WHERE y = 1997 AND o_orderkey % 50 = 0 UNION ALL SELECT o_orderkey, 'Z', y, 'right' FROM (SELECT *, CAST(year(o_orderdate) AS INT) AS y FROM orders) WHERE y = 1997 AND o_orderkey % 50 = 0")
def diff_by_part(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").cast("int").alias("y"))
    return D.diff_by_part(o, o.withColumn("o_orderstatus", F.when((F.col("o_orderkey") % 50 == 0) & (F.col("y") == 1997), "Z").otherwise(F.col("o_orderstatus"))), "y")


@query("SELECT CAST(year(o_orderdate) AS INT) AS y, count(*) AS rows_left, count(*) FILTER (WHERE o_orderkey % 7 <> 0 OR year(o_orderdate) <> 1996) AS rows_right FROM orders WHERE year(o_orderdate) IN (1996, 1998) GROUP BY 1")
def changed_parts(spark, sf_dir):
    # One year lacks rows, in another two columns changed places in one row, all others are the same in another order.
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").cast("int").alias("y"))
    swap = (F.col("y") == 1998) & (F.col("o_orderkey") != F.col("o_custkey"))
    other = o.select(F.when(swap, F.col("o_custkey")).otherwise(F.col("o_orderkey")).alias("o_orderkey"), F.when(swap, F.col("o_orderkey")).otherwise(F.col("o_custkey")).alias("o_custkey"), "y", (~((F.col("y") == 1996) & (F.col("o_orderkey") % 7 == 0))).alias("kept")).filter("kept").drop("kept")
    return D.changed_parts(o, other.repartition(3), "y")


# 2.6 marts -------------------------------------------------------------------------------------------


@query(vr_sql("SELECT (SELECT count(*) FROM v) AS row_count, (SELECT count(DISTINCT province) FROM v) AS provinces, (SELECT count(vnd) FROM v) AS convertible, (SELECT count(DISTINCT year) FROM v) AS years, (SELECT count(DISTINCT indicator_raw) FROM v) AS indicators, (SELECT count(*) FROM status) AS reports, (SELECT count(*) FROM status WHERE rows = 0) AS empty_reports"))
def kpi(spark, sf_dir):
    return M.kpi(forms(spark, sf_dir), _status(spark, sf_dir))


@query(v_sql("SELECT province, year, count(*) AS row_count FROM v GROUP BY 1, 2"))
def coverage_grid(spark, sf_dir):
    return M.coverage_grid(forms(spark, sf_dir))


@query(v_sql("SELECT year, scope, count(*) AS row_count FROM v GROUP BY 1, 2"))
def timeline(spark, sf_dir):
    return M.counts(forms(spark, sf_dir).filter("year is not null"), "year", "scope")


@query(r_sql("SELECT province, method, count(*) AS row_count FROM status GROUP BY 1, 2"))
def method_mix(spark, sf_dir):
    return M.counts(_status(spark, sf_dir), "province", "method")


@query(v_sql("SELECT province, count(*) AS row_count, count(vnd) AS convertible FROM v GROUP BY 1"))
def volume(spark, sf_dir):
    return M.volume(forms(spark, sf_dir))


@query(v_sql("SELECT unit, factor, count(*) AS row_count FROM v GROUP BY 1, 2"))
def unit_profile(spark, sf_dir):
    return M.counts(forms(spark, sf_dir), "unit", "factor")


@query(r_sql("SELECT method, count(*) AS row_count FROM status WHERE rows = 0 GROUP BY 1"))
def pending_by_method(spark, sf_dir):
    return M.counts(_status(spark, sf_dir).filter("rows = 0"), "method")


@query(r_sql("SELECT exts, count(*) AS row_count FROM status GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 14"))
def top_formats(spark, sf_dir):
    return M.top(_status(spark, sf_dir), "exts", 14)


@query(v_sql("SELECT indicator_raw, count(*) AS row_count FROM v WHERE length(indicator_raw) > 6 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25"))
def top_indicators(spark, sf_dir):
    return M.top(forms(spark, sf_dir).filter("char_length(indicator_raw) > 6"), "indicator_raw", 25)


@query("SELECT ['Năm', '6 tháng', '9 tháng', 'Quý', 'Khác'][CAST(o_orderkey % 5 + 1 AS INT)] AS kind, count(*) AS row_count FROM orders GROUP BY 1")
def period_kinds(spark, sf_dir):
    return M.counts(period_parts(spark, sf_dir), "kind")


NAMED = {"total": TOTAL, "own": "I AUTOMOBILE", "inv": "II BUILDING", "borrow": "III FURNITURE"}
_PIVOT = "bp AS (SELECT province, year, " + ", ".join(f"arg_max(vnd, id) FILTER (WHERE indicator_raw = '{x}' AND vnd IS NOT NULL) AS {n}" for n, x in NAMED.items()) + f" FROM v WHERE series = 'PLAN' AND indicator_raw IN ({', '.join(repr(x) for x in NAMED.values())}) GROUP BY 1, 2), bq AS (SELECT *, CASE WHEN own <> 0 AND total <> 0 THEN floor(own / total * 10000 + 0.5) / 10000.0 END AS self, CASE WHEN inv <> 0 AND total <> 0 THEN floor(inv / total * 10000 + 0.5) / 10000.0 END AS invest FROM bp)"


def _balance(spark, sf_dir) -> DataFrame:
    return M.balance_pivot(forms(spark, sf_dir), FORM, NAMED, "PLAN", {"self": ("own", "total"), "invest": ("inv", "total")})


@query(v_sql("SELECT * FROM bq", _PIVOT))
def balance_pivot(spark, sf_dir):
    return _balance(spark, sf_dir)


_LATEST = "lc AS (SELECT * FROM bq WHERE coalesce(own, 0) <> 0 AND coalesce(total, 0) <> 0 QUALIFY row_number() OVER (PARTITION BY province ORDER BY year DESC) = 1)"


@query(v_sql("SELECT * FROM lc", f"{_PIVOT}, {_LATEST}"))
def latest_complete(spark, sf_dir):
    return M.latest_complete(_balance(spark, sf_dir), ["own", "total"])


@query(v_sql(f"SELECT province, year, max(CASE WHEN indicator_raw = '{TOTAL}' THEN vnd END) AS spending, max(CASE WHEN indicator_raw = 'III FURNITURE' THEN vnd END) AS borrowed, max(CASE WHEN indicator_raw = 'I AUTOMOBILE' THEN vnd END) AS deficit, max(CASE WHEN indicator_raw = 'V MACHINERY' THEN vnd END) AS repaid FROM uk WHERE n = 1 AND indicator_raw IN ('{TOTAL}', 'III FURNITURE', 'I AUTOMOBILE', 'V MACHINERY') GROUP BY 1, 2 HAVING max(CASE WHEN indicator_raw = '{TOTAL}' THEN vnd END) <> 0 QUALIFY row_number() OVER (PARTITION BY province ORDER BY year DESC) = 1", "uk AS (SELECT form_code, province, year, indicator_raw, count(*) AS n, min(vnd) AS vnd FROM v WHERE series = 'PLAN' AND vnd IS NOT NULL GROUP BY 1, 2, 3, 4)"))
def debt(spark, sf_dir):
    return M.borrowing(M.unambiguous_cells(forms(spark, sf_dir), FORM, "PLAN"), {"spending": TOTAL, "borrowed": "III FURNITURE", "deficit": "I AUTOMOBILE", "repaid": "V MACHINERY"})


_UC = "uk AS (SELECT form_code, province, year, indicator_raw, count(*) AS n, min(vnd) AS vnd FROM v WHERE series = 'PLAN' AND vnd IS NOT NULL GROUP BY 1, 2, 3, 4)"


@query(v_sql("SELECT form_code, province, year, indicator_raw, vnd FROM uk WHERE n = 1", _UC))
def unambiguous_cells(spark, sf_dir):
    return M.unambiguous_cells(forms(spark, sf_dir), FORM, "PLAN")


@query(v_sql("SELECT form_code, count(*) FILTER (WHERE n > 1) AS dropped, count(*) FILTER (WHERE n = 1) AS kept FROM uk GROUP BY 1", _UC))
def dropped_cells(spark, sf_dir):
    return M.dropped_cells(forms(spark, sf_dir), FORM, "PLAN")


_REVENUE = {"cars": "I AUTOMOBILE", "building": "II BUILDING", "furniture": "III FURNITURE", "household": "IV HOUSEHOLD", "machinery": "V MACHINERY"}
_SECTORS = {"building": "II BUILDING", "furniture": "III FURNITURE", "urgent": "1 URGENT", "high": "2 HIGH"}


def _mix_sql(parts: dict[str, str], least: int) -> str:
    at = ", ".join(f"max(CASE WHEN indicator_raw = '{x}' AND vnd <> 0 THEN vnd END) AS {n}" for n, x in {"total": TOTAL, **parts}.items())
    named, count = " + ".join(f"coalesce({n}, 0)" for n in parts), " + ".join(f"CAST({n} IS NOT NULL AS BIGINT)" for n in parts)
    return v_sql(f"SELECT *, greatest(total - named, 0) AS other FROM (SELECT *, {named} AS named, {count} AS n_parts FROM (SELECT province, year, {at} FROM uk WHERE n = 1 GROUP BY 1, 2) WHERE total <> 0 QUALIFY row_number() OVER (PARTITION BY province ORDER BY year DESC) = 1) WHERE n_parts >= {least} AND named <= total * 1.02", _UC)


@query(_mix_sql(_REVENUE, 3))
def revenue_mix(spark, sf_dir):
    return M.mix(M.unambiguous_cells(forms(spark, sf_dir), FORM, "PLAN"), TOTAL, _REVENUE, 3)


@query(_mix_sql(_SECTORS, 2))
def sector_mix(spark, sf_dir):
    return M.mix(M.unambiguous_cells(forms(spark, sf_dir), FORM, "PLAN"), TOTAL, _SECTORS, 2)


@query(v_sql(f"SELECT year, n, l[1 * n // 4 + 1] AS q1, l[2 * n // 4 + 1] AS median, l[3 * n // 4 + 1] AS q3 FROM (SELECT year, count(*) AS n, list_sort(list(vnd)) AS l FROM uk WHERE n = 1 AND indicator_raw = '{TOTAL}' AND vnd <> 0 GROUP BY 1) WHERE n >= 8", _UC))
def trend_quartiles(spark, sf_dir):
    return M.trend_quartiles(M.unambiguous_cells(forms(spark, sf_dir), FORM, "PLAN"), TOTAL)


@query(v_sql("SELECT floor(corr(self, invest) * 1000000 + 0.5) / 1000000.0 AS corr FROM bq", _PIVOT))
def self_vs_invest_corr(spark, sf_dir):
    return M.correlation(_balance(spark, sf_dir), "self", "invest")


@query(v_sql("SELECT min(self) AS least, max(self) AS most, median(self) AS mid, count(*) FILTER (WHERE invest > self) AS investing, count(*) AS n FROM bq WHERE self IS NOT NULL", _PIVOT))
def share_stats(spark, sf_dir):
    return M.share_stats(_balance(spark, sf_dir), "self", "invest")


@query(v_sql(f"SELECT count(*) AS n, count(*) FILTER (WHERE ratio > 1) AS over_plan, floor(count(*) FILTER (WHERE ratio > 1) / count(*) * 10000 + 0.5) / 10000.0 AS share FROM (SELECT province, year, floor(max(vnd) FILTER (WHERE series = 'OUTTURN') / max(vnd) FILTER (WHERE series = 'PLAN') * 10000 + 0.5) / 10000.0 AS ratio FROM v WHERE indicator_raw = '{TOTAL}' AND vnd IS NOT NULL AND vnd <> 0 GROUP BY 1, 2 HAVING count(DISTINCT series) = 2)"))
def beaten(spark, sf_dir):
    return M.beaten(C.plan_vs_outturn(forms(spark, sf_dir), FORM, TOTAL))


@query(v_sql(f"SELECT province, year, plan, outturn, ratio, count(*) FILTER (WHERE outturn > plan) OVER () AS over_plan FROM (SELECT province, year, max(vnd) FILTER (WHERE series = 'PLAN') AS plan, max(vnd) FILTER (WHERE series = 'OUTTURN') AS outturn, floor(max(vnd) FILTER (WHERE series = 'OUTTURN') / max(vnd) FILTER (WHERE series = 'PLAN') * 10000 + 0.5) / 10000.0 AS ratio FROM v WHERE indicator_raw = '{TOTAL}' AND vnd IS NOT NULL AND vnd <> 0 AND year = 1998 GROUP BY 1, 2 HAVING count(DISTINCT series) = 2)"))
def over_plan(spark, sf_dir):
    return R.over_plan(C.plan_vs_outturn(forms(spark, sf_dir), FORM, TOTAL, year=1998))


@query(v_sql("SELECT arg_max(province, (total, province)) AS largest_of, max(total) AS largest, arg_min(province, (total, province)) AS smallest_of, min(total) AS smallest, floor(max(total) / min(total) * 10000 + 0.5) / 10000.0 AS times FROM lc WHERE total > 0", f"{_PIVOT}, {_LATEST}"))
def largest_smallest(spark, sf_dir):
    return M.spread(M.latest_complete(_balance(spark, sf_dir), ["own", "total"]), "total")


@query(v_sql("SELECT count(*) AS n, count(*) FILTER (WHERE own > inv) AS larger, list_sort(list(CAST(floor(own / total * 10000 + 0.5) AS BIGINT)))[count(*) // 2 + 1] AS median_own, list_sort(list(CAST(floor(inv / total * 10000 + 0.5) AS BIGINT)))[count(*) // 2 + 1] AS median_inv FROM bq WHERE total > 0 AND own IS NOT NULL AND inv IS NOT NULL", _PIVOT))
def compared_shares(spark, sf_dir):
    return M.compared_shares(_balance(spark, sf_dir), "total", "own", "inv")


@query(v_sql("SELECT count(*) AS n, count(*) FILTER (WHERE borrowed > repaid) AS larger, list_sort(list(CAST(floor(borrowed / spending * 10000 + 0.5) AS BIGINT)))[count(*) // 2 + 1] AS median_borrowed, list_sort(list(CAST(floor(repaid / spending * 10000 + 0.5) AS BIGINT)))[count(*) // 2 + 1] AS median_repaid FROM (SELECT province, year, max(CASE WHEN indicator_raw = 'A TOTAL' THEN vnd END) AS spending, max(CASE WHEN indicator_raw = 'III FURNITURE' THEN vnd END) AS borrowed, max(CASE WHEN indicator_raw = 'V MACHINERY' THEN vnd END) AS repaid FROM uk WHERE n = 1 GROUP BY 1, 2 HAVING max(CASE WHEN indicator_raw = 'A TOTAL' THEN vnd END) <> 0 QUALIFY row_number() OVER (PARTITION BY province ORDER BY year DESC) = 1) WHERE spending > 0 AND borrowed IS NOT NULL AND repaid IS NOT NULL", _UC))
def borrowing_shares(spark, sf_dir):
    return M.compared_shares(debt(spark, sf_dir), "spending", "borrowed", "repaid")


# The same marts where every customer publishes forms: rows grow with the input, and so do publishers.
_LARGE = {
    "kpi": ("SELECT (SELECT count(*) FROM v) AS row_count, (SELECT count(DISTINCT province) FROM v) AS provinces, (SELECT count(vnd) FROM v) AS convertible, (SELECT count(DISTINCT year) FROM v) AS years, (SELECT count(DISTINCT indicator_raw) FROM v) AS indicators, (SELECT count(*) FROM status) AS reports, (SELECT count(*) FROM status WHERE rows = 0) AS empty_reports", lambda v, status: M.kpi(v, status)),
    "coverage_grid": ("SELECT province, year, count(*) AS row_count FROM v GROUP BY 1, 2", lambda v, _: M.coverage_grid(v)),
    "timeline": ("SELECT year, scope, count(*) AS row_count FROM v GROUP BY 1, 2", lambda v, _: M.counts(v.filter("year is not null"), "year", "scope")),
    "volume": ("SELECT province, count(*) AS row_count, count(vnd) AS convertible FROM v GROUP BY 1", lambda v, _: M.volume(v)),
    "unit_profile": ("SELECT unit, factor, count(*) AS row_count FROM v GROUP BY 1, 2", lambda v, _: M.counts(v, "unit", "factor")),
    "top_indicators": ("SELECT indicator_raw, count(*) AS row_count FROM v WHERE length(indicator_raw) > 6 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25", lambda v, _: M.top(v.filter("char_length(indicator_raw) > 6"), "indicator_raw", 25)),
    "unambiguous_cells": (f"SELECT form_code, province, year, indicator_raw, vnd FROM ({_UC.removeprefix('uk AS (')[:-1]}) WHERE n = 1", lambda v, _: M.unambiguous_cells(v, FORM, "PLAN")),
    "plan_vs_outturn": (f"""SELECT province, year, plan, outturn, floor(outturn / plan * 10000 + 0.5) / 10000.0 AS ratio FROM (SELECT province, year, max(CASE WHEN series = 'PLAN' THEN vnd END) AS plan, max(CASE WHEN series = 'OUTTURN' THEN vnd END) AS outturn,
 count(CASE WHEN series = 'PLAN' THEN vnd END) AS a, count(CASE WHEN series = 'OUTTURN' THEN vnd END) AS b FROM v WHERE indicator_raw = '{TOTAL}' GROUP BY 1, 2) WHERE a = 1 AND b = 1 AND plan <> 0 AND outturn <> 0""", lambda v, _: C.plan_vs_outturn(v, FORM, TOTAL)),
    "trend_quartiles": (f"SELECT year, n, l[1 * n // 4 + 1] AS q1, l[2 * n // 4 + 1] AS median, l[3 * n // 4 + 1] AS q3 FROM (SELECT year, count(*) AS n, list_sort(list(vnd)) AS l FROM ({_UC.removeprefix('uk AS (')[:-1]}) WHERE n = 1 AND indicator_raw = '{TOTAL}' AND vnd <> 0 GROUP BY 1) WHERE n >= 8", lambda v, _: M.trend_quartiles(M.unambiguous_cells(v, FORM, "PLAN"), TOTAL)),
    "cells": ("SELECT form_code, indicator_raw, series, province, year, count(*) AS n, min(vnd) AS lo, max(vnd) AS hi, min(id) AS first_id, arg_min(unit, id) AS unit FROM v WHERE vnd IS NOT NULL GROUP BY 1, 2, 3, 4, 5", lambda v, _: C.cells(v, FORM)),
}


def _large(name: str, sql: str, mart) -> None:
    @query(f"WITH {LARGE_SQL}, {REPORTS_SQL}, {_STATUS_SQL} {sql}", f"large_{name}")
    def run(spark, sf_dir):
        return mart(forms(spark, sf_dir, by_customer=True), _status(spark, sf_dir) if name == "kpi" else None)


for _name, (_sql, _mart) in _LARGE.items():
    _large(_name, _sql, _mart)


_PARTIALS: dict[tuple[str, str], DataFrame] = {}


def _partial(spark, sf_dir) -> DataFrame:
    """The stored partial aggregate of the warehouse."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _PARTIALS:
        star = versions.read_all(spark, _warehouse(spark, sf_dir), (*warehouse.DIMENSIONS, "fact_row"))
        _PARTIALS[at] = checkpointed(A.partial_counts(star.pop("fact_row"), star))
    return _PARTIALS[at]


def _of_partial(name: str, sql: str) -> None:
    @query(w_sql(sql), f"partial_{name}")
    def run(spark, sf_dir):
        return A.marts(_partial(spark, sf_dir))[name]


_of_partial("kpi", "SELECT count(*) AS row_count, count(n * factor) AS convertible, count(DISTINCT province) AS provinces, count(DISTINCT year) AS years, count(DISTINCT indicator_raw) AS indicators FROM wn WHERE dup_kind = ''")
_of_partial("coverage_grid", "SELECT province, year, count(*) AS row_count FROM wn WHERE dup_kind = '' GROUP BY 1, 2")
_of_partial("timeline", "SELECT year, scope, count(*) AS row_count FROM wn WHERE dup_kind = '' GROUP BY 1, 2")
_of_partial("volume", "SELECT province, count(*) AS row_count, count(n * factor) AS convertible FROM wn WHERE dup_kind = '' GROUP BY 1")
_of_partial("unit_profile", "SELECT unit, CAST(CASE WHEN factor IS NULL THEN 0 ELSE 1 END AS BIGINT) AS factor, count(*) AS row_count FROM wn WHERE dup_kind = '' GROUP BY 1, 2")
_of_partial("period_kinds", "SELECT 'Năm' AS kind, count(*) AS row_count FROM wn WHERE dup_kind = ''")
_of_partial("top_indicators", "SELECT substr(indicator_raw, instr(indicator_raw, ' ') + 1) AS indicator, count(*) AS row_count FROM wn WHERE dup_kind = '' AND length(indicator_raw) - instr(indicator_raw, ' ') > 6 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25")
_of_partial("breadth", "SELECT province, count(DISTINCT indicator_raw) AS indicators FROM wn WHERE dup_kind = '' GROUP BY 1")


# 2.7 cells and hierarchy -----------------------------------------------------------------------------

_CELLS = "cl AS (SELECT form_code, indicator_raw, series, province, year, count(*) AS n, min(vnd) AS lo, max(vnd) AS hi, min(id) AS first_id, arg_min(unit, id) AS unit FROM v WHERE vnd IS NOT NULL GROUP BY 1, 2, 3, 4, 5)"


@query(v_sql("SELECT * FROM cl", _CELLS))
def cells(spark, sf_dir):
    return C.cells(forms(spark, sf_dir), FORM)


@query(v_sql(f"SELECT series, count(DISTINCT province) AS provinces, count(*) AS row_count FROM v WHERE indicator_raw = '{TOTAL}' AND vnd IS NOT NULL GROUP BY 1"))
def series_for(spark, sf_dir):
    return C.series_for(forms(spark, sf_dir), FORM, TOTAL)


_BLOCK_SQL = "province, year, form_code, series, report_id, table_label"
# In these forms marks are known: A, romans, digits and dashes.
_LV = f"""lm AS (SELECT *, split_part(indicator_raw, ' ', 1) AS b FROM v),
ln AS (SELECT *, min(CASE WHEN b = 'II' THEN id END) OVER w AS nii, min(CASE WHEN b IN ('I', 'A') THEN id END) OVER w AS nother FROM lm WINDOW w AS (PARTITION BY {_BLOCK_SQL} ORDER BY id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
lv AS (SELECT *, CAST(CASE WHEN b = 'I' THEN CASE WHEN nii IS NOT NULL AND (nother IS NULL OR nii < nother) THEN 2 ELSE 0 END WHEN b = 'A' THEN 0 WHEN b = '-' THEN 12 WHEN regexp_full_match(b, '[0-9]+') THEN 6 ELSE 2 END AS INT) AS level FROM ln)"""


@query(v_sql("SELECT id, level FROM lv", _LV))
def block_levels(spark, sf_dir):
    return H.block_levels(forms(spark, sf_dir), BLOCK).select("id", "level")


_CH = f"""lp AS (SELECT *, coalesce(min(CASE WHEN level <= 0 THEN id END) OVER w, 1e18) AS e0, coalesce(min(CASE WHEN level <= 2 THEN id END) OVER w, 1e18) AS e2, coalesce(min(CASE WHEN level <= 6 THEN id END) OVER w, 1e18) AS e6, coalesce(min(CASE WHEN level <= 12 THEN id END) OVER w, 1e18) AS e12
 FROM lv WINDOW w AS (PARTITION BY {_BLOCK_SQL} ORDER BY id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
pr AS (SELECT p.id AS parent_id, p.vnd AS published, c.id, c.vnd, c.level, min(c.level) OVER (PARTITION BY p.id) AS least, count(*) OVER (PARTITION BY p.id) AS scanned FROM lp p JOIN lv c USING ({_BLOCK_SQL})
 WHERE c.id > p.id AND c.id < CASE p.level WHEN 0 THEN p.e0 WHEN 2 THEN p.e2 WHEN 6 THEN p.e6 ELSE p.e12 END),
ch AS (SELECT * FROM pr WHERE level = least)"""


@query(v_sql("SELECT parent_id, id, level, scanned FROM ch", f"{_LV}, {_CH}"))
def children(spark, sf_dir):
    return H.children(H.block_levels(forms(spark, sf_dir), BLOCK), BLOCK).select("parent_id", "id", "level", "scanned")


_BD = "bd AS (SELECT parent_id, any_value(published) AS published, CAST(coalesce(sum(vnd), 0) AS BIGINT) AS children_sum, count(*) AS n_children, count(*) FILTER (WHERE vnd IS NULL) AS blank_children, any_value(scanned) AS scanned FROM ch GROUP BY 1)"
_RECONCILES = "CASE WHEN published IS NULL THEN NULL WHEN published = 0 THEN children_sum = 0 ELSE abs(published - children_sum) * 200 <= abs(published) END AS reconciles"


@query(v_sql(f"SELECT *, published - children_sum AS residual, {_RECONCILES} FROM bd", f"{_LV}, {_CH}, {_BD}"))
def break_down(spark, sf_dir):
    return H.break_down(H.block_levels(forms(spark, sf_dir), BLOCK), BLOCK).drop(*BLOCK)


@query(v_sql("SELECT parent_id, id, vnd, CASE WHEN published <> 0 AND vnd <> 0 THEN floor(vnd / published * 10000 + 0.5) / 10000.0 END AS share FROM ch", f"{_LV}, {_CH}"))
def break_down_detail(spark, sf_dir):
    found = H.children(H.block_levels(forms(spark, sf_dir), BLOCK), BLOCK)
    return found.select("parent_id", "id", "vnd", C.ratio(F.col("vnd"), F.col("parent_vnd")).alias("share"))


_TOPS = "SELECT t.province, t.year, bd.published, bd.children_sum, bd.n_children FROM bd JOIN v t ON t.id = bd.parent_id WHERE t.indicator_raw = 'A TOTAL' AND t.series = '{0}' AND t.year = (SELECT max(x.year) FROM v x WHERE x.province = t.province AND x.series = t.series AND x.indicator_raw = 'A TOTAL' AND x.vnd IS NOT NULL)"


@query(v_sql(_TOPS.format("OUTTURN"), f"{_LV}, {_CH}, {_BD}"))
def revenue_breakdown(spark, sf_dir):
    found = R.revenue_breakdown(forms(spark, sf_dir), BLOCK, FORM, TOTAL, {True: "OUTTURN", False: "PLAN"})
    return found.select("province", "year", "published", "children_sum", "n_children")


@query(v_sql(f"SELECT a.*, d.cars, d.building, d.furniture FROM ({_TOPS.format('PLAN')}) a LEFT JOIN (SELECT province, year, min(CASE WHEN indicator_raw = 'I AUTOMOBILE' THEN vnd END) AS cars, min(CASE WHEN indicator_raw = 'II BUILDING' THEN vnd END) AS building, min(CASE WHEN indicator_raw = 'III FURNITURE' THEN vnd END) AS furniture FROM v WHERE series = 'PLAN' GROUP BY 1, 2) d ON d.province = a.province AND d.year = a.year", f"{_LV}, {_CH}, {_BD}"))
def sector_breakdown(spark, sf_dir):
    beside = {"cars": "I AUTOMOBILE", "building": "II BUILDING", "furniture": "III FURNITURE"}
    found = R.spending_by_sector(forms(spark, sf_dir), BLOCK, {True: (FORM, "OUTTURN"), False: (FORM, "PLAN")}, TOTAL, beside)
    return found.select("province", "year", "published", "children_sum", "n_children", *beside)


_MED = "mp AS (SELECT * FROM v WHERE series = 'PLAN' AND vnd > 0), mm AS (SELECT province, indicator_raw, list_sort(list(vnd))[count(*) // 2 + 1] AS median, count(*) AS n FROM mp GROUP BY 1, 2 HAVING count(*) >= 3)"


@query(v_sql("SELECT id, province, indicator_raw, year, vnd, median, CASE WHEN vnd * 100 < median OR vnd > median * 100 THEN 'MAGNITUDE?' ELSE '' END AS flag FROM mp JOIN mm USING (province, indicator_raw)", _MED))
def cell_medians(spark, sf_dir):
    return C.cell_medians(forms(spark, sf_dir), FORM, "PLAN")


@query(v_sql("SELECT p.id, CASE WHEN median > 0 AND (vnd * 100 < median OR vnd > median * 100) THEN 'MAGNITUDE?' ELSE '' END AS flag FROM mp p JOIN mm USING (province, indicator_raw)", _MED))
def magnitude_flag(spark, sf_dir):
    m = C.cell_medians(forms(spark, sf_dir), FORM, "PLAN")
    return m.select("id", U.magnitude_flag(F.col("vnd"), F.col("median")).alias("flag"))


# Written from the reads' definition, not from the library: figures by publisher and year, then one CASE for each flag.
_AMOUNT = "CASE WHEN series LIKE '%\\%%' ESCAPE '\\' OR unit LIKE '%\\%%' ESCAPE '\\' THEN 'not_currency' WHEN abs(lo) > 1000000000000000 THEN 'implausible' ELSE '' END"
_PC = f"{PLANTED_SQL}, pc AS (SELECT form_code, indicator_raw, series, province, year, count(*) AS n, min(vnd) AS lo, max(vnd) AS hi, arg_min(unit, id) AS unit FROM pv WHERE vnd IS NOT NULL GROUP BY 1, 2, 3, 4, 5)"


@query(v_sql(f"SELECT a.province, a.year, CASE WHEN NOT (n > 1 AND lo <> hi) THEN lo END AS vnd, lo, hi, n, CASE WHEN n > 1 AND lo <> hi THEN 'AMBIGUOUS' WHEN most > 100 * least THEN 'MAGNITUDE?' ELSE {_AMOUNT} END AS flag FROM pc a LEFT JOIN (SELECT province, min(lo) AS least, max(lo) AS most FROM pc WHERE series = 'PLAN' AND indicator_raw = '5 LOW' AND lo > 0 GROUP BY 1) b ON a.province = b.province WHERE series = 'PLAN' AND indicator_raw = '5 LOW'", _PC))
def timeseries(spark, sf_dir):
    return C.timeseries(planted(spark, sf_dir), FORM, "5 LOW", "PLAN")


_BEST_YEAR = f"(SELECT year FROM pc WHERE series = 'PLAN' AND indicator_raw = '{TOTAL}' GROUP BY 1 ORDER BY count(DISTINCT province) DESC, year DESC LIMIT 1)"


@query(v_sql(f"SELECT province, year, lo, hi, n, CASE WHEN n > 1 AND lo <> hi THEN 'AMBIGUOUS' WHEN lo <> 0 AND lo * 100 < med THEN 'MAGNITUDE?' ELSE {_AMOUNT} END AS flag FROM pc, (SELECT list_sort(list(lo))[count(*) // 2 + 1] AS med FROM pc WHERE lo > 0 AND series = 'PLAN' AND indicator_raw = '{TOTAL}' AND year = {_BEST_YEAR}) m WHERE series = 'PLAN' AND indicator_raw = '{TOTAL}' AND year = {_BEST_YEAR}", _PC))
def compare_publishers(spark, sf_dir):
    return C.compare_publishers(planted(spark, sf_dir), FORM, TOTAL, "PLAN")


@query(v_sql(f"SELECT province, year, lo, hi, n, CASE WHEN n > 1 AND lo <> hi THEN 'AMBIGUOUS' WHEN lo <> 0 AND lo * 100 < med THEN 'MAGNITUDE?' ELSE {_AMOUNT} END AS flag FROM pc, (SELECT list_sort(list(lo))[count(*) // 2 + 1] AS med FROM pc WHERE lo > 0 AND series = 'OUTTURN' AND indicator_raw = '{TOTAL}' AND year = 1998) m WHERE series = 'OUTTURN' AND indicator_raw = '{TOTAL}' AND year = 1998", _PC))
def compare_publishers_year(spark, sf_dir):
    return C.compare_publishers(planted(spark, sf_dir), FORM, TOTAL, "OUTTURN", 1998)


_SHEET = {"total": TOTAL, "own": "I AUTOMOBILE", "inv": "II BUILDING", "borrow": "III FURNITURE", "house": "IV HOUSEHOLD", "mach": "V MACHINERY"}
_BS = f"""{_PC}, bm AS (SELECT province, indicator_raw, list_sort(list(vnd))[count(*) // 2 + 1] AS med FROM pv WHERE series = 'PLAN' AND vnd > 0 GROUP BY 1, 2 HAVING count(*) >= 3),
bc AS (SELECT c.province, c.year, c.indicator_raw, lo, coalesce(lo <> 0 AND (lo * 100 < med OR lo > med * 100), FALSE) AS off FROM pc c LEFT JOIN bm ON c.province = bm.province AND c.indicator_raw = bm.indicator_raw WHERE series = 'PLAN' AND lo = hi AND c.indicator_raw IN ({', '.join(repr(x) for x in _SHEET.values())})),
bw AS (SELECT province, year, bool_or(off) AS odd, {', '.join(f"max(lo) FILTER (WHERE indicator_raw = '{x}') AS {n}, coalesce(bool_or(off) FILTER (WHERE indicator_raw = '{x}'), FALSE) AS f_{n}" for n, x in _SHEET.items())} FROM bc GROUP BY 1, 2)"""
_BP = lambda a, b: f"CASE WHEN coalesce({a}, 0) = 0 OR coalesce({b}, 0) = 0 THEN '' WHEN f_{a} OR f_{b} THEN '?' ELSE CAST(CAST(floor({a} / {b} * 10000 + 0.5) AS BIGINT) AS VARCHAR) END"
_BALANCE = f"SELECT province, year, {', '.join(_SHEET)}, {_BP('own', 'total')} AS self_bp, {_BP('inv', 'total')} AS inv_bp, CASE WHEN odd THEN 'MAGNITUDE?' ELSE '' END AS flag FROM bw"
_RATIOS = {"self_bp": ("own", "total"), "inv_bp": ("inv", "total")}


@query(v_sql(f"{_BALANCE} WHERE own IS NOT NULL AND total IS NOT NULL QUALIFY row_number() OVER (PARTITION BY province ORDER BY year DESC) = 1", _BS))
def balance_sheet(spark, sf_dir):
    return R.balance_sheet(planted(spark, sf_dir), FORM, _SHEET, "PLAN", _RATIOS, ["own", "total"])


@query(v_sql(f"{_BALANCE} WHERE province = 'NATION_3'", _BS))
def balance_sheet_history(spark, sf_dir):
    return R.balance_sheet(planted(spark, sf_dir), FORM, _SHEET, "PLAN", _RATIOS, ["own", "total"], province="NATION_3")


@query(v_sql(f"{_BALANCE} WHERE year = 1997", _BS))
def balance_sheet_year(spark, sf_dir):
    return R.balance_sheet(planted(spark, sf_dir), FORM, _SHEET, "PLAN", _RATIOS, ["own", "total"], year=1997)


@query(v_sql(f"SELECT province, year, naive, published, floor(naive / published * 10000 + 0.5) / 10000.0 AS ratio FROM (SELECT province, year, CAST(sum(vnd) AS BIGINT) AS naive, max(CASE WHEN indicator_raw = '{TOTAL}' THEN vnd END) AS published FROM v WHERE series = 'PLAN' GROUP BY 1, 2) WHERE published > 0"))
def naive_sum_ratio(spark, sf_dir):
    return C.naive_sum_ratio(forms(spark, sf_dir), FORM, "PLAN", TOTAL)


@query(v_sql("SELECT form_code, count(*) AS keys, count(*) FILTER (WHERE n > 1) AS ambiguous FROM (SELECT form_code, count(*) AS n FROM v GROUP BY form_code, indicator_raw, series, province, year) GROUP BY 1"))
def ambiguous_keys(spark, sf_dir):
    return C.ambiguous_keys(forms(spark, sf_dir), "indicator_raw")


@query(v_sql("SELECT province, year, form_code, series, count(DISTINCT report_id) AS reports FROM v GROUP BY 1, 2, 3, 4 HAVING count(DISTINCT report_id) > 1"))
def multi_report_blocks(spark, sf_dir):
    return C.multi_report_blocks(forms(spark, sf_dir))


@query(vr_sql(f"SELECT v.id, v.province, v.year, v.raw, v.value, v.unit, v.vnd, v.report_id, s.title, s.method FROM v LEFT JOIN status s USING (report_id) WHERE indicator_raw = '{TOTAL}' AND series = 'PLAN'"))
def trace_source(spark, sf_dir):
    return C.trace_source(forms(spark, sf_dir), _status(spark, sf_dir), FORM, TOTAL, "PLAN")


# 2.8 catalog and quality -----------------------------------------------------------------------------


@query(vr_sql("SELECT scope, count(*) AS row_count, count(vnd) AS convertible, count(*) FILTER (WHERE raw = '') AS blanks, min(year) AS first_year, max(year) AS last_year, (SELECT count(*) FROM status) AS reports FROM v GROUP BY 1"))
def describe_corpus(spark, sf_dir):
    return K.describe_corpus(forms(spark, sf_dir), _status(spark, sf_dir))


@query(v_sql("SELECT form_code, count(DISTINCT province) AS provinces, count(*) AS row_count, min(year) AS first_year, max(year) AS last_year, min(table_label) AS example_title FROM (SELECT * REPLACE (['B46', 'B50', 'B63', ''][CAST(nk % 4 + 1 AS INT)] AS form_code) FROM v) WHERE form_code <> '' GROUP BY 1 HAVING count(DISTINCT province) >= 3 ORDER BY 2 DESC, 3 DESC, 1 LIMIT 30"))
def list_forms(spark, sf_dir):
    code = F.element_at(F.array(*[F.lit(c) for c in ("B46", "B50", "B63", "")]), (F.col("nk") % 4 + 1).cast("int"))
    return K.list_forms(forms(spark, sf_dir).withColumn("form_code", code), 3)


@query(r_sql("SELECT province, report_id, method, substr(reason, 1, 180) AS reason FROM status WHERE rows = 0"))
def dq_pending(spark, sf_dir):
    return Q.dq_pending(_status(spark, sf_dir))


@query(v_sql("SELECT province, form_code, indicator_raw, series, min(vnd) AS least, max(vnd) AS most, count(*) AS years, string_agg(year || '=' || vnd, ', ' ORDER BY year) AS history FROM (SELECT province, form_code, indicator_raw, series, year, max(vnd) AS vnd FROM v WHERE vnd > 0 GROUP BY 1, 2, 3, 4, 5) GROUP BY 1, 2, 3, 4 HAVING count(*) >= 2 AND max(vnd) >= min(vnd) * 100"))
def dq_magnitude(spark, sf_dir):
    return Q.dq_magnitude(forms(spark, sf_dir))


@query(v_sql("SELECT unit, count(*) AS row_count FROM v WHERE factor IS NULL GROUP BY 1"))
def dq_units(spark, sf_dir):
    return Q.dq_units(forms(spark, sf_dir))


@query(v_sql("SELECT year, count(DISTINCT province) AS provinces, count(*) AS row_count FROM v GROUP BY 1"))
def dq_coverage(spark, sf_dir):
    return Q.dq_coverage(forms(spark, sf_dir))


@query(v_sql("SELECT province, count(*) FILTER (WHERE raw = '') AS blank, count(*) FILTER (WHERE raw = '-') AS dash, count(*) FILTER (WHERE raw = '0') AS zero, count(*) FILTER (WHERE raw NOT IN ('', '-', '0')) AS other FROM v GROUP BY 1"))
def blank_census(spark, sf_dir):
    return Q.blank_census(forms(spark, sf_dir), "province")


_BREACH = "CASE WHEN id % 50 < 6 THEN id % 50 END"


@query(v_sql(f"""SELECT count(*) FILTER (WHERE b = 0) + count(*) FILTER (WHERE raw = '' AND b = 4) AS blank_to_value, count(*) FILTER (WHERE b = 1) AS dash_to_zero, count(*) FILTER (WHERE b = 2) + count(*) FILTER (WHERE b = 3) + count(*) FILTER (WHERE b = 4 AND factor IS NULL) AS vnd_without_factor, count(*) FILTER (WHERE b = 3) + count(*) FILTER (WHERE b = 4 AND unit = '%') AS vnd_on_percent, count(*) FILTER (WHERE b = 4 AND factor IS NOT NULL) AS wrong_product, count(*) FILTER (WHERE b = 5) AS long_unit FROM (SELECT *, {_BREACH} AS b FROM v)"""))
def rule_sweep(spark, sf_dir):
    # Two ids in a hundred break each of the six rules.
    v, b = forms(spark, sf_dir).withColumn("b", F.expr(_BREACH)), F.col("b")
    broken = v.select(
        F.when(b == 0, "").when(b == 1, "-").otherwise(F.col("raw")).alias("raw"), F.when(b == 0, 5).when(b == 1, 0).when(b == 4, 7).otherwise(F.col("value")).alias("value"),
        F.when(b.isin(2, 3), 5).when(b == 4, F.coalesce(F.col("factor"), F.lit(1)) * 7 + 1).when(b.isin(0, 1), F.lit(None)).otherwise(F.col("vnd")).alias("vnd"),
        F.when(b == 3, "%").when(b == 2, "dự án").when(b == 5, F.repeat(F.lit("x"), F.lit(41))).otherwise(F.col("unit")).alias("unit"), F.when(b.isin(2, 3), F.lit(None)).otherwise(F.col("factor")).alias("factor"),
    )
    return Q.rule_sweep(broken)


@query(v_sql("SELECT id, province, indicator_raw, TRUE AS truncated FROM v ORDER BY id LIMIT 200"))
def capped_result(spark, sf_dir):
    return Q.capped_result(forms(spark, sf_dir).select("id", "province", "indicator_raw"), ["id"])


# 2.9 search ------------------------------------------------------------------------------------------

_IDX = f"WITH {LINES_SQL}, ix AS (SELECT text AS label, form, count(*) AS row_count, count(DISTINCT province) AS provinces FROM lines GROUP BY 1, 2), tk AS (SELECT DISTINCT label, form, unnest(string_split_regex({_FOLD.format('label')}, '[^\\p{{L}}\\p{{N}}]+')) AS token FROM ix)"
# The stored index, whose tokens are those of labels without their marks.
_STORED_IDX = f"""WITH {LINES_SQL}, ix AS (SELECT label, form, count(*) AS row_count, count(DISTINCT province) AS provinces, count(*) FILTER (WHERE line % 3 <> 1) AS convertible, min(CAST(1990 + doc_id % 30 AS INT)) AS first_year, max(CAST(1990 + doc_id % 30 AS INT)) AS last_year FROM lines GROUP BY 1, 2),
ic AS (SELECT *, coalesce(nullif(regexp_replace(regexp_replace(label, '^\\s+|\\s+$', '', 'g'), '^(?:{_ONE})+', ''), ''), label) AS clean FROM ix),
tk AS (SELECT DISTINCT label, form, unnest(string_split_regex({_FOLD.format('clean')}, '[^\\p{{L}}\\p{{N}}]+')) AS token FROM ic)"""


@query(f"{_STORED_IDX} SELECT token, count(*) AS labels FROM tk WHERE token <> '' GROUP BY 1")
def search_index(spark, sf_dir):
    return label_index(spark, sf_dir)[1].groupBy("token").agg(F.count(F.lit(1)).alias("labels"))


@query(f"{_STORED_IDX} SELECT label, clean, form, row_count, provinces, convertible, first_year, last_year FROM ic")
def search_stats(spark, sf_dir):
    return label_index(spark, sf_dir)[0].drop("id", "part")


_HIT = "(SELECT label, form FROM tk WHERE token = 'and' INTERSECT SELECT label, form FROM tk WHERE token LIKE 'the%')"


@query(f"{_IDX} SELECT label, form FROM {_HIT}")
def search_tokens(spark, sf_dir):
    _, tokens = S.search_index(lines(spark, sf_dir), "text", "form", "province")
    return S.search_tokens(tokens, "And *the")


@query(f"{_STORED_IDX} SELECT label, clean, form, row_count, provinces, convertible, first_year, last_year FROM ic JOIN {_HIT} USING (label, form) ORDER BY provinces DESC, row_count DESC, label, form LIMIT 15")
def find_indicators(spark, sf_dir):
    return S.find_stored(label_index(spark, sf_dir), "and the")


@query(f"{_STORED_IDX} SELECT label, clean, form, row_count, provinces, convertible, first_year, last_year FROM ic JOIN (SELECT label, form FROM tk WHERE token LIKE 'der%') USING (label, form) WHERE form = 'de' AND provinces >= 2 ORDER BY provinces DESC, row_count DESC, label, form LIMIT 50")
def find_indicators_in_form(spark, sf_dir):
    return S.find_stored(label_index(spark, sf_dir), "DER", form="de", min_provinces=2, limit=90)


@query(r_sql("SELECT title, 1 AS provinces, 1 AS row_count FROM (SELECT title FROM reports WHERE title LIKE '% 1997' ORDER BY title LIMIT 10)").replace("1 AS provinces, 1 AS row_count", "CAST(1 AS BIGINT) AS provinces, CAST(1 AS BIGINT) AS row_count"))
def find_forms(spark, sf_dir):
    return S.find_forms(reports(spark, sf_dir), "report 1997", "title", "province")


# 2.10 SQL surface ------------------------------------------------------------------------------------


def sql_query(name: str, spark_text: str, oracle: str, *tables: str) -> None:
    def run(spark, sf_dir):
        return spark.sql(spark_text, **{t: table(spark, sf_dir, t) for t in tables})

    QUERIES[name], ORACLES[name] = run, oracle


sql_query(
    "sql_string",
    "SELECT c_custkey, instr(c_mktsegment, 'U') AS i, char_length(c_mktsegment) AS n, lower(c_mktsegment) AS l, replace(c_mktsegment, 'A', '-') AS r, substr(c_mktsegment, 2, 3) AS s, concat_ws('|', c_mktsegment, c_custkey) AS w, ascii(c_mktsegment) AS a, hex(c_custkey) AS h, format_string('%05d', c_custkey) AS f, c_mktsegment LIKE 'B%' AS k, coalesce(nullif(c_mktsegment, 'BUILDING'), 'x') AS z FROM {customer}",
    "SELECT c_custkey, instr(c_mktsegment, 'U') AS i, length(c_mktsegment) AS n, lower(c_mktsegment) AS l, replace(c_mktsegment, 'A', '-') AS r, substr(c_mktsegment, 2, 3) AS s, concat_ws('|', c_mktsegment, c_custkey) AS w, ascii(c_mktsegment) AS a, hex(c_custkey) AS h, printf('%05d', c_custkey) AS f, c_mktsegment LIKE 'B%' AS k, coalesce(nullif(c_mktsegment, 'BUILDING'), 'x') AS z FROM customer",
    "customer",
)
sql_query(
    "sql_math",
    "SELECT o_orderkey, abs(-o_custkey) AS a, sign(o_custkey - 10) AS s, cast(ceil(o_totalprice) AS bigint) AS c, cast(floor(o_totalprice) AS bigint) AS f, floor(sqrt(o_totalprice) * 100) AS q, floor(ln(o_totalprice) * 1000) AS l, o_custkey % 7 AS m, least(o_custkey, 50) AS lo, greatest(o_custkey, 50) AS hi, cast(o_totalprice AS bigint) AS t, floor(power(o_custkey, 2)) AS p FROM {orders}",
    "SELECT o_orderkey, abs(-o_custkey) AS a, CAST(sign(o_custkey - 10) AS DOUBLE) AS s, CAST(ceil(o_totalprice) AS BIGINT) AS c, CAST(floor(o_totalprice) AS BIGINT) AS f, floor(sqrt(o_totalprice) * 100) AS q, floor(ln(o_totalprice) * 1000) AS l, o_custkey % 7 AS m, least(o_custkey, 50) AS lo, greatest(o_custkey, 50) AS hi, CAST(trunc(o_totalprice) AS BIGINT) AS t, floor(power(o_custkey, 2)) AS p FROM orders",
    "orders",
)
sql_query(
    "sql_agg",
    "SELECT n_regionkey, count(*) AS n, sum(n_nationkey) AS s, coalesce(sum(CASE WHEN n_nationkey > 99 THEN 1.0D END), 0.0D) AS total, min(n_name) AS lo, max(n_name) AS hi, listagg(n_name, ',') WITHIN GROUP (ORDER BY n_name) AS g, floor(avg(n_nationkey) * 100) AS a FROM {nation} GROUP BY n_regionkey HAVING count(*) > 1",
    "SELECT n_regionkey, count(*) AS n, CAST(sum(n_nationkey) AS BIGINT) AS s, coalesce(sum(CASE WHEN n_nationkey > 99 THEN 1.0::DOUBLE END), 0.0::DOUBLE) AS total, min(n_name) AS lo, max(n_name) AS hi, string_agg(n_name, ',' ORDER BY n_name) AS g, floor(avg(n_nationkey) * 100) AS a FROM nation GROUP BY n_regionkey HAVING count(*) > 1",
    "nation",
)
_W = "SELECT o_orderkey, row_number() OVER w AS r, rank() OVER w AS k, dense_rank() OVER w AS d, ntile(4) OVER w AS q, lag(o_orderkey) OVER w AS g, lead(o_orderkey) OVER w AS e, first_value(o_orderkey) OVER w AS f, floor(cume_dist() OVER w * 10000) AS c, floor(percent_rank() OVER w * 10000) AS p FROM {0} WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"
sql_query("sql_window", _W.format("{orders}"), _W.format("orders"), "orders")
sql_query(
    "sql_date",
    "SELECT event_id, date_format(ts, 'yyyy-MM-dd') AS d, date_format(ts, 'HH:mm') AS t, unix_timestamp(cast(ts AS timestamp)) AS u, cast(year(ts) * 100 + month(ts) AS int) AS ym, floor(unix_timestamp(cast(ts AS timestamp)) / 86400 + 2440587.5D) AS j FROM {events}",
    "SELECT event_id, strftime(ts, '%Y-%m-%d') AS d, strftime(ts, '%H:%M') AS t, CAST(floor(epoch(ts)) AS BIGINT) AS u, CAST(year(ts) * 100 + month(ts) AS INT) AS ym, CAST(floor(floor(epoch(ts)) / 86400 + 2440587.5) AS BIGINT) AS j FROM events",
    "events",
)
sql_query(
    "sql_json",
    "SELECT event_type, count(*) AS n, sum(cast(get_json_object(props, '$.k') AS bigint)) AS k, count_if(try_parse_json(props) IS NOT NULL) AS valid FROM {events} GROUP BY event_type",
    "SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k, count(*) FILTER (WHERE json_valid(props)) AS valid FROM events GROUP BY event_type",
    "events",
)
_R = "WITH RECURSIVE m(y, d) AS (SELECT 1995, 0 UNION ALL SELECT y + 1, d + 1 FROM m WHERE y < 2002) SELECT m.y AS y, m.d AS d, count(o_orderkey) AS n FROM m LEFT JOIN {0} ON year(o_orderdate) = m.y GROUP BY m.y, m.d"
sql_query("sql_recursive", _R.format("{orders}"), _R.format("orders"), "orders")
_S = "SELECT c_custkey AS k FROM {0} WHERE c_nationkey < 5 UNION SELECT o_custkey FROM {1} WHERE o_totalprice > 400000 EXCEPT SELECT s_suppkey FROM {2} INTERSECT SELECT c_custkey FROM {0} WHERE c_custkey IN (SELECT o_custkey FROM {1} LIMIT 100000000 OFFSET 0)"
sql_query("sql_setops", _S.format("{customer}", "{orders}", "{supplier}"), _S.format("customer", "orders", "supplier"), "customer", "orders", "supplier")
