"""Static cases: units, numbers, marks, hierarchies, forms, readers and ingestion."""

import json
import unicodedata
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import text as X
from ledgerloom.functions import units as U
from ledgerloom.operators import cells as C
from ledgerloom.operators import dedup as D
from ledgerloom.operators import forms as P
from ledgerloom.operators import hierarchy as H
from ledgerloom.operators import longrows as L
from ledgerloom.operators import marts as M
from ledgerloom.operators import names as N
from ledgerloom.operators import quality as Q
from ledgerloom.operators import reads as B
from ledgerloom.operators import search as S
from ledgerloom.sources import catalog as K
from ledgerloom.sources import files as R
from ledgerloom.sources import sinks
from ledgerloom.streaming.ingest import ingest_incremental, new_files


def each(spark, values, function, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()]


def test_numbers(spark):
    raw = ["", "-", "–", "—", "abc", "121%", "1.234.567", "1.234.567,89", "1,234", "1234,5", "1,234,567", "1,234.5", "6193000", "-5", "28.709234", "1 234", None, " 7 "]
    assert each(spark, raw, U.norm_num) == [None] * 7 + [1234567.89, 1.234, 12345.0, 1234567.0, 1.2345, 6193000.0, -5.0, 28.709234, 1234.0, None, 7.0]


def test_units(spark):
    million = ["Triệu đồng", "triệu đồng", "Tr đồng", "Tiệu đồng", "Triệu dồng", "Triệu đổng", "1.000.000 đồng"]
    known = {**dict.fromkeys(million, 10**6), **dict.fromkeys(["đồng", "VND", "vnd"], 1), "Nghìn đồng": 1000, "tỷ đồng": 10**9}
    assert each(spark, list(known), U.unit_factor) == list(known.values()) and set(each(spark, list(known), U.canon_unit)) == {"VND"}
    refused = ["triệu VND", "dòng", "động", "đóng", "2 dòng", "số dòng", "%", "% (phần trăm)", "đơn vị", "dự án", "Công an tỉnh", "", None]
    assert each(spark, refused, U.unit_factor) == [None] * len(refused)
    assert each(spark, ["%", "% (phần trăm)", "Phần trăm (%)", "%(phần trăm)", "% so với dự toán", "tỷ lệ %", "đơn vị"], U.canon_unit) == ["%"] * 4 + ["% so với dự toán", "tỷ lệ %", "đơn vị"]
    assert each(spark, ["[Triệu đồng]", "đồng):", " a  b ", "(x)", "x))"], U.clean_unit) == ["Triệu đồng", "đồng", "a b", "(x)", "x"]
    assert each(spark, [unicodedata.normalize("NFD", u) for u in (*million, "Nghìn đồng", "tỷ đồng")], U.unit_factor) == [10**6] * len(million) + [1000, 10**9]
    mixed = ["e\u0323\u0302", "e\u0302\u0323", "ê\u0323", "ẹ\u0302", "Tri\u1ec7u đồng", "plain"]
    assert each(spark, mixed, X.composed) == ["ệ"] * 4 + ["Triệu đồng", "plain"]
    apart = spark.createDataFrame([(unicodedata.normalize("NFD", u),) for u in million], "u string")
    assert [r[0] for r in X.nfc(apart, "u").select(U.unit_factor(F.col("u"))).collect()] == [10**6] * len(million)
    assert each(spark, ["UBND tỉnh Cao Bằng", "Triệu đồng", "%", "người", "số 1234", ""], U.looks_like_unit) == [False, True, True, True, False, False]


def test_money(spark):
    assert each(spark, [None, 0, 352919320000000, 5 * 10**9, 110403, 2 * 10**15], U.money, "bigint") == ["", "0", "352919.32", "5", "0.000110403", "2000000!scale?"]
    assert each(spark, [None, 1, 2 * 10**15], lambda c: U.confidence(c, F.lit("PLAN"), F.lit("VND")), "bigint") == ["", "", "implausible"]
    assert each(spark, [1], lambda c: U.confidence(c, F.lit("COMPARE (%)"), F.lit("VND")), "bigint") == ["not_currency"]


def test_folding(spark):
    given = ["Chi đầu tư", "Đà Nẵng", "tiền sử dụng đất", None]
    want = ["chi dau tu", "da nang", "tien su dung dat", ""]
    assert each(spark, given, X.fold) == want and each(spark, [g and unicodedata.normalize("NFD", g) for g in given], X.fold) == want
    assert each(spark, ["Hà Nội (mới)!", "--", "TP. Đ"], X.slug) == ["Ha_Noi_moi", "", "TP_D"]
    assert each(spark, ["a\n b  c", None], lambda c: X.flat(c, 4)) == ["a b…", ""]
    assert each(spark, ["/Date(1600000000000)/", "", None, "x"], X.ms_date) == ["13/09/2020", "", "", ""]


def test_outline(spark):
    marks = {"A TỔNG": 0, "Đ TỔNG": 0, "I Thu": 2, "II x": 2, "VIII x": 2, "6 Thuế": 6, "1.1 Chi": 7, "- Thuế": 12, "a Dự án": 10, "(2) X": 4, "I.1 X": 3, "A.2 x": 1, "Thực hiện dự án": None, "TỔNG CHI": None}
    assert each(spark, list(marks), lambda c: X.outline_level(c).cast("int")) == list(marks.values())
    labels = ["II 1 Chi giáo dục", "2.0 Thực hiện", "- Thuế", "Sở Nội vụ", "a b"]
    assert each(spark, labels, X.indicator_clean) == ["Chi giáo dục", "Thực hiện", "Thuế", "Sở Nội vụ", "b"] and each(spark, labels, X.indicator_depth) == [2, 1, 1, 0, 1]
    assert each(spark, ["Năm 2020", "6 tháng đầu năm 2021", "Quý I", None], X.period_kind) == ["Năm", "6 tháng", "Quý", "Khác"]
    with pytest.raises(Exception, match="unknown basis"):
        each(spark, ["neither"], X.basis)


def test_a_block_reads_a_bare_i_both_ways(spark):
    labels = ["A a", "I a", "II b", "B b", "I a", "II b", "H h", "I section", "I roman", "II x", "K k", "I alone"]
    rows = spark.createDataFrame([(i, "b", x) for i, x in enumerate(labels)], "id int, block string, indicator_raw string")
    got = [r["level"] for r in H.block_levels(rows, ["block"]).orderBy("id").collect()]
    assert got == [0, 2, 2, 0, 2, 2, 0, 0, 2, 2, 0, 0]


def test_dotted_marks_have_all_their_children(spark):
    labels = ["1.1.1.1.1.1 x", "- a", "- b", "1.1.1.1.1.2 y", "- c"]
    df = spark.createDataFrame([(i, "b", x, 1) for i, x in enumerate(labels)], "id int, block string, indicator_raw string, vnd bigint")
    got = {(r["parent_id"], r["id"], r["parent_vnd"]) for r in H.children(H.block_levels(df, ["block"]), ["block"]).collect()}
    assert got == {(0, 1, 1), (0, 2, 1), (3, 4, 1)}


def test_a_basis_is_never_guessed(spark):
    asked = ["quyết toán năm 2020", "QUYETTOAN", "settled", "the outturn", "actual", "final", "Dự toán", "dutoan", "plan", "budget", "estimate"]
    assert each(spark, asked, X.basis, "string") == [True] * 6 + [False] * 5 and [X.is_settled(a) for a in asked] == [True] * 6 + [False] * 5
    with pytest.raises(Exception, match="unknown basis"):
        each(spark, ["whatever"], X.basis)
    with pytest.raises(ValueError):
        X.is_settled("")


def test_glossary_tells_shown_terms_only(spark):
    shown = spark.createDataFrame([("Quyết toán/TỔNG THU NSNN",), ("quyết toán",), ("khác",)], "series string")
    assert {r["term"] for r in X.glossary(shown).collect()} == {"QUYẾT TOÁN", "TỔNG THU NSNN"}


def test_marts_of_unambiguous_cells(spark):
    rows = [("f", f"p{k}", 2020, "T", 10 * (k + 1)) for k in range(9)] + [("f", "p9", 2020, "T", 0), ("f", "p0", 2019, "T", 7)]
    rows += [("f", "p0", 2020, "A", 4), ("f", "p0", 2020, "B", 3), ("f", "p0", 2020, "C", 0), ("f", "p1", 2020, "A", 19), ("f", "p1", 2020, "B", 9), ("f", "p2", 2019, "A", 1), ("f", "p3", 2021, "D", 5)]
    cells = spark.createDataFrame(rows, "form_code string, province string, year int, indicator_raw string, vnd bigint")
    assert [tuple(r) for r in M.trend_quartiles(cells, "T").collect()] == [(2020, 9, 30, 50, 70)]
    mixed = M.mix(cells, "T", {"a": "A", "b": "B", "c": "C"}, min_parts=2).collect()
    assert [(r["province"], r["year"], r["total"], r["a"], r["b"], r["c"], r["named"], r["n_parts"], r["other"]) for r in mixed] == [("p0", 2020, 10, 4, 3, None, 7, 2, 3)]  # p1's parts exceed its total
    owed = {r["province"]: (r["year"], r["spending"], r["borrowed"]) for r in M.borrowing(cells, {"spending": "T", "borrowed": "A"}).collect()}
    assert owed["p0"] == (2020, 10, 4) and owed["p2"] == (2020, 30, None) and "p9" not in owed


def test_publishers_without_rows_are_summed_up(spark):
    marked = spark.createDataFrame([("a", "", 1, 1)], "province string, dup_kind string, value int, vnd int")
    status = spark.createDataFrame([("a", 1, "XML"), ("b", 0, "PARSE_FAILED")], "province string, rows int, method string")
    got = {(r["province"], r["label"]): r["value"] for r in Q.summary_qa(marked, status).collect()}
    assert got[("b", "failed")] == 1 and got[("b", "raw_rows")] == 0 and got[("a", "final_rows")] == 1


def test_migration_is_refused_where_factors_change(spark):
    fact = spark.createDataFrame([("Triệu đồng", 1000000, 2.0), ("đồng", None, 1.0)], "unit string, factor long, value double")
    assert Q.migrate_checked(fact).count() == 2
    with pytest.raises(ValueError, match="Triệu"):
        Q.migrate_checked(fact.withColumn("factor", F.lit(1000)))


def test_break_down_takes_direct_children_only(spark):
    rows = [(0, "II Total", 100), (1, "1 a", 60), (2, "- x", 20), (3, "- y", 40), (4, "unmarked", 5), (5, "2 b", 40), (6, "3 c", None), (7, "III next", 9), (8, "IV zero", 0), (9, "1 none", 0), (10, "V blank", None), (11, "(1) p", 1)]
    df = spark.createDataFrame([(i, "b", x, v) for i, x, v in rows], "id int, block string, indicator_raw string, vnd bigint")
    got = {r["parent_id"]: r for r in H.break_down(H.block_levels(df, ["block"]), ["block"]).collect()}
    top = got[0]
    assert (top["published"], top["children_sum"], top["n_children"], top["blank_children"], top["scanned"], top["residual"], top["reconciles"]) == (100, 100, 3, 1, 6, 0, True)
    assert got[1]["children_sum"] == 60 and got[8]["reconciles"] is True and got[10]["reconciles"] is None and 7 not in got and 4 not in got


def test_magnitude_series(spark):
    rows = [(2018, 26003608), (2019, 20625921), (2020, 29106050000000), (2021, 28709234), (2022, 23556345000000)]
    v = spark.createDataFrame([(y, "p", y, "F", "x", "S", n, "VND") for y, n in rows], "id int, province string, year int, form_code string, indicator_raw string, series string, vnd bigint, unit string")
    assert {r["flag"] for r in C.timeseries(v, "F", "x", "S").collect()} == {"MAGNITUDE?"}
    assert C.pick_series(v, "F", "x") == "S" and C.pick_series(v, "F", "x", province="p") == "S"
    with pytest.raises(ValueError, match="choose"):
        C.pick_series(v, "F", "x", province="q")
    with pytest.raises(ValueError, match="choose"):
        C.pick_series(v, "F", "x", "T")


def test_reads_flag_what_is_no_amount_of_money_and_keep_zeros(spark):
    rows = [("p", 2019, 5, "VND"), ("p", 2020, 100, "VND"), ("p", 2020, 100, "VND"), ("q", 2020, 0, "VND"), ("r", 2020, 2 * 10**15, "VND"), ("s", 2020, 90, "%"), ("t", 2020, 7, "VND"), ("t", 2020, 8, "VND"), ("u", 2020, 0, "VND")]
    v = spark.createDataFrame([(i, p, y, "F", "x", "S", n, u) for i, (p, y, n, u) in enumerate(rows)], "id int, province string, year int, form_code string, indicator_raw string, series string, vnd bigint, unit string")
    assert {r["province"]: r["flag"] for r in C.compare_publishers(v, "F", "x", "S").collect()} == {"p": "", "q": "", "r": "implausible", "s": "not_currency", "t": "AMBIGUOUS", "u": ""}
    assert {(r["province"], r["year"]): (r["vnd"], r["flag"]) for r in C.timeseries(v, "F", "x", "S").filter("province in ('p', 'r', 't')").collect()} == {("p", 2019): (5, ""), ("p", 2020): (100, ""), ("r", 2020): (2 * 10**15, "implausible"), ("t", 2020): (None, "AMBIGUOUS")}
    sheet = lambda **k: {(r["province"], r["year"]): (r["x"], r["share"]) for r in B.balance_sheet(v, "F", {"x": "x"}, "S", {"share": ("x", "x")}, ["x"], **k).collect()}
    assert sheet()["p", 2020] == (100, "10000") and sheet()["q", 2020] == (0, "") and ("p", 2019) not in sheet() and ("t", 2020) not in sheet()
    assert set(sheet(province="p")) == {("p", 2019), ("p", 2020)} and set(sheet(year=2019)) == {("p", 2019)}


def test_the_publisher_directory(spark):
    df = spark.createDataFrame([("Sở A", 1), ("Sở B", 2), ("Sở A", 1)], "Title string, ID int")
    assert sorted(map(tuple, K.departments(df, "Title", "ID").collect())) == [("Sở A", 1), ("Sở B", 2)]


def test_names_are_never_guessed(spark):
    dim = spark.createDataFrame([("Bắc Ninh",), ("Hà Nội",), ("TP Hồ Chí Minh",), ("Huế",)], "name string")
    asked = spark.createDataFrame([(x,) for x in ("Bắc Ninh", "bac ninh", "Hanoi", "TPHCM", "thua thien hue", "Bắc Giang")], "asked string")
    alias = {"hanoi": "Hà Nội", "tphcm": "TP Hồ Chí Minh", "thua thien hue": "Huế"}
    got = dict(N.resolve_name(asked, "asked", dim, "name", alias).collect())
    assert got == {"Bắc Ninh": "Bắc Ninh", "bac ninh": "Bắc Ninh", "Hanoi": "Hà Nội", "TPHCM": "TP Hồ Chí Minh", "thua thien hue": "Huế", "Bắc Giang": None}
    assert [r["suggestion"] for r in N.suggest_name(asked.filter("asked = 'Bắc Giang'"), "asked", dim, "name", cutoff=0.5).collect()] == ["Bắc Ninh"]


def test_search_takes_queries_as_data(spark):
    rows = spark.createDataFrame([("Chi giáo dục", "f", "p1"), ("Chi giáo dục", "f", "p2"), ("Chi y tế", "f", "p1"), ("giáo viên", "g", "p1")], "label string, form string, pub string")
    index = S.search_index(rows, "label", "form", "pub")
    found = lambda q, **k: [r["label"] for r in S.find_indicators(index, q, **k).collect()]
    assert found("chi giao") == ["Chi giáo dục"] and found("GIÁO") == ["Chi giáo dục", "giáo viên"] and found("") == [] and found("gi") == []
    for q in ('chi "giáo', 'a""b', '"', "NEAR(a b)", "*", "chi - giáo"):
        found(q)
    assert found("chi - giáo") == ["Chi giáo dục"] and found("giao", form="g") == ["giáo viên"]


def test_dedup_keeps_the_first_in_source_order(spark):
    df = spark.createDataFrame([(1, "a", "u"), (2, "a", "u"), (3, "a", "w"), (4, None, "u"), (5, None, "u")], "ord int, k string, src string")
    assert {r["ord"]: r["dup_kind"] for r in D.mark_duplicates(df, ["k", "src"], ["k"]).collect()} == {1: "", 2: "exact", 3: "logical", 4: "", 5: "exact"}
    assert sorted(r["ord"] for r in D.dedup_logical(df, ["k", "src"], ["k"]).collect()) == [1, 4]
    assert D.multiset_diff(df, df.orderBy(F.desc("ord"))).count() == 0


def test_restating_twice_changes_nothing(spark):
    df = spark.createDataFrame([("f", "Triệu đồng", 2.0, 2e6, ""), ("f", "%", 5.0, None, ""), ("g", "đồng", 1.0, 3.0, "x")], "file string, unit string, value double, vnd double, note string")
    clean, conflicts = Q.restate_units(df, "file")
    assert [r["file"] for r in conflicts.collect()] == ["g"]
    once = sorted(map(tuple, clean.collect()))
    assert once == [("f", "%", 5.0, None, ""), ("f", "VND", 2e6, 2e6, "ĐVT nguồn: Triệu đồng")] and sorted(map(tuple, Q.restate_units(clean, "file")[0].collect())) == once


def test_units_of_a_sheet(spark):
    cells = [("p", "s", 0, 0, "Đơn vị tính: %"), ("p", "s", 0, 1, "Đơn vị: Triệu đồng"), ("q", "s", 1, 0, "Đơn vị: UBND tỉnh Cao Bằng"), ("r", "s", 2, 0, "Đơn vị tính:"), ("r", "s", 2, 2, "đồng"), ("t", "s", 0, 0, "Đơn vị: Triệu đồng")]
    df = spark.createDataFrame(cells, "path string, sheet string, row_no int, col_no int, text string")
    assert {r["path"]: r["src_unit"] for r in P.find_unit(df).collect()} == {"p": "%", "q": "", "r": "đồng", "t": "Triệu đồng"}


def test_xml_and_workbook_readers(spark, tmp_path):
    xml = "<?xml version='1.0' encoding='utf-16'?><form><title>T</title><header><f1>STT</f1><f2>Nội dung</f2><f3>Dự toán</f3><f4>So sánh</f4></header><content><row><f1>I</f1><f2>Thu</f2><f3>1.000</f3><f4/></row><row><f2/><f3>9</f3></row></content></form>"
    (tmp_path / "in").mkdir()
    for name, code in (("a.xml", "utf-8"), ("b.XML", "utf-16")):
        (tmp_path / "in" / name).write_bytes(xml.encode(code))
    (tmp_path / "in" / "bad.xml").write_text("<form>")
    tags = R.read_xml_forms(spark, str(tmp_path / "in"))
    got = sorted((r["indicator_raw"], r["series"], r["raw"]) for r in P.form_melt(tags.filter("error is null")).collect())
    assert got == sorted([("I Thu", "Dự toán", "1.000"), ("I Thu", "So sánh", "")] * 2) and tags.filter("error is not null").count() == 1
    with zipfile.ZipFile(tmp_path / "in" / "w.xlsx", "w") as z:
        ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>STT</t></si><si><r><t>Nội </t></r><r><t>dung</t></r></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row r="2"><c r="A2" t="s"><v>0</v></c><c r="B2" t="s"><v>1</v></c><c r="AA2" t="inlineStr"><is><t>x</t></is></c></row><row r="3"><c r="B3"><v>12.5</v></c></row></sheetData></worksheet>')
    (tmp_path / "in" / "old.xls").write_bytes(b"\xd0\xcf\x11\xe0 old")
    cells = R.read_grids(spark, str(tmp_path / "in"))
    assert {(r["row_no"], r["col_no"], r["text"]) for r in cells.filter("error is null").collect()} == {(1, 0, "STT"), (1, 1, "Nội dung"), (1, 26, "x"), (2, 1, "12.5")}
    assert [r["error"] for r in cells.filter("error is not null").collect()] == ["ValueError: not a zip workbook"]


def test_files_become_long_rows_and_a_star(spark, tmp_path):
    xml = "<form><title>Thu</title><code>B46</code><curencyunit>Triệu đồng</curencyunit><year>2020</year><periodType>Năm</periodType><header><f1>STT</f1><f2>Nội dung</f2><f3>DỰ TOÁN</f3></header><content>{}</content></form>"
    rows = "<row><f1>I</f1><f2>Tổng</f2><f3>1.234,5</f3></row><row><f1>1</f1><f2>Phần</f2><f3/></row><row><f1>1</f1><f2>Phần</f2><f3>-</f3></row>"
    (tmp_path / "a.xml").write_text(xml.format(rows + rows), encoding="utf-8")
    with zipfile.ZipFile(tmp_path / "w.xlsx", "w") as z:
        ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
        cell = lambda ref, text: f'<c r="{ref}" t="inlineStr"><is><t>{text}</t></is></c>'
        lines = [["Biểu số 50/CK", "Quyết định số: 12/QĐ"], ["Đơn vị tính: 1.000 đồng"], ["STT", "Nội dung", "Năm 2021"], ["A", "Chi", "7"], ["1", "Chi y tế", "3"]]
        body = "".join(f'<row r="{i + 1}">' + "".join(cell(f"{chr(65 + j)}{i + 1}", t) for j, t in enumerate(line)) + "</row>" for i, line in enumerate(lines))
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")
    tags, cells = R.read_xml_forms(spark, str(tmp_path)), R.read_grids(spark, str(tmp_path))
    at = {r["path"].rsplit("/", 1)[1]: r["path"] for r in tags.select("path").union(cells.select("path")).distinct().collect()}
    files = spark.createDataFrame([(at["a.xml"], 7, "u7"), (at["w.xlsx"], 8, "u8"), (at["w.xlsx"], 7, "u7")], "path string, report_id long, url string")
    names = "report_id long, province string, agency string, report_file string, approved_date string, publish_date string, period_type string, year_text string, report_type string, title string, circular string, currency_unit string, year int, files array<string>"
    reports = spark.createDataFrame([(7, "Huế", "Sở", "doc7", None, "01/02/2020", "Năm", "2019", "Tỉnh", "t7", "TT", None, 2020, ["a.xml"]), (8, "Huế", "Sở", "doc8", "x", None, "Quý", "2021", "Xã", "t8", "", None, 2021, ["w.xlsx"]), (9, "Hà Nội", "", "d", None, None, "", "", "", "t9", "", None, 2021, ["z.pdf"])], names)
    long = L.build_long(tags, cells, files, reports)
    assert long.drop("ord").schema.fieldNames() == L.LONG_SCHEMA.fieldNames()
    got = [tuple(r) for r in long.orderBy("ord").select("report_id", "indicator_raw", "raw", "value", "unit", "vnd", "table_label", "period", "doc_no", "doc_date").collect()]
    assert got == [(7, "I Tổng", "1.234,5", 1234.5e6, "VND", 1234.5e6, "Thu [B46]", "Năm 2020", "doc7", "01/02/2020"), (7, "1 Phần", "", None, "VND", None, "Thu [B46]", "Năm 2020", "doc7", "01/02/2020"), (7, "1 Phần", "-", None, "VND", None, "Thu [B46]", "Năm 2020", "doc7", "01/02/2020"),
                   (8, "A Chi", "7", 7000.0, "VND", 7000.0, "t8 [50/CK]", "Quý 2021", "12/QĐ", "x"), (8, "1 Chi y tế", "3", 3000.0, "VND", 3000.0, "t8 [50/CK]", "Quý 2021", "12/QĐ", "x")]
    assert {r["note"] for r in long.collect()} == {"TT; XML TT343; report 7; ĐVT nguồn: Triệu đồng", "; XLSX TT343; report 8; ĐVT nguồn: 1.000 đồng"}
    status = P.report_status(reports, L.parsed_counts(tags, cells, long, files))
    assert {r["report_id"]: (r["method"], r["rows"]) for r in status.collect()} == {7: ("XML", 3), 8: ("XLSX", 2), 9: ("PENDING_PDF_DOC", 0)}
    fact, dims = L.build_star(long, status)
    sinks.write_star(fact, dims, f"{tmp_path}/star")
    view = L.view_fact(spark.read.parquet(f"{tmp_path}/star/fact_row"), {n: spark.read.parquet(f"{tmp_path}/star/{n}") for n in dims})
    seen = {(r["indicator"], r["raw"]): (r["vnd"], r["year"], r["kind"], r["form_code"], r["unit_source"], r["unit"], r["report_id"]) for r in view.collect()}
    assert view.count() == 5 and len(dims) == 9 and seen[("Tổng", "1.234,5")] == (1234.5e6, 2020, "Năm", "B46", "Triệu đồng", "VND", 7) and seen[("Chi y tế", "3")] == (3000.0, 2021, "Quý", "50/CK", "1.000 đồng", "VND", 8)


def test_catalog_pages(spark, tmp_path):
    item = lambda i, files: {"ID": i, "Title": f"t{i}", "Attachments": [{"FileName": f, "Url": "u"} for f in files]}
    for d in ("x", "y"):
        (tmp_path / d).mkdir()
    (tmp_path / "x/page_2.json").write_text(json.dumps({"TotalItems": 5, "Items": [item(1, ["a.XML", "a.pdf"]), item(2, [])]}))
    (tmp_path / "x/page_10.json").write_text(json.dumps({"TotalItems": 5, "Items": [item(3, ["b.xlsx"])]}))
    (tmp_path / "y/page_1.json").write_text(json.dumps({"TotalItems": 1, "Items": []}))
    reports, gap = K.read_catalog(spark, f"{tmp_path}/*/*.json")
    assert {r["publisher"]: r["gap"] for r in gap.collect()} == {"x": 2, "y": 1} and [r["id"] for r in reports.collect()] == [1, 2, 3]
    named = reports.select(F.col("id").alias("report_id"), F.transform("attachments", lambda a: a["file_name"]).alias("files"))
    assert sorted(r["filename"] for r in K.attachment_manifest(named).collect()) == ["a.XML", "b.xlsx"] and K.attachment_manifest(named, with_all=True).count() == 3


def test_files_are_ingested_once(spark, tmp_path):
    for d in ("in", "out"):
        (tmp_path / d).mkdir()
    for i, name in enumerate(("a.bin", "b.bin")):
        (tmp_path / "in" / name).write_bytes(b"x" * (i + 1))
        for _ in range(2):
            ingest_incremental(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"))
        assert spark.read.parquet(str(tmp_path / "out")).count() == i + 1
    listed = spark.createDataFrame([("p", "1"), ("p", "2")], "path string, sha256 string")
    assert new_files(listed, listed.limit(1)).count() == 1


def test_sinks_replace_only_what_they_write(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "province string, x int")
    sinks.write_long(df, f"{tmp_path}/long", "province")
    sinks.write_long(df.filter("province = 'a'").withColumn("x", F.lit(7)), f"{tmp_path}/long", "province")
    assert sorted((r["province"], r["x"]) for r in spark.read.parquet(f"{tmp_path}/long").collect()) == [("a", 7), ("b", 2)]
    sinks.write_star(df.withColumn("province_id", F.lit(1)), {"dim": df}, f"{tmp_path}/star")
    sinks.write_marts({"m": df}, f"{tmp_path}/marts")
    assert spark.read.parquet(f"{tmp_path}/star/dim").count() == 2 and spark.read.json(f"{tmp_path}/marts/m").count() == 2
