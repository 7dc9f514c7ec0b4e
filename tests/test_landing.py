"""From landed files to marts, by batch and by stream; sheets in one grouping; the stored index; names, ranks and fingerprints against plain Python."""

import os
import random
import zipfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import dedup as D
from ledgerloom.operators import forms as P
from ledgerloom.operators import longrows as L
from ledgerloom.operators import names as N
from ledgerloom.operators import search as S
from ledgerloom.operators.ranks import order_statistics
from ledgerloom.plans import jobs
from ledgerloom.sources import files as R
from ledgerloom.sources import sinks, warehouse
from ledgerloom.streaming import ingest

NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REPORTS = "report_id long, province string, agency string, report_file string, approved_date string, publish_date string, period_type string, year_text string, report_type string, title string, circular string, currency_unit string, year int, files array<string>"


def workbook(path, lines):
    cell = lambda r, c, t: f'<c r="{chr(65 + c)}{r + 1}" t="inlineStr"><is><t>{t}</t></is></c>'
    body = "".join(f'<row r="{r + 1}">' + "".join(cell(r, c, t) for c, t in enumerate(line)) + "</row>" for r, line in enumerate(lines))
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {NS}><sheetData>{body}</sheetData></worksheet>")


def form(path, rows):
    body = "".join(f"<row><f1>{a}</f1><f2>{b}</f2><f3>{c}</f3></row>" for a, b, c in rows)
    path.write_text(f"<form><title>Thu</title><code>B46</code><curencyunit>Triệu đồng</curencyunit><header><f1>STT</f1><f2>Nội dung</f2><f3>PLAN</f3></header><content>{body}</content></form>", encoding="utf-8")


@pytest.fixture
def landed(spark, tmp_path):
    """Three reports: a form and a workbook of one, a workbook of the next, a file that can't be read of the last."""
    at = tmp_path / "in"
    at.mkdir()
    form(at / "a.xml", [("I", "Tổng số thu", "5"), ("1", "Phần đầu tư", ""), ("1", "Phần đầu tư", ""), ("2", "Phần còn lại", "2")])
    sheet = [["Biểu số 50/CK"], ["Đơn vị tính: đồng"], ["STT", "Nội dung", "PLAN"], ["I", "Tổng số chi", "7"], ["1", "Chi y tế", "3"]]
    workbook(at / "a.xlsx", sheet)
    workbook(at / "b.xlsx", sheet)
    (at / "c.xlsx").write_bytes(b"not a workbook")
    files = spark.createDataFrame([(f"file:{at}/{n}", i, f"u{i}") for n, i in (("a.xml", 1), ("a.xlsx", 1), ("b.xlsx", 2), ("c.xlsx", 3))], "path string, report_id long, url string")
    files = files.withColumn("path", F.concat(F.lit("file:"), F.substring("path", 6, 999)))
    names = {1: "Huế", 2: "Hà Nội", 3: "Hà Nội"}
    reports = spark.createDataFrame([(i, p, "Sở", "doc", None, "d", "Năm", "2020", "Tỉnh", f"t{i}", "", None, 2020, [f"{i}.xlsx"]) for i, p in names.items()], REPORTS)
    return at, files, reports


def bag(df):
    return Counter(tuple(r) for r in df.select(sorted(c for c in df.columns if c != "ord")).collect())


def test_a_stream_that_is_cut_off_gives_what_the_batch_gives(spark, landed, tmp_path, monkeypatch):
    at, files, reports = landed
    want = L.long_table(L.parsed_rows(R.read_xml_forms(spark, str(at)), R.read_grids(spark, str(at)), files, reports))
    sink, ck = str(tmp_path / "sink"), str(tmp_path / "ck")
    held = tmp_path / "held"
    held.mkdir()
    os.rename(at / "a.xml", held / "a.xml")  # the form comes after the workbook that it replaces
    calls, real = [], ingest.parsed_rows

    def failing(*given):
        calls.append(1)
        rows = real(*given)
        if len(calls) == 2:
            rows.write.mode("overwrite").parquet(f"{sink}/rows/batch=1")  # half of a batch is there when the job dies
            raise RuntimeError("cut off")
        return rows

    monkeypatch.setattr(ingest, "parsed_rows", failing)
    with pytest.raises(Exception, match="cut off"):
        ingest.ingest_forms(spark, str(at), sink, ck, files, reports, most=1)
    os.rename(held / "a.xml", at / "a.xml")
    for _ in range(2):  # the second run finds nothing new
        ingest.ingest_forms(spark, str(at), sink, ck, files, reports, most=1)
    got = ingest.long_of(spark, sink)
    assert bag(got) == bag(want) and [r["ord"] for r in got.orderBy("ord").collect()] == list(range(5 + 1))[: got.count()]
    assert {r["method"] for r in got.filter("report_id = 1").collect()} == {"XML"} and ingest.ingested(spark, sink, "failed").count() == 1


def test_landed_files_become_a_warehouse_with_marts(spark, landed, tmp_path):
    at, files, reports = landed
    path = str(tmp_path / "out")
    assert jobs.build_warehouse(spark, str(at), files, reports, path) == 1
    long = spark.read.parquet(f"{path}/long")
    assert long.count() == 5 and {r["province_current"] for r in long.filter("method = 'XML'").collect()} == {"Huế"}
    summary = {(r["province"], r["label"]): r["value"] for r in spark.read.parquet(f"{path}/summary_qa").collect()}
    assert summary["Huế", "raw_rows"] == 4 and summary["Huế", "final_rows"] == 3 and summary["Hà Nội", "failed"] == 1
    assert [(r["report_id"], r["method"]) for r in spark.read.parquet(f"{path}/pending_review").collect()] == [(3, "PARSE_FAILED")]
    mart = lambda n: spark.read.parquet(f"{path}/marts/{n}").collect()
    assert mart("kpi")[0]["row_count"] == 5 and {r["province"]: r["row_count"] for r in mart("volume")} == {"Huế": 3, "Hà Nội": 2}
    found = S.find_stored(S.open_index(spark, f"{path}/labels"), "TONG so").collect()
    assert {(r["label"], r["clean"], r["form"], r["convertible"], r["first_year"]) for r in found} == {("I Tổng số thu", "Tổng số thu", "B46", 1, 2020), ("I Tổng số chi", "Tổng số chi", "50/CK", 1, 2020)}
    assert warehouse.view(spark, f"{path}/star", "Hà Nội").count() == 2


def test_the_long_sink_has_a_default_that_its_rows_have(spark, tmp_path):
    row = {f.name: None for f in L.LONG_SCHEMA.fields} | {"province_current": "Huế", "raw": "1"}
    sinks.write_long(spark.createDataFrame([tuple(row.values())], L.LONG_SCHEMA), str(tmp_path / "long"))
    assert spark.read.parquet(str(tmp_path / "long")).first()["province_current"] == "Huế"


def test_one_grouping_reads_sheets_as_the_single_steps_do(spark):
    rnd, cells = random.Random(4), []
    words = ["STT", "Nội dung", "", "Chi", "Đơn vị tính: đồng", "Đơn vị: Triệu đồng", "Đơn vị: UBND tỉnh", "Đơn vị:", "đồng", "12", "1.5", "A", "(1)", "Biểu số 46/CK", "Quyết định số: 7/QĐ", "tt", None, " x "]
    for s in range(60):
        for r in range(rnd.choice([3, 12, 30, 70])):
            cells += [(f"p{s}", "s", r, c, rnd.choice(words)) for c in range(rnd.randint(1, 6)) if rnd.random() < 0.8]
    df = spark.createDataFrame(cells, "path string, sheet string, row_no int, col_no int, text string").cache()
    bounds = P.first_data_row(df, P.header_row(df))
    meta = {r["path"]: r for r in P.sheet_meta(P.sheet_lines(df)).collect()}
    assert {p: (r["hdr_row"], r["data_row"]) for p, r in meta.items()} == {r["path"]: (r["hdr_row"], r["data_row"]) for r in bounds.collect()} and len(meta) > 20
    units, named = ({r["path"]: r for r in f(df).collect()} for f in (P.find_unit, P.first_match_meta))
    assert all((r["src_unit"], r["form"], r["decision"]) == (units[p]["src_unit"], named[p]["form"], named[p]["decision"]) for p, r in meta.items())
    steps = P.sheet_melt(df, P.row_filter(df, bounds), P.header_path(P.merged_fill(df, bounds)))
    assert bag(P.melted_sheets(df).drop("src_unit", "form", "decision")) == bag(steps) and steps.count() > 100


def test_a_stored_index_reads_the_folders_of_its_words(spark, tmp_path):
    rows = [("1 Chi giáo dục", "f", "p1", 2020, 5), ("1 Chi giáo dục", "f", "p2", 2022, None), ("Chi y tế", "f", "p1", 2019, 1), ("giáo viên", "g", "p1", 2021, 1), ("a", "g", "p1", None, 1)]
    df = spark.createDataFrame(rows, "label string, form string, pub string, year int, vnd long")
    S.store_index(S.label_stats(df, "label", "form", "pub", "year", "vnd"), str(tmp_path / "ix"))
    index = S.open_index(spark, str(tmp_path / "ix"))
    found = lambda q, **k: [r["label"] for r in S.find_stored(index, q, **k).collect()]
    assert found("chi giao") == ["1 Chi giáo dục"] and found("GIÁO") == ["1 Chi giáo dục", "giáo viên"] and found("") == [] and found("gi") == [] and found("1") == [] and found("a") == ["a"]
    assert found("chi - giáo") == ["1 Chi giáo dục"] and found("giao", form="g") == ["giáo viên"] and found("chi", min_provinces=2) == ["1 Chi giáo dục"] and found("giao vien giao") == ["giáo viên"]
    for q in ('chi "giáo', 'a""b', '"', "NEAR(a b)", "*"):
        found(q)
    first = S.find_stored(index, "giao duc").first()
    assert (first["clean"], first["row_count"], first["provinces"], first["convertible"], first["first_year"], first["last_year"]) == ("Chi giáo dục", 2, 2, 1, 2020, 2022)
    plan = S.postings_of(index, ["chi", "giao"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and "PushedFilters: [Or(In(token" in plan


def test_suggestions_equal_all_pairs(spark):
    rnd = random.Random(2)
    draw = lambda: "".join(rnd.choice("abcd ") for _ in range(rnd.randint(0, 9)))
    names, asked = sorted({draw() for _ in range(120)}), sorted({draw() for _ in range(150)})

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = [(last := row)[0] + 1] + [0] * len(b)
            for j, y in enumerate(b, 1):
                row[j] = min(row[j - 1] + 1, last[j] + 1, last[j - 1] + (x != y))
        return row[-1]

    one = lambda values, name: spark.createDataFrame([(v,) for v in values], f"{name} string")
    for cutoff in (0.6, 0.75, 0.4):
        want = set()
        for a in asked:
            best = sorted((-int((1 - distance(a, b) / max(len(a), len(b))) * 10000 + 0.5), b) for b in names if a and b and 1 - distance(a, b) / max(len(a), len(b)) >= cutoff)[:5]
            want |= {(a, i + 1, b) for i, (_, b) in enumerate(best)}
        got = {(r["asked"], r["rank"], r["suggestion"]) for r in N.suggest_name(one(asked, "asked"), "asked", one(names, "name"), "name", cutoff=cutoff).collect()}
        assert got == want
    resolved = N.resolve_name(one(["ab", "zz", "zz"], "asked"), "asked", one(["AB", "cd"], "name"), "name")
    assert [tuple(r) for r in N.rejected_names(resolved, "asked", one(["AB", "cd"], "name"), "name").collect()] == [("zz", 2, "AB; cd")]
    slugs = N.resolve_slug(one(["Ha_Noi", "TP_HCM", "x"], "folder"), "folder", one(["Hà Nội", "Hồ Chí Minh"], "name"), "name", {"TP_HCM": "Hồ Chí Minh"})
    assert dict(slugs.collect()) == {"Ha_Noi": "Hà Nội", "TP_HCM": "Hồ Chí Minh", "x": None}


def test_order_statistics_equal_sorted_lists(spark):
    rnd = random.Random(5)
    rows = [("a", rnd.randint(-(10**18), 10**18)) for _ in range(2000)] + [("b", 5)] * 1000 + [("c", rnd.choice([1, 2, 2**62, 2**62 + 1])) for _ in range(300)] + [(None, 7), ("d", None)]
    df = spark.createDataFrame(rows, "k string, v long").cache()
    want = {}
    for k in ("a", "b", "c", None):
        x = sorted(v for q, v in rows if q == k)
        want[k] = (len(x), x[len(x) // 4], x[len(x) // 2])
    for bins, few in ((1024, 10_000), (8, 10)):
        assert {r["k"]: (r["n"], r["q"], r["m"]) for r in order_statistics(df, "k", "v", {"q": (1, 4), "m": (1, 2)}, bins, few).collect()} == want
    assert order_statistics(df.limit(0), "k", "v", {"m": (1, 2)}).count() == 0


def test_fingerprints_tell_multisets_apart(spark):
    rows = [(i % 4, None if i % 5 == 0 else f"x{i % 7}", i % 3) for i in range(200)]
    df = spark.createDataFrame(rows, "p int, a string, b int").cache()
    mark = lambda d: [tuple(r) for r in D.fingerprint(d).collect()]
    assert mark(df) == mark(df.repartition(7).orderBy(F.rand())) and D.changed_parts(df, df.orderBy("b"), "p").count() == 0
    other = df.union(df.limit(1)), df.withColumn("b", F.when((F.col("p") == 2) & (F.col("b") == 0), None).otherwise(F.col("b"))), spark.createDataFrame(rows[1:], df.schema)
    assert all(mark(d) != mark(df) for d in other)
    assert [r["p"] for r in D.changed_parts(df, other[1], "p").collect()] == [2] and bag(D.diff_by_part(df, other[1], "p")) == bag(D.multiset_diff(df, other[1]))
    swapped = spark.createDataFrame([(0, None, "y"), (0, "x", None)], "p int, a string, b string")
    assert mark(swapped) != mark(spark.createDataFrame([(0, "x", "y"), (0, None, None)], "p int, a string, b string"))
