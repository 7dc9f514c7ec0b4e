"""Dense ids, loads into a standing warehouse, and versions that are audited before they are read."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import longrows as L
from ledgerloom.operators.order import placed
from ledgerloom.operators.star import dim_encode
from ledgerloom.sources import versions, warehouse


def long_rows(spark, rows):
    """Long rows of (ord, publisher, year, indicator, raw, unit)."""
    full = [{**dict.fromkeys(f.name for f in L.LONG_SCHEMA.fields), "province_current": p, "period": f"Năm {y}", "scope": "Tỉnh", "table_label": f"T [B{y}]", "indicator_raw": i, "series": "PLAN", "raw": r, "value": float(r) if r else None, "unit": u, "note": f"x; report {y}", "report_id": y, "ord": o} for o, p, y, i, r, u in rows]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in L.LONG_SCHEMA.fields) + ", ord long"
    return spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", ")) for r in full], schema)


def statuses(spark, publishers):
    return spark.createDataFrame([(i, p, "t", 2020, "XML", "", "", 1) for i, p in enumerate(publishers)], "report_id long, province string, title string, year int, method string, reason string, exts string, rows long")


def as_rows(df):
    return sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())


A = [(0, "Huế", 2020, "I Thu", "5", "Triệu đồng"), (1, "Huế", 2020, "1 Phần", "", "đồng"), (2, "Huế", 2021, "I Thu", "7", "đồng")]
B = [(0, "Hà Nội", 2021, "II Chi", "9", "%"), (1, "Hà Nội", 2021, "I Thu", "5", "đồng")]


def test_places_are_gapless_in_every_group(spark):
    rows = [("a" if i % 3 else "b" if i % 7 else "c", i * 37 % 1000, i) for i in range(1000)]
    for parts in (1, 7):
        got = placed(spark.createDataFrame(rows, "g string, x long, i long").repartition(parts), "g", [F.col("x"), F.col("i")]).collect()
        for g in "abc":
            own = sorted(r for r in got if r["g"] == g)
            assert [r["pos"] for r in sorted(own, key=lambda r: (r["x"], r["i"]))] == list(range(len(own))) and {r["n"] for r in own} == {len(own)}


def test_ids_are_dense_and_follow_first_appearance(spark):
    df = spark.createDataFrame([(i * 7919 % 1000, f"l{i * 7919 % 1000 % 300}", i) for i in range(1000)], "ord long, label string, x long").repartition(5)
    once, again = (dim_encode(d, "label", ["x"], "ord").collect() for d in (df, df.repartition(3)))
    first = {}
    for o, label, x in sorted(map(tuple, df.collect())):
        first.setdefault(label, (o, x))
    want = [(i + 1, label, x) for i, (label, (_, x)) in enumerate(sorted(first.items(), key=lambda kv: kv[1][0]))]
    assert sorted(map(tuple, once)) == sorted(map(tuple, again)) == want
    plan = dim_encode(df, "label", ["x"], "ord")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_a_publisher_is_loaded_again_and_others_stay(spark, tmp_path):
    path = str(tmp_path / "wh")
    assert versions.folders(spark, path) == {}
    warehouse.load(spark, path, long_rows(spark, A), statuses(spark, ["Huế"]))
    ids = {r["label"]: r["id"] for r in versions.read(spark, path, "indicator").collect()}
    assert ids == {"I Thu": 1, "1 Phần": 2}
    warehouse.load(spark, path, long_rows(spark, B), statuses(spark, ["Hà Nội"]))
    two = versions.folders(spark, path)
    seen = as_rows(warehouse.view(spark, path))
    assert len(seen) == 5 and {r["label"]: r["id"] for r in versions.read(spark, path, "indicator").collect()} == {**ids, "II Chi": 3}
    tables = {t: as_rows(versions.read(spark, path, t)) for t in (*warehouse.DIMENSIONS, "fact_row", "report")}
    assert warehouse.load(spark, path, long_rows(spark, A), statuses(spark, ["Huế"])) == 3
    three = versions.folders(spark, path)
    assert {t: as_rows(versions.read(spark, path, t)) for t in tables} == tables and as_rows(warehouse.view(spark, path)) == seen
    assert three["fact_row", "2"] == two["fact_row", "2"] and three["fact_row", "1"] != two["fact_row", "1"]  # Hà Nội's folder is the same
    assert len(as_rows(warehouse.view(spark, path, "Hà Nội"))) == 2
    fewer = warehouse.load(spark, path, long_rows(spark, A[:1]), statuses(spark, ["Huế"]))
    assert warehouse.view(spark, path).count() == 3 and warehouse.view(spark, path, version=fewer - 1).count() == 5  # the version before can still be read
    with pytest.raises(ValueError, match="no publisher"):
        warehouse.view(spark, path, "Vinh")
    view = {(r["indicator_raw"], r["unit_source"]): (r["vnd"], r["year"], r["form_code"], r["report_id"]) for r in warehouse.view(spark, path, version=2).collect()}
    assert view["I Thu", "Triệu đồng"] == (5e6, 2020, "B2020", 2020) and view["II Chi", "%"] == (None, 2021, "B2021", 2021)


def test_what_fails_the_audit_is_not_published(spark, tmp_path):
    path = str(tmp_path / "wh")
    warehouse.load(spark, path, long_rows(spark, A), statuses(spark, ["Huế"]))
    before = as_rows(warehouse.view(spark, path))
    with pytest.raises(ValueError, match="too few"):
        versions.publish(spark, path, {"indicator": spark.createDataFrame([(1, "x")], "id long, label string")}, None, lambda written: ["too few"] if written["indicator"].count() < 2 else [])
    assert versions.versions(spark, path) == [1] and as_rows(warehouse.view(spark, path)) == before
    (tmp_path / "wh/_versions/2").mkdir()  # a writer that was lost before its list was complete
    assert versions.versions(spark, path) == [1] and as_rows(warehouse.view(spark, path)) == before


def test_migrations_are_published_when_nothing_is_lost(spark, tmp_path):
    path = str(tmp_path / "wh")
    fact = spark.createDataFrame([(1, "Triệu đồng", 1000000, 2.0), (2, "đồng", 1, 3.0), (3, "%", None, 4.0), (4, "đồng", 1, None)], "id long, unit string, factor long, value double")
    versions.publish(spark, path, {"fact": fact})
    assert warehouse.migrate(spark, path) == 2 and warehouse.migrate(spark, path) == 3  # the second run changes nothing
    now = {r["id"]: r["value"] for r in versions.read(spark, path, "fact").collect()}
    assert now == {1: 2e6, 2: 3.0, 3: 4.0, 4: None} and versions.read(spark, path, "fact", version=1).filter("id = 1").first()["value"] == 2.0
    good = versions.read(spark, path, "fact")
    for broken, why in ((good.filter("id > 1"), "rows 4 became 3"), (good.withColumn("value", F.when(F.col("id") != 3, F.col("value"))), "figures 3 became 2"), (good.withColumn("value", F.col("value") * 10), "sum of converted")):
        with pytest.raises(ValueError, match=why):
            warehouse.publish_checked(spark, path, "fact", broken)
    assert {r["id"]: r["value"] for r in versions.read(spark, path, "fact").collect()} == now and versions.versions(spark, path) == [1, 2, 3]
    versions.publish(spark, path, {"fact": fact.withColumn("factor", F.lit(1000))})
    with pytest.raises(ValueError, match="Triệu"):
        warehouse.migrate(spark, path)
