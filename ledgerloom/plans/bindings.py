"""Budget forms derived from the given tables, and the same definitions as SQL for DuckDB.

One form for each nation and year: plan figures from orders, outturn from their lines, in a flattened
hierarchy of total, segment, priority and status, with outline marks and planted defects.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.operators.search import label_stats, open_index, store_index
from ledgerloom.plans.common import shared_folder, table

#: Published spellings of the unit, by nation; the factor of each.
UNITS = ("đồng", "Nghìn đồng", "Triệu đồng", "Tr đồng", "VND", "%", "dự án", "1.000 đồng")
FACTORS = (1, 1_000, 1_000_000, 1_000_000, 1, None, None, 1_000)
FORM = "B46"
BLOCK = ["province", "year", "form_code", "series", "report_id", "table_label"]


#: Where the forms of a folder were stored in this application.
_STORED: dict[tuple[str, str, bool], str] = {}


def forms(spark: SparkSession, sf_dir: str, by_customer: bool = False) -> DataFrame:
    """The stored rows of the forms: computed and written to the shared folder once for an application and input, read by every query after that."""
    at = (spark.sparkContext.applicationId, sf_dir, by_customer)
    if at not in _STORED:
        path = f"{shared_folder(spark)}/forms-{uuid4().hex}"
        built_forms(spark, sf_dir, by_customer).write.parquet(path)
        _STORED[at] = path
    return spark.read.parquet(_STORED[at])


#: Orders of one part of the customers' forms; their forms have about six times as many rows.
PART_ORDERS = 100_000


def _parts(spark: SparkSession, sf_dir: str) -> int:
    """Parts of the customers' forms, by the number of orders, which is in the files' footers."""
    return spark.sparkContext.defaultParallelism + table(spark, sf_dir, "orders").count() // PART_ORDERS


def built_forms(spark: SparkSession, sf_dir: str, by_customer: bool = False) -> DataFrame:
    """Rows of the forms, in columns of the fact view, with their place in the hierarchy. Publishers are nations, or customers: then the forms grow with the input.

    Order lines are summed by order before the join; the hierarchy comes from one grouping over four
    levels; ids number the rows of a form depth first, so no global order is needed.
    """
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("outturn"))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("y"), F.col("o_orderpriority").alias("p"), F.col("o_orderstatus").alias("st"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("plan"),
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("s"))
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("pub"), F.col("n_nationkey").alias("nk"))
    if by_customer:  # all that follows is within a customer, so their rows are brought together once, in parts that are sorted in memory
        base = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").repartition(_parts(spark, sf_dir), "o_custkey")
    else:
        base = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    base = base.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    sums = [F.sum("plan").alias("PLAN"), F.sum("outturn").alias("OUTTURN")]
    own = "o_custkey" if by_customer else "pub"
    top = [own, "nk", "y"]
    finest = base.groupBy(*top, "s", "p", "st").agg(*sums)  # the rest is summed from these few rows
    # Levels are exploded, not grouping sets: those would name the publisher anew and shuffle every row again.
    level = lambda *kept: F.struct(*[(F.col(c) if c in kept else F.lit(None).cast("string")).alias(c) for c in ("s", "p", "st")], *[F.lit(int(c not in kept)).alias(g) for g, c in (("gs", "s"), ("gp", "p"), ("gt", "st"))])
    levels = F.explode(F.array(level(), level("s"), level("s", "p"), level("s", "p", "st"))).alias("x")
    again = [F.sum("PLAN").alias("PLAN"), F.sum("OUTTURN").alias("OUTTURN")]
    grouped = finest.select(*top, "PLAN", "OUTTURN", levels).select(*top, "PLAN", "OUTTURN", "x.*").groupBy(*top, "s", "p", "st", "gs", "gp", "gt").agg(*again)
    form = Window.partitionBy(own, "y")
    place = F.row_number().over(form.orderBy(F.desc("gs"), "s", F.desc("gp"), "p", F.desc("gt"), "st"))
    # A form's one total comes first, so segments have ranks from 2; the order is the beginning of that of places.
    sr = F.when(F.col("gs") == 1, 1).otherwise(F.dense_rank().over(form.orderBy(F.desc("gs"), "s")) - 1)
    roman = F.element_at(F.array(*[F.lit(r) for r in ("I", "II", "III", "IV", "V", "VI", "VII", "VIII")]), F.col("sr"))
    label = (
        F.when(F.col("gs") == 1, "A TOTAL").when(F.col("gp") == 1, F.concat(roman, F.lit(" "), "s"))
        .when(F.col("gt") == 1, F.concat(F.substring("p", 1, 1), F.lit(" "), F.expr("substr(p, 3)"))).otherwise(F.concat(F.lit("- "), "st"))
    )
    numbered = grouped.withColumn("n", place).withColumn("sr", sr).withColumn("indicator_raw", label)
    series = F.explode(F.array(*[F.struct(F.lit(k).alias("series"), F.lit(i).alias("k"), F.col(k).alias("v")) for i, k in enumerate(("PLAN", "OUTTURN"))])).alias("x")
    rows = numbered.select("*", series).select("*", "x.series", "x.k", "x.v")
    at = (F.col("nk") % 8 + 1).cast("int")
    ident = ((F.col("o_custkey" if by_customer else "nk") * 10000 + F.col("y")).cast("long") * 1000 + F.col("n")) * 2 + F.col("k")
    blank = F.col("v").isNull() | (F.col("id") % 13 == 5)
    value = F.when((F.col("nk") % 11 == 3) & (F.col("y") % 3 == 0), F.expr("v div 1000000")).otherwise(F.col("v"))
    return (
        rows.withColumn("id", ident).withColumn("unit", F.element_at(F.array(*[F.lit(u) for u in UNITS]), at))
        .withColumn("factor", F.element_at(F.array(*[F.lit(f).cast("long") for f in FACTORS]), at))
        .withColumn("raw", F.when(blank, "").when(F.col("id") % 17 == 3, "-").otherwise(value.cast("string")))
        .withColumn("value", F.when(F.col("raw").isin("", "-"), F.lit(None).cast("long")).otherwise(value))
        .select(
            "id", (F.concat(F.lit("C"), "o_custkey") if by_customer else F.col("pub")).alias("province"), F.col("nk").cast("int").alias("nk"), F.col("y").cast("int").alias("year"), F.lit(FORM).alias("form_code"),
            F.lit(f"Budget [{FORM}]").alias("table_label"), F.when(F.col("nk") % 2 == 0, "Tỉnh").otherwise("Xã").alias("scope"), "indicator_raw", "series",
            "unit", "factor", "raw", "value", (F.col("value") * F.col("factor")).alias("vnd"),
            (F.col("nk") * 10 + F.col("y") % 10 + F.when((F.col("sr") > 3) & (F.col("nk") % 10 == 7) & (F.col("gs") == 0), 1000).otherwise(0)).cast("int").alias("report_id"),
            "gs", "gp", "gt", F.col("sr").cast("int").alias("sr"),
        )
    )


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forms as they land: with exact duplicates, and logical ones under another source."""
    v = forms(spark, sf_dir).withColumn("source_url", F.concat(F.lit("r"), F.col("report_id"))).withColumn("ord", F.col("id") * 4)
    exact = v.filter("id % 97 = 0").withColumn("ord", F.col("ord") + 1)
    logical = v.filter("id % 89 = 0").withColumn("source_url", F.concat("source_url", F.lit("x"))).withColumn("ord", F.col("ord") + 2)
    return v.unionByName(exact).unionByName(logical)


def planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forms with figures published twice, figures of 0, and figures that are no amount of money."""
    v, there = forms(spark, sf_dir), F.col("vnd").isNotNull()
    vnd = F.when(there & (F.col("id") % 31 == 1), 0).when(there & (F.col("id") % 37 == 2), 2 * 10**15).otherwise(F.col("vnd")).cast("long")
    v = v.withColumn("vnd", vnd)
    return v.unionByName(v.filter("id % 29 = 0"))


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog: a report for each nation and year, with its attachments."""
    o = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").cast("int").alias("year"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation")
    keys = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select("c_nationkey", "year").distinct().join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    r = keys.select((F.col("n_nationkey") * 10 + F.col("year") % 10).cast("int").alias("report_id"), F.col("n_name").alias("province"), "year")
    kinds = ((2, ".PDF"), (3, ".xlsx"), (5, ".xml"))
    files = F.filter(F.array(*[F.when(F.col("report_id") % k == 0, F.concat(F.lit("r"), "report_id", F.lit(e))) for k, e in kinds]), lambda x: x.isNotNull())
    return r.withColumn("title", F.concat(F.lit("Report "), "report_id", F.lit(" for "), "year")).withColumn("files", files)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents as labels: (doc_id, line, label, province, form), with an outline mark put before most."""
    marks = ("I ", "II. ", "1.1 ", "- ", "(2) ", "a) ", "", "A ", "V ", "I.2 ")
    cut = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("province"), F.col("lang").alias("form"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line", "text"))
    mark = F.element_at(F.array(*[F.lit(m) for m in marks]), (F.pmod(F.col("doc_id") + F.col("line"), F.lit(len(marks))) + 1).cast("int"))
    return cut.select("doc_id", F.col("line").cast("long").alias("line"), F.concat(mark, "text").alias("label"), "text", "province", "form")


#: The label index of a folder, as it was stored in this application.
_INDEXED: dict[tuple[str, str], tuple[DataFrame, DataFrame]] = {}


def label_index(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The stored index of all labels of lines(); written once for an application and input. A line's year and figure stand for a row's."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _INDEXED:
        path = f"{shared_folder(spark)}/labels-{uuid4().hex}"
        rows = lines(spark, sf_dir).withColumn("year", (1990 + F.col("doc_id") % 30).cast("int")).withColumn("vnd", F.when(F.col("line") % 3 != 1, F.col("doc_id")))
        store_index(label_stats(rows, "label", "form", "province", "year", "vnd"), path)
        _INDEXED[at] = open_index(spark, path)
    return _INDEXED[at]


_UNITS = ", ".join(f"'{u}'" for u in UNITS)
_FACTORS = ", ".join("NULL" if f is None else str(f) for f in FACTORS)
#: The same as CTEs: v (forms), landed, reports and lines.
FORMS_SQL = f"""
fl AS (SELECT l_orderkey, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS outturn FROM lineitem GROUP BY l_orderkey),
fb AS (SELECT n_name AS pub, n_nationkey AS nk, year(o_orderdate) AS y, c_mktsegment AS s, o_orderpriority AS p, o_orderstatus AS st,
              CAST(round(o_totalprice * 100) AS BIGINT) AS plan, outturn
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey LEFT JOIN fl ON o_orderkey = l_orderkey),
fr AS (SELECT pub, nk, y, s, p, st, grouping(s) AS gs, grouping(p) AS gp, grouping(st) AS gt, CAST(sum(plan) AS BIGINT) AS plan, CAST(sum(outturn) AS BIGINT) AS outturn
       FROM fb GROUP BY GROUPING SETS ((pub, nk, y), (pub, nk, y, s), (pub, nk, y, s, p), (pub, nk, y, s, p, st))),
fd AS (SELECT *, dense_rank() OVER (PARTITION BY pub, y, gs ORDER BY s) AS sr,
              row_number() OVER (PARTITION BY pub, y ORDER BY gs DESC, s, gp DESC, p, gt DESC, st) AS n FROM fr),
fx AS (SELECT *, CASE WHEN gs = 1 THEN 'A TOTAL' WHEN gp = 1 THEN ['I','II','III','IV','V','VI','VII','VIII'][sr] || ' ' || s
              WHEN gt = 1 THEN substr(p, 1, 1) || ' ' || substr(p, 3) ELSE '- ' || st END AS indicator_raw FROM fd),
fs AS (SELECT *, 'PLAN' AS series, plan AS v, ((nk * 10000 + y)::BIGINT * 1000 + n) * 2 AS id FROM fx
       UNION ALL SELECT *, 'OUTTURN', outturn, ((nk * 10000 + y)::BIGINT * 1000 + n) * 2 + 1 FROM fx),
ft AS (SELECT *, CASE WHEN nk % 11 = 3 AND y % 3 = 0 THEN v // 1000000 ELSE v END AS w FROM fs),
fw AS (SELECT *, CASE WHEN v IS NULL OR id % 13 = 5 THEN '' WHEN id % 17 = 3 THEN '-' ELSE CAST(w AS VARCHAR) END AS raw,
              [{_UNITS}][nk % 8 + 1] AS unit, CAST([{_FACTORS}][nk % 8 + 1] AS BIGINT) AS factor FROM ft),
v AS (SELECT id, pub AS province, CAST(nk AS INT) AS nk, CAST(y AS INT) AS year, '{FORM}' AS form_code, 'Budget [{FORM}]' AS table_label,
             CASE WHEN nk % 2 = 0 THEN 'Tỉnh' ELSE 'Xã' END AS scope, indicator_raw, series, unit, factor, raw,
             CASE WHEN raw IN ('', '-') THEN NULL ELSE w END AS value, CASE WHEN raw IN ('', '-') THEN NULL ELSE w * factor END AS vnd,
             CAST(nk * 10 + y % 10 + CASE WHEN sr > 3 AND nk % 10 = 7 AND gs = 0 THEN 1000 ELSE 0 END AS INT) AS report_id, gs, gp, gt, CAST(sr AS INT) AS sr FROM fw),
landed AS (SELECT *, 'r' || report_id AS source_url, id * 4 AS ord FROM v
           UNION ALL SELECT *, 'r' || report_id, id * 4 + 1 FROM v WHERE id % 97 = 0
           UNION ALL SELECT *, 'r' || report_id || 'x', id * 4 + 2 FROM v WHERE id % 89 = 0)"""
#: v with customers as publishers.
LARGE_SQL = FORMS_SQL.replace("n_name AS pub", "'C' || c_custkey AS pub").replace("(nk * 10000 + y)::BIGINT", "(substr(pub, 2)::BIGINT * 10000 + y)")
PLANTED_SQL = """
p0 AS (SELECT * REPLACE (CASE WHEN vnd IS NOT NULL AND id % 31 = 1 THEN 0 WHEN vnd IS NOT NULL AND id % 37 = 2 THEN 2000000000000000 ELSE vnd END AS vnd) FROM v),
pv AS (SELECT * FROM p0 UNION ALL SELECT * FROM p0 WHERE id % 29 = 0)"""
REPORTS_SQL = """
rk AS (SELECT DISTINCT c_nationkey, year(o_orderdate) AS year FROM orders JOIN customer ON o_custkey = c_custkey),
rr AS (SELECT CAST(n_nationkey * 10 + year % 10 AS INT) AS report_id, n_name AS province, CAST(year AS INT) AS year FROM rk JOIN nation ON c_nationkey = n_nationkey),
reports AS (SELECT *, 'Report ' || report_id || ' for ' || year AS title,
                   list_filter([CASE WHEN report_id % 2 = 0 THEN 'r' || report_id || '.PDF' END, CASE WHEN report_id % 3 = 0 THEN 'r' || report_id || '.xlsx' END,
                                CASE WHEN report_id % 5 = 0 THEN 'r' || report_id || '.xml' END], lambda x: x IS NOT NULL) AS files FROM rr)"""
LINES_SQL = """
l0 AS (SELECT doc_id, source AS province, lang AS form, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l1 AS (SELECT doc_id, province, form, unnest(parts) AS text, unnest(range(len(parts))) AS line FROM l0),
lines AS (SELECT doc_id, line, ['I ', 'II. ', '1.1 ', '- ', '(2) ', 'a) ', '', 'A ', 'V ', 'I.2 '][CAST((doc_id + line) % 10 + 1 AS INT)] || text AS label, text, province, form FROM l1)"""
