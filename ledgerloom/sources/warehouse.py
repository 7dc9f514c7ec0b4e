"""A standing warehouse: loads of publishers into a star schema, audited and published by version; unit migrations; reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.longrows import build_star, view_fact
from ledgerloom.operators.quality import migrate_units, migration_plan
from ledgerloom.sources import versions

DIMENSIONS = ("province", "period", "scope", "table", "indicator", "series", "unit", "raw")


def _dims(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return versions.read_all(spark, path, DIMENSIONS)


def load(spark: SparkSession, path: str, rows: DataFrame, status: DataFrame) -> int:
    """Loads long rows (with ord) of some publishers, and the status of their reports, into the warehouse at path; the version's number.

    A publisher's fact and reports are replaced as a whole; those of others stay where they are. Dimensions only grow: ids and
    attributes once given are kept. So loading the same rows again gives equal tables. Published is what passes the audit: as
    many facts as rows, each pointing to a row of every dimension, no label twice.
    """
    known = _dims(spark, path)
    fact, dims = build_star(rows, status, known or None)
    reports = dims.pop("report")
    expected = rows.count()

    def audit(written: dict[str, DataFrame]) -> list[str]:
        c, wrong, all_dims, fact_ = F.col, [], None, written["fact_row"]
        for name in DIMENSIONS:
            own = written[name].select(F.lit(name).alias("dim"), "label", "id")
            all_dims = own if all_dims is None else all_dims.unionByName(own)
            fact_ = fact_.join(written[name].select(c("id").alias(f"{name}_id"), F.lit(1).alias(f"__{name}")), f"{name}_id", "left")
        for r in all_dims.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("label").alias("labels"), F.countDistinct("id").alias("ids"), F.max("id").alias("top")).collect():
            if not r["n"] == r["labels"] == r["ids"] == r["top"]:
                wrong.append(f"{r['dim']}: {r['n']} rows, {r['labels']} labels, {r['ids']} ids up to {r['top']}")
        seen = fact_.agg(F.count(F.lit(1)).alias("facts"), *[F.count(f"__{n}").alias(n) for n in DIMENSIONS]).first()
        if seen["facts"] != expected:
            wrong.append(f"{seen['facts']} facts for {expected} rows")
        wrong += [f"{n}: facts without a label" for n in DIMENSIONS if seen[n] != seen["facts"]]
        return wrong

    owned = reports.filter("province_id is not null")
    return versions.publish(spark, path, {**dims, "fact_row": fact, "report": owned}, {"fact_row": "province_id", "report": "province_id"}, audit)


def view(spark: SparkSession, path: str, publisher: str | None = None, version: int | None = None) -> DataFrame:
    """The fact view of all publishers, or of one, whose folder alone is read."""
    dims = versions.read_all(spark, path, DIMENSIONS, version)
    part = None
    if publisher is not None:
        found = dims["province"].filter(F.col("label") == publisher).select("id").first()
        if found is None:
            raise ValueError(f"no publisher {publisher}")
        part = str(found["id"])
    return view_fact(versions.read(spark, path, "fact_row", part, version), dims)


def migrate(spark: SparkSession, path: str, table: str = "fact", version: int = 1) -> int:
    """migrate_units() of a stored table as a new version: written, audited against the one before, and only then published.

    ValueError, and nothing is published, where a unit's factor would change, a row or figure would be lost or made, or a
    converted figure would move.
    """
    before = versions.read(spark, path, table)
    refused = [r["unit"] for r in migration_plan(before).filter("refused").select("unit").limit(20).collect()]
    if refused:
        raise ValueError(f"factors would change for {refused}")
    return publish_checked(spark, path, table, migrate_units(before, version))


def publish_checked(spark: SparkSession, path: str, table: str, after: DataFrame) -> int:
    """Publishes after as the table's next version if it keeps rows, figures and converted figures of the standing one."""
    before = versions.read(spark, path, table)

    def sums(df: DataFrame) -> tuple:
        done = F.col("canon_version") if "canon_version" in df.columns else F.lit(0)
        vnd = F.when(F.col("factor").isNotNull(), F.when(done > 0, F.col("value")).otherwise(F.col("value") * F.col("factor")))
        return tuple(df.agg(F.count(F.lit(1)), F.count("value"), F.count(vnd), F.sum(F.round(vnd).cast("decimal(38,0)"))).first())

    def audit(written: dict[str, DataFrame]) -> list[str]:
        names = ("rows", "figures", "converted figures", "sum of converted figures")
        return [f"{n} {a} became {b}" for n, a, b in zip(names, sums(before), sums(written[table]), strict=True) if a != b]

    return versions.publish(spark, path, {table: after}, None, audit)
