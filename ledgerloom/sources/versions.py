"""Versions of a set of tables: written beside the standing one, audited, and published by one small write.

A version is a list of folders, by table and part. What a version does not change it shares with the one before. Readers take
the last version whose list is complete, so a load that fails, at whatever step, leaves what they read as it was.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Folders = dict[tuple[str, str], str]


def _children(spark: SparkSession, path: str) -> list[str]:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [str(x.getPath().toString()) for x in fs.globStatus(at) or []]


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the published versions, rising."""
    return sorted(int(p.rsplit("/", 2)[1]) for p in _children(spark, f"{path}/_versions/*/_SUCCESS"))


def folders(spark: SparkSession, path: str, version: int | None = None) -> Folders:
    """Folders of a version, or of the last one; none where nothing is published. There is one for each table, or table and part."""
    known = versions(spark, path)
    if version is None and not known:
        return {}
    rows = spark.read.parquet(f"{path}/_versions/{known[-1] if version is None else version}").collect()
    return {(r["table_name"], r["part"]): f"{path}/{r['folder']}" for r in rows}


def read(spark: SparkSession, path: str, table: str, part: str | None = None, version: int | None = None) -> DataFrame:
    """A table, or one part of it, as the version has it: other parts' folders are not listed."""
    found = [f for (t, p), f in folders(spark, path, version).items() if t == table and part in (None, p)]
    if not found:
        raise ValueError(f"no table {table}{'' if part is None else f', part {part}'} in {path}")
    return spark.read.parquet(*found)


def read_all(spark: SparkSession, path: str, tables: list[str] | tuple[str, ...], version: int | None = None) -> dict[str, DataFrame]:
    """Those of the tables that the version has, all as one version has them: its list is read once."""
    listed = folders(spark, path, version)
    found = {n: [f for (t, _), f in listed.items() if t == n] for n in tables}
    return {n: spark.read.parquet(*own) for n, own in found.items() if own}


def publish(spark: SparkSession, path: str, tables: dict[str, DataFrame], by: dict[str, str] | None = None, audit: Callable[[dict[str, DataFrame]], list[str]] | None = None) -> int:
    """Writes tables into new folders, audits them as they were written, and publishes a version that has them; its number.

    by names a column of a table by which it has a folder for each value; parts without rows here stay as they are. audit gets
    the written tables and returns what is wrong with them: then nothing is published, and ValueError says what.
    Two writers that publish at a time can't both win: a version's number is taken by the first.
    """
    stage, listed, written = f"data/{uuid4().hex}", dict(folders(spark, path)), {}
    for name, df in tables.items():
        column = (by or {}).get(name)
        if column is None:
            df.write.parquet(f"{path}/{stage}/{name}")
            written[name] = spark.read.parquet(f"{path}/{stage}/{name}")
            listed = {k: v for k, v in listed.items() if k[0] != name} | {(name, ""): f"{path}/{stage}/{name}"}
        else:
            # The column stays in the rows, so that one folder alone can be read.
            df.withColumn("__part", F.col(column)).repartition("__part").write.partitionBy("__part").parquet(f"{path}/{stage}/{name}")
            own = {p.rsplit("__part=", 1)[1]: p for p in _children(spark, f"{path}/{stage}/{name}/__part=*")}
            if own:
                written[name] = spark.read.parquet(*own.values())
            else:
                written[name] = df.limit(0)
            listed |= {(name, part): p for part, p in own.items()}
    wrong = audit(written) if audit else []
    if wrong:
        raise ValueError("not published: " + "; ".join(wrong))
    number = (versions(spark, path) or [0])[-1] + 1
    short = lambda p: p[p.index(stage) :] if stage in p else p.removeprefix(f"{path}/")
    rows = [(t, p, short(f)) for (t, p), f in sorted(listed.items())]
    spark.createDataFrame(rows, "table_name string, part string, folder string").coalesce(1).write.mode("error").parquet(f"{path}/_versions/{number}")
    return number
