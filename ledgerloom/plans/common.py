"""Plan helpers: lineage cuts in the shared folder, and broadcasts behind a size check."""

from __future__ import annotations

import gc
import tempfile
import time
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when it has been counted and measured, and has at most so many rows and bytes.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Applications that have the library's files.
_SENT: set[str] = set()


def send_library(spark: SparkSession) -> None:
    """Sends the package to the Python workers of all executors, once for an application, so that it need not be installed there."""
    sc = spark.sparkContext
    root = Path(__file__).resolve().parents[1]
    if sc.applicationId in _SENT or not root.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="ledgerloom-")) / "ledgerloom.zip"  # read by the driver alone, which Spark lets send it
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(archive))
    _SENT.add(sc.applicationId)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder of intermediate rows that nothing reads any more, in whatever store it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the one in spark.checkpoint.dir.

    Only where that is unset and all is on one machine, as in tests, a temporary folder is used.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not sc.getConf().get("spark.checkpoint.dir") and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(sc.getConf().get("spark.checkpoint.dir") or tempfile.mkdtemp(prefix="ledgerloom-"))
    return sc.getConf().get("spark.checkpoint.dir") or sc._jsc.sc().getCheckpointDir().get()


#: Seconds between two collections of the driver's garbage, and when the last one was.
COLLECT_S, _COLLECTED = 0.3, [0.0]


def checkpointed(df: DataFrame) -> DataFrame:
    """df written once to the shared folder, its lineage cut.

    Shuffle files of what led to it are no longer needed, but Spark removes them only when the driver's garbage, in
    Python and in the JVM, is collected, which can be long after: so both are asked for, once in COLLECT_S seconds at most.
    """
    shared_folder(df.sparkSession)
    send_library(df.sparkSession)
    out = df.checkpoint()
    del df
    if time.monotonic() - _COLLECTED[0] >= COLLECT_S:
        gc.collect()
        out.sparkSession._jvm.System.gc()
        _COLLECTED[0] = time.monotonic()
    return out


def is_small(df: DataFrame, limit: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether df has at most so many rows and, written as JSON, bytes. No more than limit + 1 rows are looked at."""
    width = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    seen = df.select(width.alias("w")).limit(limit + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("w"), F.lit(0)).alias("bytes")).first()
    return seen["n"] <= limit and seen["bytes"] <= size


def join_checked(left: DataFrame, right: DataFrame, on, how: str = "inner", limit: int = BROADCAST_ROWS) -> DataFrame:
    """left joined with right; right is broadcast if it is small, else both are shuffled.

    right is counted and measured, so pass one whose lineage is short (a checkpoint).
    """
    return left.join(F.broadcast(right) if is_small(right, limit) else right, on, how)
