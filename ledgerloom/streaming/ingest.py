"""Incremental ingest: a landed file is processed once, however often the job runs, and parsed as it arrives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.longrows import long_table, parsed_rows
from ledgerloom.plans.common import checkpointed
from ledgerloom.sources.files import decode_grids, decode_xml

_FILES = "path string, modificationTime timestamp, length long, content binary"


def _stream(spark: SparkSession, source: str, glob: str, most: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(_FILES).format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    return (reader if most is None else reader.option("maxFilesPerTrigger", most)).load(source)


def ingest_incremental(spark: SparkSession, source: str, sink: str, checkpoint: str, glob: str = "*") -> None:
    """Appends sha256 and size of files that are new since the last run; the stream's checkpoint knows the others."""
    rows = _stream(spark, source, glob).select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))
    rows.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def ingest_forms(spark: SparkSession, source: str, sink: str, checkpoint: str, files: DataFrame, reports: DataFrame, most: int = 1000, glob: str = "*.[xX][mMlL][lLsS]*") -> None:
    """Parses forms and workbooks that are new since the last run into long rows under sink, and notes the files that can't be read.

    files (path, report_id, url) and reports are the catalog as it is now; a file that it does not name has no rows. Each batch
    has a folder of its own, named by its number and replaced as a whole, so a batch that was cut off and runs again leaves no
    rows twice. ingested() reads what is there; long_of() makes the table of it.
    """
    def land(batch: DataFrame, number: int) -> None:
        landed = batch.select("path", "content")
        tags, cells = checkpointed(decode_xml(landed)), checkpointed(decode_grids(landed))  # else each of many readings decodes the files again
        parsed_rows(tags, cells, files, reports).write.mode("overwrite").parquet(f"{sink}/rows/batch={number}")
        failed = tags.select("path", "error").unionByName(cells.select("path", "error")).filter("error is not null")
        failed.write.mode("overwrite").parquet(f"{sink}/failed/batch={number}")

    _stream(spark, source, glob, most).writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def ingested(spark: SparkSession, sink: str, what: str = "rows") -> DataFrame:
    """Rows of all batches, or with what = failed the files that could not be read."""
    return spark.read.parquet(f"{sink}/{what}").drop("batch")


def long_of(spark: SparkSession, sink: str) -> DataFrame:
    """long_table() of all that was ingested. It depends on the files alone, not on the batches in which they came."""
    return long_table(ingested(spark, sink))


def new_files(listed: DataFrame, done: DataFrame) -> DataFrame:
    """The same in batch: files whose path and digest have not been seen."""
    return listed.join(done, ["path", "sha256"], "left_anti")
