"""The corpus pipeline: toxicity, near copies, benchmark passages, mixing and shards, over whole documents.

Each stage takes (spark, docs, sf_dir), where docs is what its predecessor kept, written as Parquet and read
again, and returns the columns of documents; the last one adds the shard. Decisions take effect: rejected
documents are gone, and the others stand as often as the mix takes them.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import jaccard, leaks, mixing, sharding, toxicity
from ledgerloom.plans.common import checkpointed, join_checked, remove_folder, shared_folder, table

SHARDS = 8


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below 0.5. Labels are joined by doc_id; rows are judged one by one, so repeated rows alike; null texts score as empty ones; any other columns stay."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def _named(docs: DataFrame) -> DataFrame:
    """docs as one struct each, d, beside row, a hash of doc_id and text: rows that are equal in both are one document. So no column's name can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"), F.xxhash64("doc_id", "text").alias("row"))


def _once(marked: DataFrame, rows: DataFrame) -> DataFrame:
    """One row of marked (d, row) for each of rows (row, n), where n tells how often it stands there: of several, the least as JSON.

    Only rows that do stand there more than once are grouped.
    """
    kept = join_checked(marked, rows.filter("n = 1").select("row"), "row", "left_semi")
    several = join_checked(marked, rows.filter("n > 1").select("row"), "row", "left_semi")
    least = several.groupBy("row").agg(F.min_by("d", F.to_json("d")).alias("d"))
    return kept.unionByName(least)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by similarity 3/4 or more: the one with the smallest doc_id, a null id coming last.

    Documents are told apart by doc_id and text, so each different text is judged, also where ids repeat or lack. Rows equal in
    both are one document. Texts without words are linked with nothing. Ties of a doc_id go by a hash of the row. Any other columns stay.
    """
    marked = _named(docs)
    texts = docs.select(F.xxhash64("doc_id", "text").alias("row"), "text")
    groups = jaccard.jaccard_components(texts, key="row").select("row", "component_id").distinct()
    ids = docs.select(F.xxhash64("doc_id", "text").alias("row"), "doc_id").groupBy("row").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("n"))
    order = F.struct(F.col("id").isNull().alias("a"), F.col("id").alias("b"), F.col("row").alias("c"), F.col("n").alias("d"))
    first = groups.join(ids, "row").groupBy("component_id").agg(F.min(order).alias("k")).select(F.col("k.c").alias("row"), F.col("k.d").alias("n"))
    return _once(marked, checkpointed(first)).select("d.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an occurrence of a benchmark window. Repeated rows are judged alike; those without words stay; any other columns stay."""
    found = leaks.decontaminate(docs, table(spark, sf_dir, "benchmark")).filter("contaminated").select(F.col("row_hash").alias("row")).distinct()
    return join_checked(_named(docs), checkpointed(found), "row", "left_anti").select("d.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; one taken in part stands once more if half of it or more is taken.

    Rows that repeat a doc_id and text are one document: it stands as often as the mix takes them together. Any other columns stay.
    """
    texts = docs.select("doc_id", "source", "text", F.xxhash64("doc_id", "text").alias("row"))
    times = F.col("copies") + (2 * F.col("extra") >= F.greatest(F.col("size"), F.lit(1))).cast("long")
    plan = mixing.mix(texts, carry=("row",)).groupBy("row").agg(F.sum(times).alias("times"), F.count(F.lit(1)).alias("n"))
    plan = checkpointed(plan.filter("times > 0"))
    once = join_checked(_once(_named(docs), plan.select("row", "n")), plan.select("row", "times"), "row")
    return once.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select("d.*")


def put_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard, and the one it would have with a shard more. Rows of one doc_id share a shard, a null id being one like any other."""
    return sharding.shard(docs, SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
    ("sharding", put_in_shards),
]
#: Scores of a fitted model and links between whole sets of shingles are beyond SQL; a test holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again; what a stage has read is removed after it."""
    docs, read = table(spark, sf_dir, "documents"), None
    folder = f"{shared_folder(spark)}/pipeline-{uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if read:
            remove_folder(spark, read)
        read = f"{folder}/{name}"
    return docs
