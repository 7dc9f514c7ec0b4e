"""Mixing sources to target weights by hash-threshold histograms.

Each row gets a stable 60-bit hash. Tokens are summed by source and hash bucket, the bucket in which
a source's budget runs out is found, and only that bucket is summed again by the next bits. After the
last level a handful of rows stand at the boundary; all others are taken or left by comparing hashes,
so that no source is ever sorted or held in one task.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.plans.common import checkpointed, join_checked

WORD = r"[^\x20\x09-\x0D]+"
#: Fixed values of the op3 contract.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
#: Bits of the hash read at each level, from the top.
LEVEL_BITS = (10, 10, 10)
HASH_BITS = 60


def row_hash(key: Column) -> Column:
    """A 60-bit hash of a key, the same in any SQL engine with MD5. A null key counts as an empty one."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def water_fill(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """sizes (source, source_size) with target: `share` of all words, split by weight, at most `most` times a source's size.

    Sources in code point order, null last, weigh weights[0], weights[1], ... again and again. What a full
    source cannot take is shared again by weight; that ends at one water level. Sources fill in the order
    of most * size / weight, so the level is found from running sums, over one row for each source.
    """
    every = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(every) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sizes.withColumn("w", weight).withColumn("cap", F.lit(float(most)) * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("w"))
    up = Window.orderBy("ratio", F.col("source").isNull(), "source")
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    levels = ranked.select(
        "*", F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("full"), F.coalesce(F.sum("w").over(before), F.lit(0.0)).alias("used"),
        F.sum("w").over(whole).alias("all_w"), (F.lit(float(share)) * F.sum("source_size").over(whole)).alias("budget"),
    ).withColumn("level", (F.col("budget") - F.col("full")) / (F.col("all_w") - F.col("used")))
    level = levels.filter("level <= ratio").agg(F.min_by("level", "ratio").alias("level"))
    filled = ranked.crossJoin(F.broadcast(level))  # one row
    target = F.when(F.col("level").isNull() | (F.col("ratio") <= F.col("level")), F.col("cap")).otherwise(F.col("level") * F.col("w"))
    return filled.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", weights=WEIGHTS, share: float = SHARE, most: int = MOST, carry: tuple[str, ...] = ()) -> DataFrame:
    """For each of docs: key, source, size, source_size, target, copies (whole ones) and extra (words of one more, cut copy).

    size counts words; a null text has none. A source's words come to its target, rounded; the one row at
    the boundary is cut to meet it. Rows are chosen by a hash of the key, so reruns agree. Rows that
    share a key and source, or have none, however many, are taken in order of size; of rows equal in that too, order does not matter. Carried columns that bear
    the name of one of the result are left out; other columns are not read. Texts of any length are counted whole. Empty tables give empty results.
    """
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    carry = tuple(c for c in carry if c not in (key, "source", "size", "source_size", "target", "copies", "extra"))
    carried = [F.col(f"`{c}`").alias(f"__carry_{i}") for i, c in enumerate(carry)]
    rows = checkpointed(docs.select(F.col(key).alias("__key"), *carried, F.col(source).alias("source"), size.alias("size"), row_hash(F.col(key)).alias("__h"), F.spark_partition_id().alias("__part")))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = F.floor(F.col("target") + 0.5).cast("long")
    base = F.when(F.col("source_size") > 0, F.expr("goal div source_size")).otherwise(F.lit(0))
    plan = checkpointed(
        water_fill(sizes, weights, share, most).withColumn("goal", goal).withColumn("base", base)
        .withColumn("rest", F.col("goal") - F.col("base") * F.col("source_size"))
    )

    # The boundary of each source so far: hash prefix and the words below it.
    left = HASH_BITS
    edge = plan.select(F.col("source").alias("e_source"), F.lit(0).cast("long").alias("e_prefix"), F.lit(0).cast("long").alias("e_below"), F.col("rest").alias("e_rest"))
    for bits in LEVEL_BITS:
        inside = join_checked(rows, edge, F.col("source").eqNullSafe(F.col("e_source")) & (F.shiftright("__h", left) == F.col("e_prefix")))
        left -= bits
        buckets = inside.groupBy("e_source", "e_below", "e_rest", F.shiftright("__h", left).alias("e_prefix")).agg(F.sum("size").alias("n"))
        running = F.sum("n").over(Window.partitionBy("e_source").orderBy("e_prefix"))  # at most 2**bits rows
        edge = checkpointed(
            buckets.withColumn("e_below", F.col("e_below") + running - F.col("n")).filter((F.col("e_below") <= F.col("e_rest")) & (F.col("e_below") + F.col("n") > F.col("e_rest")))
            .select("e_source", "e_prefix", "e_below", "e_rest")
        )
    # A source with nothing left over has its edge at the first bucket that has words; one without words has none.
    bounded = join_checked(rows, plan.withColumnRenamed("source", "p_source"), F.col("source").eqNullSafe(F.col("p_source")), "left")
    bounded = join_checked(bounded, edge, F.col("source").eqNullSafe(F.col("e_source")), "left").withColumn("__side", F.shiftright("__h", left) - F.col("e_prefix"))
    at_edge = bounded.filter("__side = 0")  # a 2**30th of a source, and all rows that share one key
    # Rows alike in hash, key and size are counted by the part they were written in, and numbered within it, so no task orders them all.
    alike = ["source", "__h", "__key", "size", "__part"]
    lots = at_edge.groupBy(*alike).agg(F.count(F.lit(1)).alias("n"))
    below = F.coalesce(F.sum(F.col("n") * F.col("size")).over(Window.partitionBy("source").orderBy(*alike[1:]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lots = checkpointed(lots.select(*[F.col(c).alias(f"l_{c}") for c in alike], below.alias("__below")))
    at_edge = at_edge.withColumn("__i", F.row_number().over(Window.partitionBy(*alike).orderBy(F.lit(1))) - 1)
    match = [F.col(c).eqNullSafe(F.col(f"l_{c}")) for c in alike]
    met = join_checked(at_edge, lots, reduce(and_, match)).withColumn("__below", F.col("__below") + F.col("__i") * F.col("size"))
    room = F.col("rest") - F.col("e_below") - F.col("__below")
    cut = met.withColumn("extra", F.greatest(F.lit(0), F.least(F.col("size"), room)))
    others = bounded.filter("__side is null or __side <> 0").withColumn("extra", F.when(F.col("__side") < 0, F.col("size")).otherwise(F.lit(0)))
    columns = [F.col("__key").alias(key), *[F.col(f"__carry_{i}").alias(c) for i, c in enumerate(carry)], F.col("source"), F.col("size"), F.col("source_size"), F.col("target"), F.col("base").cast("long").alias("copies"), F.col("extra").cast("long").alias("extra")]
    return others.select(*columns).unionByName(cut.select(*columns))


def mix_report(docs: DataFrame) -> DataFrame:
    """The op3 contract: a row for each row of documents. Null texts and sources are cases of their own, repeated rows are taken one by one, ties of the hash in order of key and size."""
    taken = (F.col("copies") * F.col("size") + F.col("extra")).alias("taken")
    return mix(docs).select("doc_id", "size", "source_size", "target", taken)


ORACLE = """
WITH r AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM r GROUP BY source),
k AS (SELECT *, CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS DOUBLE) AS w, 2.0::DOUBLE * source_size AS cap FROM s),
q AS (SELECT *, cap / w AS ratio FROM k),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
      FROM q WINDOW b AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, CASE WHEN v IS NULL OR ratio <= v THEN cap ELSE v * w END AS target
      FROM q, (SELECT arg_min(level, ratio) AS v FROM l WHERE level <= ratio)),
g AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS goal, CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END AS base FROM t),
c AS (SELECT r.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM r)
SELECT c.doc_id, c.size, g.source_size, g.target,
       CAST(base * c.size + greatest(0, least(c.size, goal - base * g.source_size - below)) AS BIGINT) AS taken
FROM c JOIN g ON c.source IS NOT DISTINCT FROM g.source
"""
