"""Label search without regard to accents: an inverted index of folded tokens, ranked by breadth."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.text import ACCENTED, PLAIN, fold, indicator_clean
from ledgerloom.operators.order import RANGE_ROWS, placed
from ledgerloom.plans.common import checkpointed


def search_index(rows: DataFrame, label: str, table: str, publisher: str) -> tuple[DataFrame, DataFrame]:
    """(stats, tokens): breadth of each (label, table), and the folded tokens of each label. Labels are folded once each, after counting."""
    stats = rows.groupBy(F.col(label).alias("label"), F.col(table).alias("form")).agg(F.count(F.lit(1)).alias("row_count"), F.countDistinct(publisher).alias("provinces"))
    tokens = stats.select("label", "form", F.explode(F.array_distinct(F.split(fold(F.col("label")), r"[^\p{L}\p{N}]+"))).alias("token")).filter("token <> ''")
    return stats, tokens


def query_tokens(query: str) -> list[str]:
    """Folded tokens of a query, which is data and never syntax."""
    low = "".join(c for c in unicodedata.normalize("NFD", query.translate(str.maketrans(ACCENTED, PLAIN))) if not unicodedata.combining(c)).lower()
    return [t for t in re.split(r"[\W_]+", low) if t]


def search_tokens(tokens: DataFrame, query: str) -> DataFrame:
    """(label, form) that have all tokens; the last one also as a beginning, from three letters. No tokens: nothing."""
    words = query_tokens(query)
    if not words:
        return tokens.select("label", "form").limit(0)
    last = words[-1]
    hit = F.when(F.col("token").isin(words), F.col("token"))
    hit = F.when(F.col("token").startswith(last), F.lit(last)).otherwise(hit) if len(last) >= 3 else hit
    # A token that is a query word and begins with the last one counts for both.
    both = F.array_distinct(F.array_compact(F.array(hit, F.when(F.col("token").isin(words), F.col("token")))))
    found = tokens.select("label", "form", F.explode(both).alias("word"))
    return found.groupBy("label", "form").agg(F.countDistinct("word").alias("k")).filter(F.col("k") == len(set(words))).select("label", "form")


def find_indicators(index: tuple[DataFrame, DataFrame], query: str, form: str | None = None, min_provinces: int = 1, limit: int = 15) -> DataFrame:
    """Matching labels by publishers, then rows, then name; limit is held to 1 to 50."""
    stats, tokens = index
    found = stats.join(search_tokens(tokens, query), ["label", "form"]).filter(F.col("provinces") >= min_provinces)
    found = found if form is None else found.filter(F.col("form") == form)
    return found.orderBy(F.desc("provinces"), F.desc("row_count"), "label", "form").limit(max(1, min(50, limit)))


def find_forms(rows: DataFrame, query: str, title: str, publisher: str, limit: int = 10) -> DataFrame:
    """Forms whose title matches, by publishers, then rows."""
    stats, tokens = search_index(rows.withColumn("__one", F.lit("")), title, "__one", publisher)
    return find_indicators((stats, tokens), query, limit=limit).select(F.col("label").alias("title"), "provinces", "row_count")


# A stored index ---------------------------------------------------------------------------------------

#: Folders of the postings; a token's is found from its first letters, so that beginnings are found there as well.
BUCKETS, HEAD = 64, 3
#: Labels of one folder of the statistics: many, as each folder is listed, opened and moved by itself; within one, files are in order of ids.
PART = 1 << 18


def label_stats(rows: DataFrame, label: str, table: str, publisher: str, year: str, vnd: str) -> DataFrame:
    """(label, form, row_count, provinces, convertible, first_year, last_year): breadth of each label in each form, in one grouping."""
    return rows.groupBy(F.col(label).alias("label"), F.col(table).alias("form")).agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct(publisher).alias("provinces"), F.count(vnd).alias("convertible"), F.min(year).cast("int").alias("first_year"), F.max(year).cast("int").alias("last_year")
    )


def star_stats(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """label_stats() of a star: grouped by ids, texts joined to what is left."""
    named = lambda n, **more: dims[n].select(F.col("id").alias(f"{n}_id"), *[F.col(b).alias(a) for a, b in more.items()])
    wide = fact.join(named("period", year="year"), "period_id").join(named("unit", factor="factor"), "unit_id")
    vnd = F.when(F.col("value").isNotNull() & (F.col("factor") > 0), 1)
    ids = wide.groupBy("indicator_id", "table_id").agg(F.count(F.lit(1)).alias("row_count"), F.collect_set("province_id").alias("p"), F.count(vnd).alias("convertible"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))
    texts = ids.join(named("indicator", label="label"), "indicator_id").join(named("table", form="form_code"), "table_id")
    # Tables of one form code are one form here; sets of publishers are short and merge.
    return texts.groupBy("label", "form").agg(F.sum("row_count").alias("row_count"), F.size(F.array_distinct(F.flatten(F.collect_list("p")))).cast("long").alias("provinces"), F.sum("convertible").alias("convertible"), F.min("first_year").alias("first_year"), F.max("last_year").alias("last_year"))


def _bucket(token: Column) -> Column:
    return F.pmod(F.xxhash64(F.substring(token, 1, HEAD)), F.lit(BUCKETS)).cast("int")


def store_index(stats: DataFrame, path: str) -> None:
    """Writes label_stats() as an index: stats with an id and the clean label, and postings (token, id, what ranks it) by bucket.

    Ids follow label and form, so they break ties as labels do. Tokens are those of the clean label, or of the label where
    cleaning leaves nothing. Postings of a frequent token lie in one folder, in several files.
    """
    at = placed(checkpointed(stats.withColumn("__all", F.lit(0))), "__all", [F.col("label"), F.col("form")], RANGE_ROWS)
    clean = indicator_clean(F.col("label"))
    full = at.select(F.col("pos").alias("id"), "label", F.coalesce(F.nullif(clean, F.lit("")), "label").alias("clean"), "form", "row_count", "provinces", "convertible", "first_year", "last_year", F.expr(f"cast(pos div {PART} as int)").alias("part"))
    full = checkpointed(full)
    full.repartitionByRange("part", "id").sortWithinPartitions("part", "id").write.mode("overwrite").partitionBy("part").parquet(f"{path}/stats")
    token = F.explode(F.array_distinct(F.split(fold(F.col("clean")), r"[^\p{L}\p{N}]+")))
    postings = full.select(token.alias("token"), "id", "form", "provinces", "row_count").filter("token <> ''").withColumn("bucket", _bucket(F.col("token")))
    dealt = postings.hint("rebalance", "bucket").sortWithinPartitions("bucket", "token", "id")  # folders of frequent tokens are split by their size
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")


def open_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(stats, postings) of a stored index. Folders are listed here, once for all questions asked of it."""
    stats = "id long, label string, clean string, form string, row_count long, provinces long, convertible long, first_year int, last_year int, part int"
    return spark.read.schema(stats).parquet(f"{path}/stats"), spark.read.schema("token string, id long, form string, provinces long, row_count long, bucket int").parquet(f"{path}/postings")


def postings_of(index: tuple[DataFrame, DataFrame], words: list[str]) -> DataFrame:
    """(id, form, provinces, row_count) of the labels that have all words; the last one also as a beginning, from HEAD letters. Only the words' folders are read."""
    last = words[-1]
    there = F.col("bucket").isin([_bucket(F.lit(w)) for w in sorted({w[:HEAD] for w in words})])
    exact = F.col("token").isin(sorted(set(words)))
    begins = F.col("token").startswith(last) if len(last) >= HEAD else F.lit(False)
    rows = index[1].filter(there & (exact | begins))
    # A token that is one word and begins with the last one counts for both.
    hit = F.array_distinct(F.array_compact(F.array(F.when(exact, F.col("token")), F.when(begins, F.lit(last)))))
    found = rows.select("id", "form", "provinces", "row_count", F.explode(hit).alias("word"))
    return found.groupBy("id", "form", "provinces", "row_count").agg(F.countDistinct("word").alias("k")).filter(F.col("k") == len(set(words))).drop("k")


def find_stored(index: tuple[DataFrame, DataFrame], query: str, form: str | None = None, min_provinces: int = 1, limit: int = 15) -> DataFrame:
    """find_indicators() from a stored index: postings of the query's tokens are ranked, and the statistics of the best few looked up.

    The ids of the answer, 50 at most, pass through the driver. A query without tokens finds nothing.
    """
    words, stats = query_tokens(query), index[0]
    shown = ["label", "clean", "form", "row_count", "provinces", "convertible", "first_year", "last_year"]
    if not words:
        return stats.select(shown).limit(0)
    found = postings_of(index, words).filter(F.col("provinces") >= min_provinces)
    found = found if form is None else found.filter(F.col("form") == form)
    best = [r["id"] for r in found.orderBy(F.desc("provinces"), F.desc("row_count"), "id").select("id").limit(max(1, min(50, limit))).collect()]
    own = stats.filter(F.col("part").isin(sorted({i // PART for i in best})) & F.col("id").isin(best))
    return own.orderBy(F.desc("provinces"), F.desc("row_count"), "id").select(shown)
