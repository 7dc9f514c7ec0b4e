"""Names of publishers: exact, folded or listed as an alias, and never guessed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.text import fold, slug


def resolve_name(df: DataFrame, column: str, dim: DataFrame, name: str, aliases: dict[str, str] | None = None) -> DataFrame:
    """df with resolved: the listed name that equals the value, else equals it folded, else is its alias; null where none does."""
    exact = dim.select(F.col(name).alias("__e")).distinct()
    folded = dim.groupBy(fold(F.col(name)).alias("__k")).agg(F.min(name).alias("__f"))
    out = df.withColumn("__q", fold(F.col(column))).join(exact, F.col(column) == F.col("__e"), "left").join(folded, F.col("__q") == F.col("__k"), "left")
    if aliases:
        known = df.sparkSession.createDataFrame(list(aliases.items()), "__a string, __t string")
        out = out.join(F.broadcast(known), F.col("__q") == F.col("__a"), "left")
    else:
        out = out.withColumn("__t", F.lit(None).cast("string"))
    return out.withColumn("resolved", F.coalesce("__e", "__f", "__t")).select(*df.columns, "resolved")


def rejected_names(resolved: DataFrame, column: str, dim: DataFrame, name: str) -> DataFrame:
    """(column, row_count, valid): names of resolve_name()'s rows that are nobody's, beside the names that there are. The list is as long as there are publishers."""
    valid = dim.select(name).distinct().agg(F.array_join(F.sort_array(F.collect_list(name)), "; ").alias("valid"))
    return resolved.filter("resolved is null").groupBy(column).agg(F.count(F.lit(1)).alias("row_count")).crossJoin(F.broadcast(valid))  # one row


def resolve_slug(df: DataFrame, column: str, dim: DataFrame, name: str, aliases: dict[str, str] | None = None) -> DataFrame:
    """df with resolved: the listed name with this slug, or the one that the slug is an alias of; else null. Of names with one slug the least."""
    known = dim.groupBy(slug(F.col(name)).alias("__s")).agg(F.min(name).alias("__n"))
    also = df.sparkSession.createDataFrame(list((aliases or {}).items()), "__a string, __t string")
    out = df.join(known, F.col(column) == F.col("__s"), "left").join(F.broadcast(also), F.col(column) == F.col("__a"), "left")  # a list given by hand
    return out.select(*df.columns, F.coalesce("__n", "__t").alias("resolved"))


def _grams(values: DataFrame, q: int) -> DataFrame:
    """(v, n, gram): runs of q letters of each folded value, its ends padded; a run's second occurrence is another gram."""
    text = F.concat(F.lit("\x01" * (q - 1)), "k", F.lit("\x02" * (q - 1)))
    cut = values.withColumn("n", F.char_length("k")).filter("n > 0").withColumn("__x", F.transform(F.sequence(F.lit(1), F.char_length(text) - q + 1), lambda i: F.substr(text, i, F.lit(q))))
    nth = F.transform("__x", lambda x, i: F.concat(x, F.size(F.filter(F.slice("__x", 1, i), lambda y: y == x)).cast("string")))  # names are short
    return cut.select("v", "n", F.explode(nth).alias("gram"))


def suggest_name(rejects: DataFrame, column: str, dim: DataFrame, name: str, n: int = 5, cutoff: float = 0.6) -> DataFrame:
    """Up to n listed names like each rejected one, by edit distance; for people to read, no row gets them.

    Names within the cutoff share a known number of runs of two letters (of one, below a cutoff of 0.5), so they meet at one of
    the rarest that each has: of its runs only as many are looked at as that takes. So pairs grow with likeness, not with
    rejects times names. Ties go by name.
    """
    q = 2 if cutoff > 0.5 else 1
    asked = rejects.select(F.col(column).alias("v")).distinct().filter("v is not null").withColumn("k", fold(F.col("v")))
    listed = dim.select(F.col(name).alias("v")).distinct().filter("v is not null").withColumn("k", fold(F.col("v")))
    left, right = _grams(asked, q), _grams(listed, q)
    often = right.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    # Of length + q - 1 runs two values share so many at least, as their distance is (1 - cutoff) of the longer one at most.
    shared = F.greatest(F.ceil(F.col("n") * (1 - q * (1 - cutoff)) + (q - 1) - 1e-9), F.lit(1))
    rank = F.row_number().over(Window.partitionBy("v").orderBy(F.coalesce("df", F.lit(0)), "gram"))
    front = lambda grams: grams.join(often, "gram", "left").withColumn("__r", rank).filter(F.col("__r") <= F.col("n") + (q - 1) - shared + 1).select("v", "gram")
    pairs = front(left).join(front(right).withColumnRenamed("v", "suggestion"), "gram").select("v", "suggestion").distinct()
    a, b = fold(F.col("v")), fold(F.col("suggestion"))
    similar = 1 - F.levenshtein(a, b) / F.greatest(F.char_length(a), F.char_length(b), F.lit(1))
    entry = pairs.filter(similar >= cutoff).withColumn("__o", (-F.floor(similar * 10000 + 0.5)).cast("long"))
    at = F.row_number().over(Window.partitionBy("v").orderBy("__o", "suggestion"))
    return entry.withColumn("rank", at).filter(F.col("rank") <= n).select(F.col("v").alias(column), "rank", "suggestion")
