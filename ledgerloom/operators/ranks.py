"""Order statistics of groups of any size: elements of the sorted values, found by counting and without sorting or listing a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.plans.common import checkpointed, join_checked

#: Bins of a histogram, and values of a bin that are few enough to be put in order.
BINS, FEW = 1024, 10_000


def order_statistics(rows: DataFrame, key: str, value: str, picks: dict[str, tuple[int, int]], bins: int = BINS, few: int = FEW) -> DataFrame:
    """(key, n, picks): of each key's n values those at the places n * a div b (from 0) of their order, for picks {name: (a, b)}.

    A histogram between the least and the greatest value tells in which bin a place lies; only that bin is cut again, until it
    holds one value or few rows, which are numbered. Each step counts its rows where they lie: bins are what is shuffled. Every
    bin leaves out the least or the greatest value, so steps end, whatever the values. Nulls are no values; ties are equal. rows
    is read at each step, so pass what is stored.
    """
    c = F.col
    own = rows.select(c(key), c(value).alias("__v")).filter("__v is not null")
    sizes = checkpointed(own.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi")))
    place = lambda a, b: F.least((c("n") * a / b).cast("long"), c("n") - 1)
    asked = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), place(a, b).alias("at")) for name, (a, b) in picks.items()])).alias("x")
    open_, done = sizes.select(c(key).alias("__k"), asked, "__lo", "__hi", c("n").alias("held")).select("__k", "x.name", "x.at", "__lo", "__hi", "held"), None
    half = lambda x: x.cast("double") / 2  # noqa: E731  differences of halves don't overflow
    while True:
        open_ = checkpointed(open_)
        settled = open_.filter("__lo = __hi").select("__k", "name", c("__lo").alias("v"))
        done = settled if done is None else done.unionByName(settled)
        inside = join_checked(own, open_.filter("__lo < __hi"), c(key).eqNullSafe(c("__k")), "inner").filter("__v >= __lo and __v <= __hi")
        seen = open_.filter("__lo < __hi").agg(F.count(F.lit(1)).alias("k"), F.max("held").alias("held")).first()
        if not seen["k"]:
            break
        if seen["held"] <= few:
            numbered = inside.withColumn("__r", F.row_number().over(Window.partitionBy("__k", "name").orderBy("__v")) - 1).filter(c("__r") == c("at"))
            done = done.unionByName(numbered.select("__k", "name", c("__v").alias("v")))
            break
        share = (half(c("__v")) - half(c("__lo"))) / (half(c("__hi")) - half(c("__lo")))
        # Whole numbers that are one double are told apart by their difference.
        bin_ = F.least(F.when(half(c("__hi")) > half(c("__lo")), F.floor(share * bins)).otherwise((c("__v") - c("__lo")).cast("long")), F.lit(bins - 1))
        counts = inside.groupBy("__k", "name", "at", bin_.alias("bin")).agg(F.count(F.lit(1)).alias("held"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
        upto = counts.withColumn("upto", F.sum("held").over(Window.partitionBy("__k", "name").orderBy("bin")))  # bins of one place
        open_ = upto.filter((c("upto") > c("at")) & (c("upto") - c("held") <= c("at"))).select("__k", "name", (c("at") - c("upto") + c("held")).alias("at"), "__lo", "__hi", "held")
    found = done.groupBy("__k").agg(*[F.max(F.when(c("name") == name, c("v"))).alias(name) for name in picks])
    return sizes.select(key, "n").join(found, c(key).eqNullSafe(c("__k"))).drop("__k")
