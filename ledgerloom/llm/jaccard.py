"""N-gram Jaccard join by PartEnum signatures (Arasu, Ganti and Kaushik, 2006).

Sets of hashed five-word shingles link at similarity 3/4: sets of sizes a and b then differ in at most (a + b) / 7
features. Sizes are cut into bands, each reaching to 4/3 of its start. For a band, k features may differ, and the
domain of the hash is partitioned into k / 2 + 1 ranges and a few more, each into three parts. So some range of two
similar sets differs in one feature at most, that is in one part: the subset of its two other parts is equal.
Each set enumerates, in its own band and in the one below, the subsets of two parts of every range as signatures.

The join has these steps. None holds a group in one task, and the number of pairs that a step makes is bounded
by the number of sets in all but the last:

1. Equal sets are one class from here on, under a 128-bit name.
2. A set shares three quarters of its features with any partner. By a prefix of its features in the order of their
   hashes it shares a known number of them with other classes, or it has no partner and is left out.
3. Of the classes that share a signature the most central one, whose features are the most frequent, is the centre of
   that signature. Each class is verified against the one centre with which it shares the most signatures.
   Before that, the few least features serve as cheap signatures in the same way: most near copies of one
   document are one component from then on, and their signatures need no more rows.
4. Signatures whose classes are all of one component are done, and classes that share fewer than any partner would. The others go on. Near the
   threshold two sets share hundreds of signatures, so what is still apart meets at the finest partition, where each feature
   is a range of its own: at the rarest features that are also in other components, as many as guarantee a shared one, and
   only where sizes, and counts of shared features by ranges of the hash, allow a link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.graph import components
from ledgerloom.llm.words import U, hashed_words, long_lists, mix, pieces
from ledgerloom.plans.common import checkpointed, join_checked

SHINGLE = 5
#: One more shared prefix feature is asked for every so many features.
SPARE = 16
#: Least features that serve as first signatures.
LEAST = 8
#: Ranges of the hash by which shared features are counted before pairs are made.
SLICES = 64
_STEP = U(0x9E3779B97F4A7C15)


def feature_lists(texts: pa.Array, k: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of the k-word shingles of each text. Fewer words than k are one shingle; none, no shingle."""
    h, counts, *_ = hashed_words(pc.ascii_lower(texts))
    ends = np.cumsum(counts)
    rolled = h[: max(len(h) - k + 1, 0)] * _STEP
    for i in range(1, k):
        rolled = mix(rolled + h[i : len(h) - k + 1 + i]) * _STEP
    rolled = mix(rolled + U(k))
    out = []
    for end, n in zip(ends.tolist(), counts.tolist(), strict=True):
        if n >= k:
            f = np.sort(rolled[end - n : end - k + 1])
            out.append(f[np.concatenate(([True], f[1:] != f[:-1]))])
        elif n:
            x = h[end - n : end - n + 1] * _STEP
            for i in range(1, n):
                x = mix(x + h[end - n + i : end - n + i + 1]) * _STEP
            out.append(mix(x + U(n)))
        else:
            out.append(np.empty(0, U))
    return out


def _spare(size: int) -> int:
    return 1 + size // SPARE


def prefix(size: int) -> int:
    """Features from the front of one order by which `need` shared ones are seen: a quarter may be missing in a partner."""
    return min(size, size - -(-3 * size // 4) + _spare(size))


def need(size: int) -> int:
    """Shared features in the prefix of a set that has a partner, which has three quarters of its size at least."""
    return _spare(-(-3 * size // 4))


def band(size: int) -> tuple[int, int, int]:
    """(number, least size, largest size) of the band of a size. A band reaches to 4/3 of its start."""
    at, low = 0, 1
    while (high := 4 * low // 3) < size:
        at, low = at + 1, high + 1
    return at, low, high


_BANDS: dict[int, list[tuple[int, int]]] = {}


def tags(size: int) -> list[tuple[int, int]]:
    """(band, k) for the bands in which a set takes part: its own and, if a smaller partner can be there, the one below.

    Pairs meet in the smaller set's band. k features may differ there: the sum of both sizes by 7, the larger being 4/3 of the smaller at most.
    """
    if size not in _BANDS:
        at, low, high = band(size)
        own = [(at, (high + 4 * high // 3) // 7)]
        if low > 1 and -(-3 * size // 4) < low:
            own.append((at - 1, (low - 1 + 4 * (low - 1) // 3) // 7))
        _BANDS[size] = own
    return _BANDS[size]


def signatures(features: np.ndarray) -> tuple[np.ndarray, int]:
    """(signatures, asked): in each of the set's bands, every subset of two of the three parts of every range; how many of them any partner shares.

    Of k / 2 + 1 + m ranges, m + 1 have at most one differing feature, so a signature of theirs is shared. Subsets without features
    say little and are left out, so where h ranges have one, m + 1 - h are shared. A set in which more than m ranges have one
    enumerates them all; a partner may still leave its own out, so one signature is all that can be asked for then.
    """
    out, asked = [], len(features)
    high, mixed = features >> U(32), mix(features + _STEP)
    for tag, k in tags(len(features)):
        if not k:
            continue  # only equal sets could meet
        more = (k // 2 + 1) // 4 + 1
        ranges = k // 2 + 1 + more
        part = ((high * U(3 * ranges)) >> U(32)).astype(np.int64)
        starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        sums = np.zeros(3 * ranges, U)
        sums[part[starts]] = np.add.reduceat(mixed, starts)
        full = np.zeros(3 * ranges, bool)
        full[part[starts]] = True
        sums, full = sums.reshape(-1, 3), full.reshape(-1, 3)
        place = np.arange(3 * ranges, dtype=U).reshape(-1, 3) + U((tag + 1) << 40)
        sigs = mix(mix(np.roll(sums, 1, 1) + np.roll(sums, 2, 1)) + place * _STEP)
        filled = np.roll(full, 1, 1) | np.roll(full, 2, 1)
        hollow = int((~filled).any(1).sum())
        out.append(sigs.ravel() if hollow > more else sigs[filled])
        asked = min(asked, 1 if hollow > more else more + 1 - hollow)
    return np.concatenate(out) if out else np.empty(0, U), asked


def measure(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, th, n, a, b, front): of each row the text's hash, the set's size, its 128-bit name in two halves and its prefix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 2):
                sets = feature_lists(piece.column(2))
                names = np.frombuffer(b"".join(xxhash.xxh128_digest(s) for s in sets), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(names[:, 0]), pa.array(names[:, 1]), long_lists([s[: prefix(len(s))] for s in sets])],
                    names=["key", "th", "n", "a", "b", "front"],
                )

    rows = docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("th"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "key long, th long, n long, a long, b long, front array<bigint>")


def enumerate_sets(texts: DataFrame) -> DataFrame:
    """(id, score, n, features, sigs, asked) of texts (id, score, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 2):
                sets = feature_lists(piece.column(2))
                found = [signatures(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), pa.array([len(s) for s in sets], pa.int64()), long_lists(sets), long_lists([f[0] for f in found]), pa.array([f[1] for f in found], pa.int64())],
                    names=["id", "score", "n", "features", "sigs", "asked"],
                )

    return texts.select("id", "score", "text").mapInArrow(run, "id long, score double, n long, features array<bigint>, sigs array<bigint>, asked long")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) of classes that link: 100 * intersection >= 75 * union, which is 7 * intersection >= 3 * both sizes."""
    a = sets.select(F.col("id").alias("u"), F.col("features").alias("fu"), F.col("n").alias("nu"))
    b = sets.select(F.col("id").alias("v"), F.col("features").alias("fv"), F.col("n").alias("nv"))
    centres = join_checked(a, pairs.select("u").distinct(), "u", "left_semi")
    both = join_checked(b, pairs, "v").join(centres, "u").filter("4 * nu >= 3 * nv and 4 * nv >= 3 * nu")
    return both.filter(7 * F.size(F.array_intersect("fu", "fv")) >= 3 * (F.col("nu") + F.col("nv"))).select("u", "v")


def _rooted(df: DataFrame, links: DataFrame) -> DataFrame:
    """df with root, the component of its id by links so far."""
    parts = components(links).withColumnRenamed("node", "id")
    return join_checked(df, parts, "id", "left").withColumn("root", F.coalesce("root", "id"))


def _best(met: DataFrame, least: str) -> DataFrame:
    """For each id of (id, centre, asked) the centre that it met most often, as (u, v), where it met it `least` times: rarer meetings are left to the last step."""
    often = met.groupBy("id", "centre").agg(F.count(F.lit(1)).alias("k"), F.max("asked").alias("asked")).filter(least)
    return checkpointed(often.groupBy("id").agg(F.max_by("centre", "k").alias("u")).select("u", F.col("id").alias("v")))


def _apart(rows: DataFrame, on: str) -> DataFrame:
    """The values of a column that rows (on, root) of different components have."""
    return rows.groupBy(on).agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select(on)


def with_partners(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """classes that can have a partner, with score: how frequent the features of their prefix are."""
    front = rows.select("rid", F.explode("front").alias("f"))
    often = front.groupBy("f").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    # Features are counted over all rows; copies of one class don't make it share a feature.
    hits = front.join(often, "f").join(classes.select(F.col("id").alias("rid"), "n", "copies"), "rid").filter("df > copies")
    able = hits.groupBy("rid", "n").agg(F.count(F.lit(1)).alias("hit"), F.sum("df").alias("mass")).filter(F.expr(f"hit >= 1 + ((3 * n + 3) div 4) div {SPARE}"))
    return classes.join(checkpointed(able.select(F.col("rid").alias("id"), (F.col("mass") / F.col("n")).alias("score"))), "id")


def candidates(sets: DataFrame, open_: DataFrame) -> DataFrame:
    """Pairs (u, v) of open classes (id, root) of different components that may link, from the features they share."""
    spread = join_checked(sets.select("id", "n", "features"), open_, "id").select("id", "n", "root", F.explode("features").alias("f"))
    met = spread.groupBy("f").agg(F.count(F.lit(1)).alias("df"), F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("f", "df")
    shared = checkpointed(spread.join(met, "f"))
    at = F.shiftrightunsigned("f", 64 - (SLICES - 1).bit_length()).cast("int").alias("at")
    by_slice = shared.groupBy("id", at).agg(F.count(F.lit(1)).cast("int").alias("k"))
    filled = by_slice.groupBy("id").agg(F.sum("k").alias("c"), F.map_from_entries(F.collect_list(F.struct("at", "k"))).alias("by"))  # SLICES entries at most
    counted = checkpointed(filled.select("id", "c", F.transform(F.sequence(F.lit(0), F.lit(SLICES - 1)), lambda i: F.coalesce(F.try_element_at("by", i), F.lit(0))).alias("slices")))
    rank = F.row_number().over(Window.partitionBy("id").orderBy("df", "f"))  # one set's features
    able = join_checked(shared, counted.select("id", "c"), "id").filter("4 * c >= 3 * n").withColumn("rank", rank)
    # A partner's size decides what is missing at most: the smaller set shares 6/7 of its features, the larger 3/4.
    front = able.filter("rank <= c - (3 * n + 3) div 4 + 1").withColumn("small", F.expr("rank <= c - (6 * n + 6) div 7 + 1"))
    front = checkpointed(join_checked(front, counted.select("id", "slices"), "id"))
    side = lambda x, df: df.select("f", *[F.col(c).alias(f"{c}_{x}") for c in ("id", "n", "root", "c", "rank", "slices")])
    sizes = F.expr("root_u <> root_v and (n_u < n_v or n_u = n_v and id_u < id_v) and 4 * n_u >= 3 * n_v")
    # The first feature of both that they share has enough features after it in either.
    places = F.expr("7 * least(c_u - rank_u + 1, c_v - rank_v + 1) >= 3 * (n_u + n_v)")
    most = F.aggregate(F.zip_with("slices_u", "slices_v", lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y)
    met = side("u", front.filter("small")).join(side("v", front), "f").filter(sizes & places & (7 * most >= F.expr("3 * (n_u + n_v)")))
    return met.select(F.col("id_u").alias("u"), F.col("id_v").alias("v")).distinct()


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each of docs: key, n_shingles, component_id, the smallest key reachable by links of similarity 3/4 or more.

    Texts are lower-cased in A-Z and cut at whitespace, whatever their length. Null texts and those without words have no
    shingles, link with nothing and are components of their own. Rows that repeat a key are judged one by one, each by its
    own text; null keys stay null and count as no one's smallest. Keys are 64-bit numbers. Ties do not matter: any order
    gives the same components. Other columns, whatever their names and types, are not read. Empty tables give empty results.
    """
    rows = checkpointed(measure(docs, key, text).withColumn("rid", F.monotonically_increasing_id()))
    named = rows.filter("n > 0").groupBy("a", "b", "n").agg(F.min("rid").alias("id"), F.count(F.lit(1)).alias("copies"), F.min("key").alias("least"), F.min_by("th", "rid").alias("th"), F.min_by("key", "rid").alias("key"))
    classes = checkpointed(named)
    del named
    reps = checkpointed(with_partners(rows, classes).select(F.col("id"), "score", F.col("th").alias("__th"), F.col("key").alias("__rep")))
    rows = checkpointed(rows.select("key", "n", "a", "b"))  # the prefixes, most of what was kept, are free to go

    # Texts are found again by their hash and key; rows that repeat both are one.
    body = docs.select(F.col(key).cast("long").alias("__key"), F.col(text).cast("string").alias("text"), F.xxhash64(text).alias("__t"))
    found = join_checked(body, reps, (F.col("__t") == F.col("__th")) & F.col("__key").eqNullSafe(F.col("__rep")))
    sets = checkpointed(enumerate_sets(found.groupBy("id").agg(F.first("score").alias("score"), F.first("text").alias("text"))))

    least = sets.select("id", "score", F.lit(LEAST).alias("asked"), F.explode(F.slice("features", 1, LEAST)).alias("f"))
    centre = least.groupBy("f").agg(F.max_by("id", "score").alias("centre"), F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo <> hi").select("f", "centre")
    links = checkpointed(_verified(_best(least.join(centre, "f").filter("id <> centre"), "k >= 3"), sets))

    rooted = checkpointed(_rooted(sets.select("id", "score", "asked"), links))
    spread = join_checked(sets.select("id", "sigs"), rooted, "id")
    apart = _apart(spread.select("root", F.explode("sigs").alias("sig")), "sig")
    shared = spread.select("id", F.explode("sigs").alias("sig")).join(apart, "sig")
    enough = shared.join(rooted, "id").groupBy("id", "root", "score", "asked").agg(F.collect_list("sig").alias("sigs")).filter("size(sigs) >= asked")
    enough = checkpointed(enough)  # one set's signatures in a row
    spread = enough.select("id", "root", "score", "asked", F.explode("sigs").alias("sig"))
    centre = spread.groupBy("sig").agg(F.max_by("id", "score").alias("centre"), F.max_by("root", "score").alias("at"))
    links = checkpointed(links.union(_verified(_best(spread.join(centre, "sig").filter("root <> at"), "k >= asked"), sets)))

    rooted = checkpointed(_rooted(enough.select("id", "asked"), links))
    spread = join_checked(enough.select("id", "sigs"), rooted, "id").select("id", "root", "asked", F.explode("sigs").alias("sig"))
    again = spread.join(_apart(spread, "sig"), "sig").groupBy("id", "root", "asked").agg(F.count(F.lit(1)).alias("k"))
    open_ = checkpointed(again.filter("k >= asked").select("id", "root"))
    links = links.union(_verified(checkpointed(candidates(sets, open_)), sets))

    part = checkpointed(_rooted(classes.select("id", "a", "b", "least"), links))
    smallest = checkpointed(part.groupBy("root").agg(F.min("least").alias("component_id")))  # so that the join deals both sides anew, and can split a large component
    member = checkpointed(part.join(smallest, "root").select("a", "b", "component_id"))
    # Rows without words have the name of the empty set, which is no class; their own keys spread them over the join.
    out = rows.select("key", "n", F.when(F.col("n") > 0, F.col("a")).otherwise(F.xxhash64("key")).alias("a"), F.when(F.col("n") > 0, F.col("b")).alias("b"))
    return join_checked(out, member, ["a", "b"], "left").select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "key").alias("component_id"))
