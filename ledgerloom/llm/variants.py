"""Spelling variants by a trie of letter-group counts, and the commonest form of each word.

A word is its length and the number of its letters in each of GROUPS groups. One edit changes these counts by a surplus of one
at most and a deficit of one at most, so words are arranged in a trie by their counts, one after the other, and a
depth-first search from a word spends a budget of one surplus and one deficit on its way down. What it reaches is verified
letter by letter. Every pair is looked for from one side only: from the longer word, which has a deficit to spend, or, of
two words of equal length, from the one whose surplus comes first, or the lesser one if their counts are the same.

The trie's upper part is a table: a node of more than PAGE words is split by the next count, until each is a page that a task
can hold. Words descend it in joins, a few children a word, and the search goes on inside the pages that they reach.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.merkle import CRC_OF, CRC_TABLE
from ledgerloom.plans.common import checkpointed, join_checked

#: Letters fall into so many groups, by their code points' remainder.
GROUPS = 16
#: Words that a page of the trie holds at most, and searches that one task does in it.
PAGE, SEARCHES = 20_000, 80_000
#: Words of a node that are compared at once, and pairs that are looked at together.
LEAF, PAIRS = 16, 1 << 18
LEAST_LENGTH, LEAST_COUNT, FORM_FACTOR, DAMAGE = 7, 2, 10, 31
LEVELS = GROUPS + 1

# What a search has spent: nothing yet at the root; of words as long nothing, the surplus, both; of words shorter by one nothing, the deficit.
_ROOT, _EQUAL, _MORE, _BOTH, _SHORT, _LESS = range(6)
#: By what is spent: (change of the next count, what is spent then).
_STEPS = {_ROOT: ((0, _EQUAL), (-1, _SHORT)), _EQUAL: ((0, _EQUAL), (1, _MORE)), _MORE: ((0, _MORE), (-1, _BOTH)), _BOTH: ((0, _BOTH),), _SHORT: ((0, _SHORT), (-1, _LESS)), _LESS: ((0, _LESS),)}
#: The same as a table: [spent, change + 2], where changes beyond one are held to two; -1 where there is no way.
_NEXT = np.full((6, 5), -1, np.int8)
for _spent, _ways in _STEPS.items():
    for _change, _then in _ways:
        _NEXT[_spent, _change + 2] = _then
_ENDS = np.isin(np.arange(6), (_EQUAL, _BOTH, _LESS))


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): words of all texts, some of them damaged by one letter, with LEAST_LENGTH letters and LEAST_COUNT occurrences at least."""
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.explode(F.regexp_extract_all(F.col(text).cast("string"), F.lit(f"[A-Za-zÀ-ÿ]{{{LEAST_LENGTH},}}"), F.lit(0))).alias("run"))
    upper = "".join(map(chr, range(65, 91)))
    low = runs.select("key", F.translate("run", upper, upper.lower()).alias("w")).withColumn("h", F.crc32(F.concat("key", F.lit(":"), "w")))
    at = (F.col("h") % F.char_length("w")).cast("int")
    word = F.when(F.col("h") % DAMAGE == 0, F.concat(F.col("w").substr(F.lit(1), at), F.col("w").substr(at + 2, F.char_length("w")))).otherwise(F.col("w"))
    kept = low.select(word.alias("word")).filter(F.char_length("word") >= LEAST_LENGTH)
    return kept.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_COUNT)


class Words:
    """Words of one page or of searches in it: letters in one array, counts in one table."""

    def __init__(self, words: list[str]):
        raw = [w.encode("latin-1") for w in words]  # all letters are below 256
        self.words, self.sizes = words, np.array([len(w) for w in raw], np.int64)
        self.letters = np.frombuffer(b"".join(raw), np.uint8)
        self.starts = np.cumsum(self.sizes) - self.sizes
        own = np.repeat(np.arange(len(raw)), self.sizes) * GROUPS + self.letters % GROUPS
        self.counts = np.column_stack((self.sizes, np.bincount(own, minlength=len(raw) * GROUPS).reshape(-1, GROUPS))).astype(np.int32)

    def rows(self, at: np.ndarray, size: int) -> np.ndarray:
        return self.letters[self.starts[at][:, None] + np.arange(size)]


def _near(a: Words, b: Words, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of words differ by one edit: equal lengths by one letter, others by one letter that b's word lacks."""
    out = np.zeros(len(i), bool)
    for size in np.unique(a.sizes[i]).tolist():
        own = np.flatnonzero(a.sizes[i] == size)
        step = max(1, (PAIRS * 32) // size)
        for at in (own[k : k + step] for k in range(0, len(own), step)):
            same = b.sizes[j[at]] == size
            if len(x := at[same]):
                out[x] = (a.rows(i[x], size) != b.rows(j[x], size)).sum(1) == 1
            if len(x := at[~same]):
                long, short = a.rows(i[x], size), b.rows(j[x], size - 1)
                front = np.logical_and.accumulate(long[:, :-1] == short, 1).sum(1)
                back = np.logical_and.accumulate((long[:, 1:] == short)[:, ::-1], 1).sum(1)
                out[x] = front + back >= size - 1
    return out


def search(page: Words, asked: Words) -> tuple[np.ndarray, np.ndarray]:
    """(i, j): pairs of an asked word and a word of the page that are near, by depth-first search; the page's words in order of their counts."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    tree, counts = page.counts, asked.counts

    def verify(low: int, high: int, depth: int, who: np.ndarray, spent: np.ndarray) -> None:
        step = max(1, PAIRS // (high - low))
        for k in range(0, len(who), step):
            some = who[k : k + step]
            i, j = np.repeat(some, high - low), np.tile(np.arange(low, high), len(some))
            left = np.repeat(spent[k : k + step], high - low)
            for level in range(depth, LEVELS):
                left = _NEXT[left, np.clip(tree[j, level] - counts[i, level], -2, 2) + 2]
                kept = left >= 0
                i, j, left = i[kept], j[kept], left[kept]
            kept = _ENDS[left]
            i, j = i[kept], j[kept]
            kept = _near(asked, page, i, j)
            found.append((i[kept], j[kept]))

    def descend(low: int, high: int, depth: int, who: np.ndarray, spent: np.ndarray) -> None:
        if high - low <= LEAF or depth == LEVELS:
            verify(low, high, depth, who, spent)
            return
        column = tree[low:high, depth]
        cuts = [0, *(np.flatnonzero(column[1:] != column[:-1]) + 1).tolist(), high - low]
        mine = counts[who, depth]
        for a, b in zip(cuts, cuts[1:], strict=False):
            then = _NEXT[spent, np.clip(column[a] - mine, -2, 2) + 2]
            kept = then >= 0
            if kept.any():
                descend(low + a, low + b, depth + 1, who[kept], then[kept])

    if len(page.words) and len(asked.words):
        descend(0, len(page.words), 0, np.arange(len(asked.words)), np.full(len(asked.words), _ROOT, np.int8))
    i, j = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 2
    # Words with the same counts find each other: one of the two is enough.
    twice = (asked.counts[i] == page.counts[j]).all(1)
    kept = np.array([not t or asked.words[a] < page.words[b] for t, a, b in zip(twice.tolist(), i.tolist(), j.tolist(), strict=True)], bool)
    return i[kept], j[kept]


def _best(own: Words, at: np.ndarray, other: Words, near: np.ndarray, n: np.ndarray) -> pa.Table:
    """(word, k, form_n, form): of each word that has pairs their number, and of the near words the one of largest n, of several the least."""
    rank = np.empty(len(n), np.int64)
    rank[sorted(range(len(n)), key=lambda x: (-n[x], other.words[x]))] = np.arange(len(n))
    order = np.lexsort((rank[near], at))
    first = np.flatnonzero(np.concatenate(([True], at[order][1:] != at[order][:-1]))) if len(order) else np.empty(0, np.int64)
    who, form = at[order][first], near[order][first]
    return pa.table({"word": pa.array([own.words[x] for x in who], pa.string()), "k": np.diff(np.concatenate((first, [len(order)]))).astype(np.int64), "form_n": n[form].astype(np.int64), "form": pa.array([other.words[x] for x in form], pa.string())})


def _in_page(page: pa.Table, asked: pa.Table) -> pa.Table:
    words, tried = Words(page["held"].to_pylist()), Words(asked["word"].to_pylist())
    order = np.lexsort(words.counts.T[::-1])
    words, n, m = Words([words.words[x] for x in order]), page["times"].to_numpy()[order], asked["n"].to_numpy()
    i, j = search(words, tried)
    return pa.concat_tables([_best(tried, i, words, j, n), _best(words, j, tried, i, m)])


def _counts(words: DataFrame) -> DataFrame:
    """words with counts, as the trie has them."""
    def run(batches):
        for batch in batches:
            table = Words(batch.column(0).to_pylist()).counts
            lists = pa.ListArray.from_arrays(np.arange(0, table.size + 1, LEVELS, dtype=np.int32), table.ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["word", "n", "counts"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, counts array<int>")


def _steps(level: int) -> Column:
    """The children of a node at a level to which a search may go on."""
    count = F.col("counts")[level]
    to = lambda change, then: F.struct(F.concat_ws(".", "path", (count + change).cast("string")).alias("path"), F.lit(then).alias("spent"))
    out = F.when(F.lit(False), F.array(to(0, 0)))
    for spent, ways in _STEPS.items():
        out = out.when(F.col("spent") == spent, F.array(*[to(*w) for w in ways]))
    return out


def near_words(words: DataFrame, page: int = PAGE, searches: int = SEARCHES) -> DataFrame:
    """(word, n_near, form, form_n) of the words (word, n) that have near ones: their number, and the one of largest n, of several the least."""
    rows = checkpointed(_counts(words))
    inner: list[DataFrame] = []
    at = rows.select("word", "n", "counts", F.lit("").alias("path"), F.lit(0).alias("depth"))
    for level in range(LEVELS):
        large = checkpointed(at.filter(F.col("depth") == level).groupBy("path").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") > page).select("path", F.lit(True).alias("split")))
        if large.isEmpty():
            break
        inner.append(large)
        split = F.col("split").isNotNull()
        at = join_checked(at, large, "path", "left").select("word", "n", "counts", F.when(split, F.concat_ws(".", "path", F.col("counts")[level].cast("string"))).otherwise(F.col("path")).alias("path"), F.when(split, level + 1).otherwise(F.col("depth")).alias("depth"))
    state = rows.select("word", "n", "counts", F.lit("").alias("path"), F.lit(_ROOT).alias("spent"))
    for level, large in enumerate(inner):
        ways = F.when(F.col("split").isNotNull(), _steps(level)).otherwise(F.array(F.struct("path", "spent")))
        state = join_checked(state, large, "path", "left").select("word", "n", "counts", F.explode(ways).alias("x")).select("word", "n", "counts", "x.*")
    held, asked = checkpointed(at.select("word", "n", "path")), state.select("word", "n", "path")
    # Words with the same counts throughout can be more than a page, and what is asked of a page more than a task should do: both are dealt out then.
    pages = checkpointed(held.groupBy("path").agg(F.count(F.lit(1)).alias("k")))
    asked = checkpointed(join_checked(asked, pages.select("path"), "path", "left_semi"))
    sizes = pages.join(asked.groupBy("path").agg(F.count(F.lit(1)).alias("m")), "path")
    sizes = checkpointed(sizes.select("path", F.ceil(F.col("k") / page).cast("int").alias("parts"), F.ceil(F.col("m") / searches).cast("int").alias("turns")))
    own = lambda n: F.pmod(F.xxhash64("word"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = join_checked(held, sizes, "path").withColumn("part", own("parts")).withColumn("turn", every("turns"))
    right = join_checked(asked, sizes, "path").withColumn("turn", own("turns")).withColumn("part", every("parts"))
    key = ["path", "part", "turn"]
    pairs = left.select(*key, F.col("word").alias("held"), F.col("n").alias("times")).groupBy(*key).cogroup(right.select(*key, "word", "n").groupBy(*key))
    found = pairs.applyInArrow(_in_page, "word string, k long, form_n long, form string")
    best = found.groupBy("word").agg(F.sum("k").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("m"), F.col("form").alias("f"))).alias("x"))
    return best.select("word", "n_near", F.col("x.f").alias("form"), (-F.col("x.m")).alias("form_n"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of links (word, form), which have no circles: the end of each word's chain, in steps that double."""
    reach = checkpointed(links.select("word", F.col("form").alias("root")))
    while True:
        far = reach.select(F.col("word").alias("__w"), F.col("root").alias("__r"))
        moved = checkpointed(reach.join(far, F.col("root") == F.col("__w"), "left").select("word", F.coalesce("__r", "root").alias("root"), F.col("__r").isNotNull().alias("moved")))
        reach = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return reach


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each word of docs: word, form, root, n, n_near and form_n.

    Words are runs of letters up to U+00FF with LEAST_LENGTH of them, lower-cased in A-Z; one run in DAMAGE, chosen by the
    CRC-32 of its key and itself, loses a letter, as errors do. A word's form is the near word that occurs most, if it occurs
    FORM_FACTOR times as often as the word; of several the least. root is the end of the chain of forms, the word itself
    where it has none. Every occurrence in every text counts, so repeated rows count again; null keys read as empty. Null
    texts and those without words give nothing, and an empty table no rows. Keys may be of any type; other columns are not read.
    """
    words = checkpointed(word_counts(docs, key, text))
    near = checkpointed(near_words(words))
    good = F.col("form_n") >= FORM_FACTOR * F.col("n")
    formed = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(good, F.col("form")).alias("form"), F.when(good, F.col("form_n")).alias("form_n"))
    formed = checkpointed(formed)
    ends = roots(formed.filter("form is not null").select("word", "form"))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE = f"""
WITH {CRC_TABLE},
ru AS (SELECT coalesce(doc_id::VARCHAR, '') AS k, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{7,}}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
rk AS (SELECT k, w, count(*) AS c, k || ':' || w AS kw FROM ru GROUP BY 1, 2),
rh AS (SELECT w, c, CAST({CRC_OF.format(x="kw")} AS BIGINT) AS h FROM rk, crc),
wo AS (SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, CAST(sum(c) AS BIGINT) AS n FROM rh GROUP BY 1),
v AS (SELECT word, n FROM wo WHERE length(word) >= 7 AND n >= 2),
ho AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
ne AS (SELECT a.word, b.word AS o, b.n AS m FROM ho a JOIN ho b ON a.i = b.i AND a.rest = b.rest AND length(a.word) = length(b.word) WHERE a.word <> b.word
       UNION SELECT a.word, b.word, b.n FROM ho a JOIN v b ON a.rest = b.word UNION SELECT b.word, a.word, a.n FROM ho a JOIN v b ON a.rest = b.word),
be AS (SELECT v.word, v.n, count(o) AS n_near, arg_min(o, (-m, o)) AS f, max(m) AS fn FROM v LEFT JOIN ne ON v.word = ne.word GROUP BY 1, 2),
fo AS (SELECT word, n, n_near, CASE WHEN fn >= 10 * n THEN f END AS form, CASE WHEN fn >= 10 * n THEN fn END AS form_n FROM be),
ro AS (SELECT * FROM (WITH RECURSIVE ch AS (SELECT word, word AS e, 0 AS d FROM fo UNION ALL SELECT ch.word, fo.form, d + 1 FROM ch JOIN fo ON ch.e = fo.word WHERE fo.form IS NOT NULL) SELECT word, arg_max(e, d) AS root FROM ch GROUP BY 1))
SELECT word, form, root, n, n_near, form_n FROM fo JOIN ro USING (word)
"""
