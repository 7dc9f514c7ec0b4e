"""Benchmark decontamination on a positional inverted index of the training texts.

Windows of ten consecutive words of each benchmark item are the phrases to find. Training counts of the
benchmark's terms give each window its rarest two; only their postings (term, document, place) are stored.
The two lists, each adjusted by its term's place in the window, are intersected in a join on window, document
and start, and what is left is verified word by word against the documents' texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.plans.common import checkpointed, join_checked

WINDOW = 10
#: Benchmark terms go to the tasks in blocks of about this many, by the term's hash; larger benchmarks take more passes.
BLOCK_TERMS = 500_000
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_AZ = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def tokens(text: bytes | None) -> list[bytes]:
    """Words of a text in UTF-8: runs of 0-9, a-z and everything beyond ASCII, after lower-casing A-Z."""
    return _WORD.findall(text.translate(_AZ)) if text else []


def term_hash(word: bytes) -> int:
    """The number that stands for a word in postings. Words that share one only make a candidate more, which is not verified."""
    return xxhash.xxh64_intdigest(word) - (1 << 63)


def item_windows(benchmark: DataFrame, size: int, item: str, text: str) -> DataFrame:
    """(window, n, words, terms, items): every window, numbered, with its words and their hashes, and the items that have it.

    An item of fewer words is one window, one without words none. A phrase that several items share is looked for once.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, words = [], []
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                w = tokens(body)
                found = [w[i : i + size] for i in range(max(1, len(w) - size + 1)) if w]
                names += [name] * len(found)
                words += found
            terms = [[term_hash(x) for x in w] for w in words]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(words, pa.list_(pa.binary())), pa.array(terms, pa.list_(pa.int64()))], names=["item", "words", "terms"])

    cuts = benchmark.select(F.col(item).cast("string"), F.encode(F.col(text), "UTF-8")).mapInArrow(cut, "item string, words array<binary>, terms array<bigint>")
    once = cuts.groupBy("words", "terms").agg(F.collect_set(F.coalesce("item", F.lit(""))).alias("items"))
    return checkpointed(once.select(F.monotonically_increasing_id().alias("window"), F.size("words").alias("n"), "words", "terms", "items"))


def _blocks(words: DataFrame, least: int = 0) -> Iterator[frozenset[bytes]]:
    """The distinct words (word) in blocks of about BLOCK_TERMS, `least` of them at least. Blocks are read one by one, so neither the driver nor a task holds more at once."""
    words = checkpointed(words.distinct())
    blocks = max(least, -(-words.count() // BLOCK_TERMS))
    for b in range(blocks):
        own = words if blocks == 1 else words.filter(F.pmod(F.xxhash64("word"), F.lit(blocks)) == b)
        yield frozenset(bytes(r["word"]) for r in own.collect())


def term_counts(texts: DataFrame, words: DataFrame) -> DataFrame:
    """(term, df): how often each word of words (word) stands in the texts (__text)."""
    out = None
    for block in _blocks(words):
        known = texts.sparkSession.sparkContext.broadcast(block)

        def count(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            total: Counter[bytes] = Counter()
            for batch in batches:
                for body in batch.column(0).to_pylist():
                    total.update(filter(known.value.__contains__, tokens(body)))
            yield pa.RecordBatch.from_arrays([pa.array([term_hash(w) for w in total], pa.int64()), pa.array(list(total.values()), pa.int64())], names=["term", "n"])

        one = checkpointed(texts.select("__text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("df")))
        known.unpersist()
        out = one if out is None else out.unionByName(one)
    return out if out is not None else texts.sparkSession.createDataFrame([], "term long, df long")


def postings(texts: DataFrame, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, postings): (__key, __rid, n_words) of every text, and (row, __key, __rid, n_words, term, at) of every place of a word of words (word)."""
    key_type = dict(texts.dtypes)["__key"]
    docs, lists = None, None
    for block in _blocks(words, 1):
        wanted = texts.sparkSession.sparkContext.broadcast({w: term_hash(w) for w in block})

        def index(batches: Iterator[pa.RecordBatch], wanted=wanted) -> Iterator[pa.RecordBatch]:
            get = wanted.value.get
            for batch in batches:
                lengths, terms, places = [], [], []
                for body in batch.column("__text").to_pylist():
                    w = tokens(body)
                    found = [(i, t) for i, t in enumerate(map(get, w)) if t is not None]
                    lengths.append(len(w))
                    places.append([i for i, _ in found])
                    terms.append([t for _, t in found])
                yield pa.RecordBatch.from_arrays([batch.column("__key"), batch.column("__rid"), pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32()))], names=["__key", "__rid", "n_words", "terms", "places"])

        indexed = texts.mapInArrow(index, f"__key {key_type}, __rid long, n_words long, terms array<bigint>, places array<int>")
        # A row's number is good for one block: the lists of a window are met by key and hash of the text.
        indexed = checkpointed(indexed.withColumn("row", F.xxhash64("__key", "__rid")))
        wanted.unpersist()
        docs = indexed.select("__key", "__rid", "n_words") if docs is None else docs
        one = indexed.filter("size(terms) > 0").select("row", "__key", "__rid", "n_words", "places", F.posexplode("terms").alias("i", "term")).select("row", "__key", "__rid", "n_words", "term", F.get("places", "i").alias("at"))
        lists = one if lists is None else lists.unionByName(one)
    return docs, lists


def verified(texts: DataFrame, found: DataFrame, phrases: DataFrame) -> DataFrame:
    """The rows (__key, __rid, window, start) of found whose window's words do stand in the text."""
    lists = found.join(phrases.select("window", "words"), "window").groupBy("__key", "__rid").agg(F.collect_list(F.struct("window", "start", "words")).alias("__found"))  # one document's
    lists = checkpointed(lists).select(F.col("__key").alias("__k"), F.col("__rid").alias("__r"), "__found")
    near = join_checked(texts, lists, (F.col("__rid") == F.col("__r")) & F.col("__key").eqNullSafe(F.col("__k"))).select("__key", "__rid", "__text", "__found")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, windows, starts = [], [], []
            for r, (body, candidates) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                w = tokens(body)
                for c in candidates:
                    if w[c["start"] : c["start"] + len(c["words"])] == c["words"]:
                        rows.append(r)
                        windows.append(c["window"])
                        starts.append(c["start"])
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(windows, pa.int64()), pa.array(starts, pa.int32())], names=["__key", "__rid", "window", "start"])

    return near.mapInArrow(check, f"__key {dict(texts.dtypes)['__key']}, __rid long, window long, start int")


def search(texts: DataFrame, phrases: DataFrame, slop: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, exact, near): all texts with their lengths, the places (__key, __rid, window, start) of the phrases, and (__key, __rid, window) met within slop."""
    counts = term_counts(texts, phrases.select(F.explode("words").alias("word")))
    parts = phrases.select("window", "n", "words", F.posexplode("terms").alias("o", "term")).join(counts, "term", "left").fillna({"df": 0})
    own = Window.partitionBy("window")  # a window's few words
    ranked = parts.withColumn("least", F.min("df").over(own)).withColumn("rank", F.row_number().over(own.orderBy("df", "o")))
    # A window with a term that training lacks cannot occur.
    chosen = checkpointed(ranked.filter("least > 0 and rank <= 2").select("window", "n", "o", "term", "rank", F.get("words", "o").alias("word")))
    documents, posted = postings(texts, chosen.select("word"))

    def adjusted(rank: int) -> DataFrame:
        own = chosen.filter(F.col("rank") == rank).select("window", "n", "o", "term")
        return join_checked(posted, own, "term").withColumn("start", F.col("at") - F.col("o"))

    first, second = adjusted(1), adjusted(2)
    inside = F.expr("start >= 0 and start + n <= n_words")
    on = ["window", "row", "start"]
    met = first.filter(inside).join(second.filter(inside).select(*on).distinct(), on).select("__key", "__rid", "window", "start")
    alone = first.filter(inside & (F.col("n") == 1)).select("__key", "__rid", "window", "start")
    found = met.unionByName(alone).distinct()
    exact = checkpointed(verified(texts, found, phrases).distinct())
    other = second.select("window", "row", F.col("start").alias("start2"))
    close = first.join(other, ["window", "row"]).filter(F.abs(F.col("start") - F.col("start2")) <= slop).select("__key", "__rid", "window").distinct()
    return documents, exact, close if slop else close.limit(0)


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", size: int = WINDOW, slop: int = 0) -> DataFrame:
    """One row for each of docs: key, n_words, n_hit, n_items, items_sha256, contaminated, near_items and row_hash (of key and text).

    A document word inside any occurrence of a window of an item is hit. near_items counts items of which a
    window's two rarest terms stand within `slop` words of their places without the phrase (0 for slop 0).
    Null texts and items have no words; texts of any length are read whole. Rows that repeat a key and its text get equal
    rows. Items that share a window share its occurrences; repeated items count once for each item id, a null id as ''.
    Terms as rare as each other are taken in the window's order. Other columns of either table, whatever their names, are
    not read. Empty tables: no documents give no rows, no items nothing contaminated.
    """
    phrases = item_windows(benchmark, size, item, item_text)
    texts = docs.select(F.col(key).alias("__key"), F.xxhash64(F.col(key), F.col(text)).alias("__rid"), F.encode(F.col(text), "UTF-8").alias("__text"))
    documents, exact, close = search(texts, phrases, slop)
    named = phrases.select("window", "n", "items")
    exact, close = join_checked(exact, named, "window"), join_checked(close, named, "window")
    none_at, none_item = F.lit(None).cast("int").alias("at"), F.lit(None).cast("string")
    on = ["__key", "__rid"]
    covered = exact.select(*on, F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("at"), none_item.alias("item"), none_item.alias("close"))
    whole = exact.select(*on, none_at, F.explode("items").alias("item"), none_item.alias("close"))
    near = close.select(*on, none_at, none_item.alias("item"), F.explode("items").alias("close"))
    # A group is one document: its own positions and items, each once.
    rows = covered.unionByName(whole).unionByName(near).distinct()
    found = rows.groupBy(*on).agg(F.count("at").alias("n_hit"), F.sort_array(F.collect_list("item")).alias("items"), F.sort_array(F.collect_list("close")).alias("close"))
    found = checkpointed(found.select(F.col("__key").alias("k"), F.col("__rid").alias("r"), "n_hit", "items", F.size(F.array_except("close", "items")).alias("near_items")))
    out = join_checked(documents, found, (F.col("__rid") == F.col("r")) & F.col("__key").eqNullSafe(F.col("k")), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    items = F.coalesce("items", F.array().cast("array<string>"))
    digest = F.sha2(F.encode(F.array_join(items, ","), "UTF-8"), 256)
    return out.select(
        F.col("__key").alias(key), F.col("n_words"), zero("n_hit"), F.size(items).cast("long").alias("n_items"), digest.alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), zero("near_items"), F.col("__rid").alias("row_hash"),
    )
