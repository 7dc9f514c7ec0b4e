"""Substring dedup by sliding spans of sentences and pieces of sentences.

Texts are cut after sentences and, where none ends for some words, after a word chosen by the hashes of the words around
it (winnowing), so that equal stretches are cut alike inside whatever sentences they stand. Runs of consecutive parts with
enough words are hashed and met in one global join. The words that any repeated run other than its first occurrence covers
are removed.

Any WINDOW words in a row hold a cut that depends on them alone. So a passage of RUN_WORDS + 3 * WINDOW + 2 words (49)
that occurs again is always found, and at most WINDOW + 1 words at either end of it stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.words import U, hashed_words, long_lists, pieces
from ledgerloom.plans.common import checkpointed, join_checked

#: A run has at least so many words; a stretch of so many words without a sentence's end is cut.
RUN_WORDS, WINDOW = 20, 9
_TOKEN = re.compile(r"[^ \t-\r]+[ \t-\r]*")
_BASE, _PAIR, _PLACE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, (1 << 24) - 1
_POWERS = [np.ones(1, U), np.ones(1, U)]


def _powers(n: int) -> list[np.ndarray]:
    """The first n powers of _BASE, and of its inverse, modulo 2 ** 64."""
    if len(_POWERS[0]) < n:
        size = 1 << n.bit_length()
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            _POWERS[k] = np.concatenate((np.ones(1, U), np.cumprod(np.full(size, base, U))))
    return [p[:n] for p in _POWERS]


def cuts(h: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places between words where parts begin or end, over texts that follow each other: their starts and ends, and the chosen ones.

    h are the words' hashes, ends tells which of them end a sentence, counts has the number of words of each text.
    """
    n = len(h)
    chosen = ends.copy()
    if n >= WINDOW:
        # Least pairs of words first, of equal ones the last; a sentence's end comes before all pairs.
        v = h * U(_BASE)
        v[1:] += h[:-1] * U(_PAIR)
        v[ends] = 0
        v = v & U(~_PLACE & (1 << 64) - 1) | U(_PLACE) - (np.arange(n, dtype=U) & U(_PLACE))
        least, span = v, 1
        while span < WINDOW:
            step = min(span, WINDOW - span)
            least, span = np.minimum(least[:-step], least[step:]), span + step
        whole = np.repeat(np.cumsum(counts), counts)[: len(least)] >= np.arange(len(least)) + WINDOW  # windows within one text
        first = np.arange(len(least), dtype=U)[whole]
        place = U(_PLACE) - (least[whole] & U(_PLACE))
        chosen[(first + ((place - first) & U(_PLACE))).astype(np.int64)] = True
    every = np.zeros(n + 1, bool)
    every[1:] = chosen
    every[np.concatenate(([0], np.cumsum(counts)))] = True
    return np.flatnonzero(every)


def runs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, start, end, counts) of the runs of parts with enough words, in words: the shortest from each part and the shortest up to each part.

    text numbers the texts, of which counts has the numbers of words. Case, and the kind of whitespace, don't count.
    """
    h, counts, codes, known = hashed_words(pc.utf8_lower(pc.fill_null(texts, "")))
    stops = np.array([w.endswith((".", "!", "?")) for w in known], bool)
    places = cuts(h, stops[codes] if len(codes) else np.zeros(0, bool), counts)
    stop = np.concatenate(([0], np.cumsum(counts)))
    text_of = np.repeat(np.arange(len(counts)), counts)  # of the word after a place
    after = np.searchsorted(places, places + RUN_WORDS)
    ok = after < len(places)
    forward = np.stack((places[ok], places[after[ok]]))
    before = np.searchsorted(places, places - RUN_WORDS, side="right") - 1
    ok = before >= 0
    pairs = np.concatenate((forward, np.stack((places[before[ok]], places[ok]))), axis=1)
    pairs = pairs[:, pairs[1] <= stop[text_of[pairs[0]] + 1]] if len(h) else pairs[:, :0]
    packed = np.unique(pairs[0] << 32 | pairs[1])
    start, end = packed >> 32, packed & 0xFFFFFFFF
    power, inverse = _powers(len(h) + 1)
    sums = np.concatenate((np.zeros(1, U), np.cumsum(h * power[:-1])))
    text = text_of[start] if len(start) else start
    return ((sums[end] - sums[start]) * inverse[start]).view(np.int64), text, start - stop[text], end - stop[text], counts


def _joined(text: np.ndarray, start: np.ndarray, end: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, packed stretch) of the words that any of the runs covers, as start << 32 | end; stretches of one text are apart and in order."""
    origin = np.cumsum(counts) - counts + np.arange(len(counts))  # a place more for each text, so that two never touch
    covered = np.zeros(int(counts.sum()) + len(counts) + 1, np.int64)
    np.add.at(covered, origin[text] + start, 1)
    np.add.at(covered, origin[text] + end, -1)
    edges = np.flatnonzero(np.diff(np.cumsum(covered) > 0, prepend=False))
    first, last = edges[::2], edges[1::2]
    own = np.searchsorted(origin, first, side="right") - 1
    return own, (first - origin[own]) << 32 | (last - origin[own])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (key, th, spans) in which sorted stretches of one text that touch become one, in one pass over each batch."""
    for batch in batches:
        lists = batch.column(2)
        x, counts = np.asarray(lists.flatten()), np.asarray(pc.list_value_length(lists))
        text = np.repeat(np.arange(len(counts)), counts)
        start, end = x >> 32, x & 0xFFFFFFFF
        # Ends so far, told apart by text: those of a text before are below any start of the next one.
        reach = np.maximum.accumulate(end + (text << 32)) if len(x) else end
        new = np.ones(len(x), bool)
        new[1:] = start[1:] + (text[1:] << 32) > reach[:-1]
        new[1:] |= text[1:] != text[:-1]
        last = np.append(np.flatnonzero(new)[1:], len(x)) - 1 if len(x) else np.empty(0, np.int64)
        joined = start[new] << 32 | (reach[last] & 0xFFFFFFFF)
        split = long_lists(np.split(joined, np.searchsorted(text[new], np.arange(1, batch.num_rows))))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), split], names=["key", "th", "spans"])


def span_lists(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, th, h, start, size, again) of each row: the hashes of its runs, each once, at its first place in words; again has the stretches that their other places cover."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 2):
                h, at, start, end, counts = runs(piece.column(2))
                order = np.lexsort((start, h, at))
                h, at, start, end = h[order], at[order], start[order], end[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (at[1:] != at[:-1])
                own, again = _joined(at[~new], start[~new], end[~new], counts)
                at, h, start, size = at[new], h[new], start[new], (end - start)[new]
                split = lambda x, of: long_lists(np.split(x, np.searchsorted(of, np.arange(1, piece.num_rows))))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), split(h, at), split(start, at), split(size, at), split(again, own)],
                    names=["key", "th", "h", "start", "size", "again"],
                )

    rows = docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("th"), F.col(text).cast("string").alias("text"))
    lists = rows.mapInArrow(cut, "key long, th long, h array<bigint>, start array<bigint>, size array<bigint>, again array<bigint>")
    return lists.withColumns({"start": F.col("start").cast("array<int>"), "size": F.col("size").cast("array<tinyint>")})


def removed_stretches(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, th, spans): for each text with something to remove, the stretches of its words, as start << 32 | end, apart and in order."""
    rows = checkpointed(span_lists(docs, key, text).withColumn("rid", F.monotonically_increasing_id()))
    again = rows.select(F.explode("h").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    placed = rows.select("rid", "start", "size", F.posexplode("h").alias("i", "h")).select("h", "rid", F.get("start", "i").alias("s"), F.get("size", "i").alias("w"))
    repeated = placed.join(again, "h")
    names = rows.select(F.col("rid").alias("r"), "key", "th")
    # Names come to the repeated runs alone. Rows that repeat key and text are one document.
    repeated = checkpointed(repeated.join(names, F.col("rid") == F.col("r")).select("h", "key", "th", "s", "w"))
    # Written before the join, so that both sides are dealt anew and a very frequent run can be split over tasks.
    first = checkpointed(repeated.groupBy("h").agg(F.min(F.struct("key", "th")).alias("f")))
    later = repeated.join(first, "h").filter(~F.struct("key", "th").eqNullSafe(F.col("f"))).select("key", "th", (F.shiftleft(F.col("s").cast("long"), 32) + F.col("s") + F.col("w")).alias("x"))
    inside = rows.filter(F.size("again") > 0).select("key", "th", F.explode("again").alias("x"))
    lists = later.unionByName(inside).groupBy("key", "th").agg(F.sort_array(F.collect_set("x")).alias("spans"))  # a group is one text
    return lists.mapInArrow(_merged, lists.schema)


def remove_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with text rewritten, and n_removed (words) and changed added.

    The first occurrence of a run is the one with the smallest key, then by the text's hash, then place; all others are
    removed, within one document too. Null and empty texts stay as they are. Rows that repeat key and text are one document
    and get equal results; null keys come before others. Texts of any length are cut whole. Columns named n_removed or
    changed are replaced; others, whatever their names and types, are kept. Keys are 64-bit numbers. Empty tables give empty results.
    """
    hit = checkpointed(removed_stretches(docs, key, text)).toDF("__k", "__th", "__spans")
    columns = [c for c in docs.columns if c not in ("n_removed", "changed")]
    i = columns.index(text)
    inner = [f"c{j}" for j in range(len(columns))]  # names that clash with nothing
    marked = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(columns, inner, strict=True)])
    k = inner[columns.index(key)]
    joined = join_checked(marked, hit, F.col(k).cast("long").eqNullSafe(F.col("__k")) & (F.xxhash64(inner[i]) == F.col("__th")), "left")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(len(columns))
            hits = np.flatnonzero(np.asarray(spans.is_valid()))
            texts, gone = [], np.zeros(batch.num_rows, np.int64)
            for row, body, stretches in zip(hits.tolist(), batch.column(i).take(pa.array(hits)).to_pylist(), spans.take(pa.array(hits)).to_pylist(), strict=True):
                starts = [m.start() for m in _TOKEN.finditer(body)] + [len(body)]
                kept, at = [], 0
                for x in stretches:
                    s, e = x >> 32, x & (1 << 32) - 1
                    kept.append(body[at : starts[s]])
                    at = starts[e]
                    gone[row] += e - s
                texts.append("".join([*kept, body[at:]]))
            mask = np.zeros(batch.num_rows, bool)
            mask[hits] = True
            new = pc.replace_with_mask(batch.column(i), pa.array(mask), pa.array(texts, batch.schema.field(i).type)) if texts else batch.column(i)
            yield pa.RecordBatch.from_arrays([*(new if j == i else batch.column(j) for j in range(len(columns))), pa.array(gone), pa.array(gone > 0)], names=[*inner, "n_removed", "changed"])

    kinds = dict(marked.dtypes)
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in inner), "n_removed long, changed boolean"])
    return joined.select(*inner, "__spans").mapInArrow(rewrite, schema).toDF(*columns, "n_removed", "changed")


def spans_report(docs: DataFrame) -> DataFrame:
    """op10: every document with what is left of its text, and how many of its words went."""
    return remove_spans(docs.select("doc_id", "text"))
