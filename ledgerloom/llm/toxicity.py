"""Toxicity: Levenshtein automata intersected with a lexicon trie, scored in context windows.

The lexicon is learned from labelled documents: words and word beginnings that mark toxic ones. It is held
as a trie; a word is matched by walking the trie with the states of the word's Levenshtein automaton (one
edit), so misspelled terms count as well. A beginning stands for its words in exact matches; for misspelled
ones the words themselves are walked (two letters that changed places are two edits). A term in quotation marks or beside a word of report scores as
quoted rather than abusive. A logistic model over those counts gives the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bounds of the fit: labelled documents that the lexicon and the weights are fitted on, and terms kept.
FIT_DOCS, MAX_TERMS = 20_000, 4_000
#: Lengths of word beginnings tried as terms beside whole words.
STEMS = (4, 5, 6)
#: Edits are allowed in words of so many characters.
FUZZY_FROM = 5
#: Words on either side of a term in which reports and quotation marks are looked for.
CONTEXT = 4
#: Words of report in the four languages, and quotation marks.
REPORT = frozenset("said says called wrote quote quoted quotes claimed sagte schrieb nannte zitat dit écrit appelé citation dijo escribió llamó cita".split())
QUOTES = "\"'«»“”„‘’"
_WORD = re.compile(r"[^\W_]+")
_MEMO = 400_000
NAMES = ("__strong", "__hits", "__fuzzy", "__quoted")


class Trie:
    """Terms with weights; stems (idio*) end in a node that takes any continuation, forms of a stem (idiots~) are for the automaton alone."""

    def __init__(self, terms: dict[str, float]):
        self.root: dict = {}
        self.whole: dict = {}  # the words long enough for an edit: what the automaton walks
        for term, weight in terms.items():
            stem = term.endswith("*")
            word = term.rstrip("*~")
            for root in [*([] if term.endswith("~") else [self.root]), *([] if stem or len(word) < FUZZY_FROM else [self.whole])]:
                node = root
                for c in word:
                    node = node.setdefault(c, {})
                node["*" if stem else "$"] = weight
        self.memo: dict[str, tuple[float, int]] = {}
        # With one edit either a term's first three letters or its next two stay together.
        long = [w for t in terms if t[-1:] != "*" and len(w := t.rstrip("~")) >= FUZZY_FROM]
        self.heads, self.mids = {t[:3] for t in long}, {t[3:5] for t in long}

    def match(self, word: str) -> tuple[float, int]:
        """(weight, edits) of the best term for a word; (0, -1) for none. Fewer edits are better, then more weight."""
        if (known := self.memo.get(word)) is None:
            known = self._exact(word)
            if known[1] < 0 and len(word) >= FUZZY_FROM:
                known = self._edited(word)
            if len(self.memo) >= _MEMO:
                self.memo.clear()
            self.memo[word] = known
        return known

    def _exact(self, word: str) -> tuple[float, int]:
        node, best = self.root, 0.0
        for c in word:
            if (node := node.get(c)) is None:
                break
            best = max(best, node.get("*", 0.0))
        else:
            best = max(best, node.get("$", 0.0))
        return (best, 0) if best else (0.0, -1)

    def _edited(self, word: str) -> tuple[float, int]:
        """Walks the trie with the states (place in the word, edits) of the automaton for one edit."""
        if word[:3] not in self.heads and not {word[3:5], word[2:4], word[4:6]} & self.mids:
            return 0.0, -1
        best, stack = 0.0, [(self.whole, frozenset(((0, 0), (1, 1))), 0)]
        while stack:
            node, states, depth = stack.pop()
            if depth >= FUZZY_FROM:
                ends = any(len(word) - i + e <= 1 for i, e in states)
                best = max(best, node.get("$", 0.0) if ends else 0.0)
            for c, below in node.items():
                if len(c) != 1 or c in "*$":
                    continue
                after = set()
                for i, e in states:
                    if i < len(word) and word[i] == c:
                        after.add((i + 1, e))
                        if e == 0:
                            after.add((i + 2, 1))  # a letter of the word is left out
                    if e == 0:
                        after.add((i, 1))  # the term has a letter more
                        after.add((i + 1, 1))  # another letter
                after = frozenset((i, e) for i, e in after if i <= len(word))
                if after:
                    stack.append((below, after, depth + 1))
        return (best, 1) if best else (0.0, -1)


def features(text: str | None, trie: Trie) -> tuple[float, float, float, float]:
    """strong: weights of distinct abusive terms; hits and fuzzy: their numbers, exact and misspelled; quoted: terms in quotation or report."""
    if not text:
        return 0.0, 0.0, 0.0, 0.0
    low = text.lower()
    words = _WORD.findall(low)
    known, match = trie.memo.get, trie.match
    marked = {w: m for w in set(words) if (m := known(w) or match(w))[1] >= 0}
    if not marked:
        return 0.0, 0.0, 0.0, 0.0
    spans = [m.span() for m in _WORD.finditer(low)]
    strong: dict[str, float] = {}
    fuzzy, quoted = set(), set()
    for i, w in enumerate(words):
        if w not in marked:
            continue
        weight, edits = marked[w]
        around = range(max(0, i - CONTEXT), min(len(words), i + CONTEXT + 1))
        before = low[spans[around[0]][0] : spans[i][0]]
        after = low[spans[i][1] : spans[around[-1]][1] + 1]
        if (any(q in before for q in QUOTES) and any(q in after for q in QUOTES)) or any(words[j] in REPORT for j in around):
            quoted.add(w)
        elif edits:
            fuzzy.add(w)
        else:
            strong[w] = weight
    return min(sum(strong.values()), 60.0), float(min(len(strong), 12)), float(min(len(fuzzy), 12)), float(min(len(quoted), 12))


def fold(key: Column) -> Column:
    """crc32 of the key as text, modulo 5."""
    return F.pmod(F.crc32(F.encode(F.coalesce(key.cast("string"), F.lit("")), "UTF-8")), F.lit(5)).cast("int")


def learn(labelled: DataFrame, text: str = "text", label: str = "label", part: str = "part") -> dict:
    """A model from (text, label, part): terms from the rows of parts below 3, weights from the others.

    All rows of labelled are used: the caller bounds them. A term is kept when its likelihood ratio between
    toxic and other documents is beyond what the best of as many chance terms would reach. One class only, or
    no rows: a model of the base rate.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: tuple[Counter[str], Counter[str]] = Counter(), Counter()
        for batch in batches:
            for body, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = set(_WORD.findall((body or "").lower()))
                total[y].update(words | {f"{w[:n]}*" for w in words for n in STEMS if len(w) > n})
                total[y][""] += 1
        terms = list(total[0] | total[1])
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *(pa.array([c[t] for t in terms], pa.int64()) for c in total)], names=["term", "n0", "n1"])

    base = labelled.filter(F.col(text).isNotNull()).select(F.col(text), F.col(label).cast("int"), F.col(part))
    counts = base.filter(F.col(part) < 3).select(text, label).mapInArrow(count, "term string, n0 long, n1 long").groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).persist()
    row = counts.filter("term = ''").first()
    every = counts.count() - 1
    n0, n1 = (row["n0"], row["n1"]) if row else (0, 0)
    terms: dict[str, float] = {}
    if n0 and n1:
        rate = n1 / (n0 + n1)
        n = F.col("n0") + F.col("n1")
        part_of = lambda k, p: F.when(k > 0, k * F.log(k / (n * p))).otherwise(0.0)
        ratio = 2 * (part_of(F.col("n1"), F.lit(rate)) + part_of(F.col("n0"), F.lit(1 - rate)))
        weight = F.log((F.col("n1") + 0.5) / (n1 + 1)) - F.log((F.col("n0") + 0.5) / (n0 + 1))
        kept = counts.filter((F.col("term") != "") & (F.col("n1") > 2 * rate * n)).withColumn("g", ratio).withColumn("w", weight)
        least = max(14.0, 2 * math.log(max(every, 2)))
        rows = kept.filter((F.col("g") > least) & (F.col("n1") > 0.5 * n)).orderBy(F.desc("g"), "term").limit(MAX_TERMS).collect()  # as many terms as the model has
        spread = _independent(base.filter((F.col(part) < 3) & (F.col(label) == 1)), text, [r["term"] for r in rows])
        chance = -2 * math.log(rate)  # what each independent document adds to the ratio
        terms = _unrelated([(r["term"], r["n1"], r["w"]) for r in rows if min(r["g"], chance * spread.get(r["term"], 0.0)) > least])
        # The words that a kept beginning stands for: what misspelled ones are held against. At most the words of the rows given.
        stems = [t for t in terms if t.endswith("*")]
        begins = [F.concat(F.substring("term", 1, k), F.lit("*")).isin([t for t in stems if len(t) == k + 1]) for k in STEMS]
        forms = counts.filter(~F.col("term").endswith("*") & (F.length("term") >= FUZZY_FROM) & (F.col("n1") > 0.5 * n) & (begins[0] | begins[1] | begins[2])).select("term").collect()
        terms |= {f"{w}~": max(terms.get(f"{w[:k]}*", 0.0) for k in STEMS) for (w,) in forms if w not in terms}
    counts.unpersist()
    scored = _featured(base.filter(F.col(part) >= 3).select(text, label), terms, [label]).collect()  # bounded by the caller
    x = np.array([[r[n] for n in NAMES] for r in scored]).reshape(-1, len(NAMES))
    y = np.array([r["c0"] for r in scored], dtype=float)
    weights = _logistic(x, y) if len(y) else np.array([0.0] * len(NAMES) + [math.log((n1 + 0.5) / (n0 + 1.5))])
    return {"terms": terms, "weights": weights.tolist()}


def _independent(toxic: DataFrame, text: str, terms: list[str]) -> dict[str, float]:
    """How many independent places a term stands in: (sum c)^2 / sum c^2 over counts c of its neighbouring words.

    Copies of a document repeat its words in the same places, so hundreds of them count as little more than one.
    """
    shared = toxic.sparkSession.sparkContext.broadcast(frozenset(terms))  # at most MAX_TERMS

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            found: set[tuple[int, str, str]] = set()
            for d, body in enumerate(batch.column(0).to_pylist()):
                words = ["", *_WORD.findall((body or "").lower()), ""]
                for i, w in enumerate(words):
                    for form in (w, f"{w[:4]}*", f"{w[:5]}*", f"{w[:6]}*"):
                        if form in known:
                            found.add((d, form, f"{words[i - 1]} {words[i + 1]}"))
            yield pa.RecordBatch.from_arrays([pa.array([f[1] for f in found], pa.string()), pa.array([f[2] for f in found], pa.string())], names=["term", "beside"])

    counts = toxic.select(text).mapInArrow(places, "term string, beside string").groupBy("term", "beside").agg(F.count(F.lit(1)).cast("double").alias("c"))
    return {r["term"]: r["k"] for r in counts.groupBy("term").agg((F.sum("c") * F.sum("c") / F.sum(F.col("c") * F.col("c"))).alias("k")).collect()}


def _unrelated(found: list[tuple[str, int, float]]) -> dict[str, float]:
    """Terms and weights without those that a kept, shorter beginning stands for: forms of it with less than half of its documents."""
    kept: dict[str, tuple[int, float]] = {}
    for term, n, weight in sorted(found, key=lambda r: (len(r[0].rstrip("*")), r[0])):
        word = term.rstrip("*")
        heads = [kept[h][0] for k in STEMS if (h := f"{word[:k]}*") in kept and h != term]
        if not any(2 * n < h for h in heads):
            kept[term] = (n, weight)
    return {t: w for t, (_, w) in kept.items()}


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights and, last, intercept of a ridge logistic model, by Newton's method."""
    x = np.hstack([x / SCALE, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-3])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - p) - penalty @ w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


SCALE = np.array([10.0, 3.0, 3.0, 3.0])


def _featured(df: DataFrame, terms: dict[str, float], carry: list[str], text: str = "text") -> DataFrame:
    """The carried columns of df, as c0, c1, ..., and the features of each text."""
    shared = df.sparkSession.sparkContext.broadcast(terms)  # at most MAX_TERMS, and the forms of their stems
    inner = [f"c{i}" for i in range(len(carry))]  # names that clash with nothing
    spread = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(carry, inner, strict=True)], F.col(f"`{text}`").cast("string").alias("__text"))
    kinds = dict(spread.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(shared.value)
        for batch in batches:
            found = [features(t, trie) for t in batch.column(len(carry)).to_pylist()]
            columns = [pa.array([f[i] for f in found], pa.float64()) for i in range(len(NAMES))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(carry)], *columns], names=[*inner, *NAMES])

    schema = ", ".join([*(f"{c} {kinds[c]}" for c in inner), *(f"{n} double" for n in NAMES)])
    return spread.mapInArrow(run, schema)


def _score(model: dict) -> Column:
    w = model["weights"]
    z = F.lit(float(w[-1]))
    for n, v, s in zip(NAMES, w, SCALE, strict=False):
        z = z + F.col(n) * F.lit(float(v / s))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def score(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, predicted, strong, hits, fuzzy, quoted) of every row of docs; a null text scores as an empty one.

    Texts of any length are read whole; equal texts score alike, whatever their keys; other columns are not read.
    """
    found = _featured(docs, model["terms"], [key], text).withColumn("score", _score(model))
    return found.select(F.col("c0").alias(key), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), *[F.col(n).alias(n.strip("_")) for n in NAMES])


def keep_clean(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """The rows of docs with a score below 0.5, with all their columns, whatever their names and types; no shuffle. A score of just 0.5 goes."""
    return _featured(docs, model["terms"], docs.columns, text).filter(_score(model) < 0.5).drop(*NAMES).toDF(*docs.columns)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", bound: int = FIT_DOCS) -> dict:
    """A model from at most about `bound` labelled rows outside fold 0 of the key.

    The rows are those whose hash is below a threshold, the same at every run. A document with several
    labels counts as toxic if one says so; null labels and keys don't count. Of rows that repeat a key the least text counts.
    Empty tables give a model of the base rate.
    """
    usable = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull()).filter(fold(F.col(key)) != 0)
    one = usable.groupBy(key).agg((F.max(label) > 0).cast("int").alias("label"))
    n = one.count()
    draw = F.pmod(F.xxhash64(F.col(key), F.lit(5)), F.lit(1_000_000))
    one = one.filter(draw < int(1_000_000 * min(1.0, bound / max(n, 1))))
    # As many rows as the bound: the texts stay where they are.
    labelled = docs.select(F.col(key), F.col(text).alias("text")).join(F.broadcast(one.withColumnRenamed(key, "__k")), F.col(key) == F.col("__k"))
    labelled = labelled.groupBy(key, "label").agg(F.min("text").alias("text"))
    return learn(labelled.select("text", "label", fold(F.col(key)).alias("part")))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The op5 contract: a row for each row of documents, null and empty texts included, in any order; repeated rows get equal scores; no documents, no rows."""
    model = fit(docs, labels)
    return score(docs, model).select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted")
