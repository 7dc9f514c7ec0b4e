"""Exact top-k by inner product with M-trees (Ciaccia, Patella and Zezula, 1997), searched best first.

Vectors are whole numbers, so scores are exact, and the metric is the Euclidean distance d. As
2 q.x = |q|^2 + |x|^2 - d(q, x)^2, a lower bound of the distance is an upper bound of the score. A node keeps its routing
vector, the covering radius, the distance to its parent's routing vector and the largest norm below it; a page keeps each
vector's distance to its routing vector. By the triangle inequality |d(q, parent) - d(x, parent)| is a lower bound of d(q, x),
so that many nodes and vectors are passed over before any distance to them is computed.

Equal vectors are one, with as many of their least ids as an answer can hold. Vectors are ordered by the nearest of a bounded
number of routers, which are a sample, and the distance to it, and cut into blocks. Each block is indexed in the task that
holds it. A query first searches the block in which its own vector lies, which gives a score to beat; then, of the other
blocks, those whose bounds allow more. Queries and blocks meet in bounded portions.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.order import placed
from ledgerloom.plans.common import checkpointed

#: Routing vectors of the order of blocks: a sample of at most so many, wherever the rest of the index covers all rows.
ROUTERS = 256
#: Vectors of a block, queries that meet it together, and vectors of a page.
BLOCK, QUERIES, PAGE = 8192, 4096, 512
#: Children of a node.
FAN = 16
#: Blocks and queries whose bounds are compared together.
TILE = 2048


def whole(column: Column, scale: int) -> Column:
    """floor(scale * x) of each component as double; null where the vector is null or has components that are null or not finite."""
    x = column.cast("array<double>")
    good = F.forall(x, lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a) < F.lit(float("inf"))))
    return F.when(good, F.transform(x, lambda a: F.floor(a * F.lit(float(scale))).cast("long")))


def table_of(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    """A column of whole vectors of one length as a table."""
    return column.combine_chunks().flatten().to_numpy().reshape(len(column), dim)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of a to those of b, as far as doubles go; bound() makes up for their rounding."""
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T), 0))


def bound(q2: float | np.ndarray, x2: float | np.ndarray, far: float | np.ndarray) -> np.ndarray:
    """Upper bound of q.x by both squared norms and a lower bound of the distance. Rounding never brings it below the true score."""
    low = np.maximum(far * (1 - 1e-7) - 1e-3 - 1e-6 * np.sqrt(np.maximum(q2, x2)), 0)
    return (q2 + x2 - low * low) / 2 + 0.25 + 1e-12 * (q2 + x2)


class Node(NamedTuple):
    """Routing row, covering radius, distance to the parent's routing row, the largest squared norm, and either children or a page.

    below has of all children their numbers, routing vectors, radii, distances to this routing row and norms; page has rows,
    their distances to the routing row, vectors and norms.
    """

    route: int
    radius: float
    up: float
    n2: float
    below: tuple[np.ndarray, ...] | None
    page: tuple[np.ndarray, ...] | None


class Tree:
    """An M-tree over the rows of a table of whole numbers."""

    def __init__(self, table: np.ndarray, least: list[int]):
        """least: of each row the key by which it goes before others of the same score."""
        self.whole, self.least = table, least
        self.table = table.astype(np.float64)
        self.n2 = (self.table * self.table).sum(1)
        self.most = max(abs(int(table.max(initial=0))), abs(int(table.min(initial=0))))
        self.nodes: list[Node] = []
        self.root = self._build(np.arange(len(table)), None)

    def _build(self, rows: np.ndarray, parent: int | None) -> int:
        own = self.table[rows]
        route = int(rows[np.argmin(_distances(own, own.mean(0, keepdims=True))[:, 0])])
        here = _distances(own, self.table[[route]])[:, 0]
        up = 0.0 if parent is None else float(_distances(self.table[[route]], self.table[[parent]])[0, 0])
        inner = len(rows) > PAGE and here.max() > 0
        below: list[int] = []
        if inner:
            # Children lie around rows at all distances from the middle, so that they get about as many rows.
            seeds = np.argsort(here, kind="stable")[np.linspace(0, len(rows) - 1, min(FAN, 1 + 2 * len(rows) // PAGE)).astype(int)]
            side = np.argmin(_distances(own, own[seeds]), 1)
            parts = [rows[side == x] for x in range(len(seeds))]
            parts = parts if max(map(len, parts)) < len(rows) else np.array_split(rows, FAN)
            below = [self._build(p, route) for p in parts if len(p)]
        at = len(self.nodes)
        if inner:
            held = (np.array(below), self.table[[self.nodes[x].route for x in below]], *(np.array([getattr(self.nodes[x], f) for x in below]) for f in ("radius", "up", "n2")))
            self.nodes.append(Node(route, float(here.max()), up, float(self.n2[rows].max()), held, None))
        else:
            self.nodes.append(Node(route, float(here.max()), up, float(self.n2[rows].max()), None, (rows, here, own, self.n2[rows])))
        return at

    def best(self, query: np.ndarray, k: int, floor: float = -np.inf) -> list[tuple[int, int]]:
        """(score, row) of the k rows of largest score, ties by least, as far as they reach floor."""
        q = query.astype(np.float64)[None]
        q2 = float((q * q).sum())
        sums = self.most * max(abs(int(query.max(initial=0))), abs(int(query.min(initial=0)))) * max(1, len(query))
        exact = sums < 1 << 53  # else in Python's integers
        held: list[tuple[int, int, int]] = []  # (score, -least, row) of the k best so far, the worst first
        first = self.nodes[self.root]
        d = float(_distances(q, self.table[[first.route]])[0, 0])
        queue = [(-float(bound(q2, first.n2, max(0.0, d - first.radius))), self.root, d)]
        while queue:
            most, at, d = heapq.heappop(queue)
            if -most < floor:
                break
            node = self.nodes[at]
            if node.page is not None:
                rows, here, own, n2 = node.page
                some = np.flatnonzero(bound(q2, n2, np.abs(d - here)) >= floor)  # the others are no answer, and if they are many no product of theirs is computed
                scores = (own[some] @ q[0] if 2 * len(some) < len(rows) else (own @ q[0])[some]) if exact else np.array([int(x) for x in self.whole[rows[some]].astype(object) @ query.astype(object)], object)
                good = scores >= floor
                if np.count_nonzero(good) > k:
                    good &= scores >= sorted(scores[good].tolist())[-k]
                for score, row in zip(map(int, scores[good].tolist()), rows[some[good]].tolist(), strict=True):
                    entry = (score, -self.least[row], row)
                    if len(held) < k:
                        heapq.heappush(held, entry)
                    elif entry > held[0]:
                        heapq.heapreplace(held, entry)
                if len(held) == k:
                    floor = max(floor, held[0][0])
                continue
            below, routes, radius, up, n2 = node.below
            # Children that their distance to this node's routing row rules out are not looked at.
            ways = np.flatnonzero(bound(q2, n2, np.maximum(np.abs(d - up) - radius, 0)) >= floor)
            if len(ways):
                far = _distances(q, routes[ways])[0]
                limits = bound(q2, n2[ways], np.maximum(far - radius[ways], 0))
                for limit, x, away in zip(limits.tolist(), below[ways].tolist(), far.tolist(), strict=True):
                    if limit >= floor:
                        heapq.heappush(queue, (-limit, x, away))
        return [(score, row) for score, _, row in held if score >= floor]


_HIT = "qid long, ids array<long>, score long"
_ENDS = (-(1 << 63), (1 << 63) - 1)


def _search(rows: pa.Table, asks: pa.Table, k: int) -> pa.Table:
    """(qid, ids, score): the k best of rows (v, ids, dim) for each of asks (qid, q, qdim, floor)."""
    who, got, scores = [], [], []
    dims, qdims = rows["dim"].to_numpy(), asks["qdim"].to_numpy()
    for dim in np.intersect1d(dims, qdims).tolist():
        own, mine = rows.filter(pa.array(dims == dim)), asks.filter(pa.array(qdims == dim))
        ids = own["ids"].to_pylist()
        tree = Tree(table_of(own["v"], dim), [x[0] for x in ids])
        for qid, query, floor in zip(mine["qid"].to_pylist(), table_of(mine["q"], dim), mine["floor"].to_pylist(), strict=True):
            for score, row in tree.best(query, k, -np.inf if floor is None else floor):
                who.append(qid)
                got.append(ids[row])
                scores.append(max(_ENDS[0], min(_ENDS[1], score)))
    return pa.table({"qid": pa.array(who, pa.int64()), "ids": pa.array(got, pa.list_(pa.int64())), "score": pa.array(scores, pa.int64())})


def _routed(classes: DataFrame, routers: dict[int, np.ndarray]) -> DataFrame:
    """classes (v, ids, asks, h) with dim, router and dist: the nearest router of as many components, or none and the norm."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(0).value_lengths().to_numpy()
            near, dist = np.full(batch.num_rows, -1, np.int64), np.zeros(batch.num_rows)
            for dim in np.unique(sizes).tolist():
                at = sizes == dim
                own = batch.column(0).filter(pa.array(at)).flatten().to_numpy().reshape(int(at.sum()), dim).astype(np.float64)
                d = _distances(own, routers.get(dim, np.zeros((1, dim))))
                near[at], dist[at] = d.argmin(1) if dim in routers else -1, d.min(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes.astype(np.int64)), pa.array(near), pa.array(dist)], names=["v", "ids", "asks", "h", "dim", "router", "dist"])

    return classes.select("v", "ids", "asks", "h").mapInArrow(run, "v array<long>, ids array<long>, asks boolean, h long, dim long, router long, dist double")


def _tiles(df: DataFrame, by: str, name: str) -> DataFrame:
    """df's rows in arrays of about TILE."""
    n = max(1, -(-df.count() // TILE))
    return df.groupBy(F.pmod(F.xxhash64(by), F.lit(n)).alias("__t")).agg(F.collect_list(F.struct(*df.columns)).alias(name)).select(name)


def _visits(asks: DataFrame, parts: DataFrame, routers: dict[int, np.ndarray]) -> DataFrame:
    """(qid, b): the blocks, but for a query's own, whose parts' bounds reach the score that it has to beat."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                seen: set[tuple[int, int]] = set()
                asked, there = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                for dim in {p["dim"] for p in there} & {a["qdim"] for a in asked}:
                    own, mine = [p for p in there if p["dim"] == dim], [a for a in asked if a["qdim"] == dim]
                    q = np.array([a["q"] for a in mine], np.float64).reshape(len(mine), dim)
                    centres = np.array([routers[dim][p["router"]] if p["router"] >= 0 else np.zeros(dim) for p in own]).reshape(len(own), dim)
                    low, high, n2 = (np.array([p[x] for p in own]) for x in ("low", "high", "n2"))
                    floors = np.array([-np.inf if a["floor"] is None else a["floor"] for a in mine])
                    d = _distances(q, centres)
                    limit = bound((q * q).sum(1)[:, None], n2[None], np.maximum(np.maximum(d - high, low - d), 0))
                    seen |= {(mine[i]["qid"], own[j]["b"]) for i, j in np.argwhere(limit >= floors[:, None]).tolist() if own[j]["b"] != mine[i]["home"]}
                pairs = sorted(seen)
                yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["qid", "b"])

    # A stated set of queries against the bounds of all blocks: each row of this product is a tile of either.
    return _tiles(asks, "qid", "asks").crossJoin(_tiles(parts, "b", "parts")).mapInArrow(run, "qid long, b long").distinct()


def top_k(vectors: DataFrame, asked: Column, k: int, key: str = "vec_id", vector: str = "embedding", scale: int = 256, block: int = BLOCK, portion: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): of each row for which asked holds, the k other rows of largest inner product, ties by the smaller key.

    Components are taken as floor(scale * x), so scores are whole and exact; a score that no long holds is shown as the nearest
    long. Vectors that are null, or hold null or non-finite components, take no part, nor do null keys; vectors of different
    length do not meet. Equal vectors, however many rows have them, are indexed and searched once. A key that several rows
    bear is a row for each vector it has, and never answers itself. A query with fewer than k others gets all of them; with
    none, and for an empty table, there are no rows. Other columns are not read.
    """
    c = F.col
    rows = vectors.select(c(key).cast("long").alias("id"), whole(c(vector), scale).alias("v"), F.coalesce(asked, F.lit(False)).alias("asked"))
    rows = checkpointed(rows.filter("id is not null and v is not null").distinct())
    # k + 1 rows of a vector leave k for each query. Copies beyond them are cut before they are shuffled.
    least = rows.select("v", "id").distinct().withColumn("__r", F.row_number().over(Window.partitionBy("v").orderBy("id"))).filter(c("__r") <= k + 1)
    classes = least.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))  # k + 1 at most
    asking = rows.filter("asked").select("v").distinct().withColumn("asks", F.lit(True))
    classes = checkpointed(classes.join(asking, "v", "left").select("v", "ids", F.coalesce("asks", F.lit(False)).alias("asks"), F.xxhash64("v").alias("h")))
    by_size: dict[int, list] = {}
    for r in classes.orderBy("h").select("v").limit(ROUTERS).collect():
        by_size.setdefault(len(r["v"]), []).append(r["v"])
    routers = {d: np.array(x, np.float64).reshape(len(x), d) for d, x in by_size.items()}

    at = placed(checkpointed(_routed(classes, routers).withColumn("all", F.lit(0))), "all", [c("dim"), c("router"), c("dist"), c("h")])
    at = checkpointed(at.select("v", "ids", "asks", "dim", "router", "dist", c("pos").alias("qid"), F.expr(f"pos div {block}").alias("b")))
    own = lambda table: table.filter(table["asks"]).select(["qid", "v", "dim"]).rename_columns(["qid", "q", "qdim"])
    open_ended = lambda asks: asks.append_column("floor", pa.nulls(asks.num_rows, pa.int64()))
    home = checkpointed(at.groupBy("b").applyInArrow(lambda table: _search(table, open_ended(own(table)), k + 1), _HIT))
    seen = F.sum(F.size("ids")).over(Window.partitionBy("qid").orderBy(F.desc("score")).rangeBetween(Window.unboundedPreceding, 0))
    floors = home.withColumn("__seen", seen).filter(c("__seen") >= k + 1).groupBy("qid").agg(F.max("score").alias("floor"))
    asks = checkpointed(at.filter("asks").select("qid", c("v").alias("q"), c("dim").alias("qdim"), c("b").alias("home")).join(floors, "qid", "left"))

    # A part is what a block has of one router: vectors between two distances from it.
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    parts = checkpointed(at.groupBy("b", "dim", "router").agg(F.min("dist").alias("low"), F.max("dist").alias("high"), F.max(norm).alias("n2")))
    visits = checkpointed(_visits(asks, parts, routers))
    turns = checkpointed(visits.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / portion).cast("int").alias("turns")))
    going = visits.join(asks.drop("home"), "qid").join(turns, "b").withColumn("turn", F.pmod(F.xxhash64("qid"), c("turns")).cast("int"))
    met = at.select(c("b").alias("__b"), "v", "ids", "dim").join(turns.withColumnsRenamed({"b": "__c", "turns": "__n"}), F.expr("__b = __c")).withColumn("__turn", F.explode(F.sequence(F.lit(0), c("__n") - 1)))
    pairs = met.select("__b", "__turn", "v", "ids", "dim").groupBy("__b", "__turn").cogroup(going.select("b", "turn", "qid", "q", "qdim", "floor").groupBy("b", "turn"))
    away = pairs.applyInArrow(lambda table, asks_: _search(table, asks_, k + 1), _HIT)

    best = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    hits = home.union(away).select("qid", "score", F.explode("ids").alias("vec_id")).withColumn("__r", F.row_number().over(best)).filter(c("__r") <= k + 1).drop("__r")
    queries = rows.filter("asked").select(c("id").alias("query_id"), "v").join(asks.select("qid", c("q").alias("v")), "v").select("query_id", "qid")
    answers = queries.join(hits, "qid").filter("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id", "qid").orderBy(F.desc("score"), "vec_id")).cast("int")
    return answers.withColumn("rank", rank).filter(c("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH t AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * x.v[i])) AS BIGINT) AS score FROM t q JOIN t x ON q.vec_id <> x.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM s QUALIFY rank <= 5
"""
