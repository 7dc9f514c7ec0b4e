"""Merkle manifest of a dataset as a persistent tree with path copying (Driscoll and others, 1989; Merkle, 1987).

Rows are leaves. Each source has a tree in which every three consecutive nodes have a parent; the sources' roots, in order,
are the leaves of one tree above them. A changed leaf makes a new version of the tree that shares all nodes but the leaf's
ancestors, which are copied; so a version costs one node a level, however large the tree is.

A tree is cut into aligned blocks of 3^levels leaves. One task holds one block: it builds the block's nodes, and copies the
ancestors of each changed leaf up to the block's root. The roots of the blocks are the leaves of the next blocks, until one is
left. What a node needs from above its block, the siblings of its block's ancestors, is one short list for the whole block.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.order import placed
from ledgerloom.plans.common import checkpointed, join_checked

ARITY = 3
#: Levels of a block, which has 729 leaves at most.
LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """A field so that no two lists of fields read alike: - for null, else bytes, colon, value."""
    shown = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown), F.lit("-"))


def leaf(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(f) for f in fields]), 256)


def joined(digests: list[str]) -> str:
    """The digest of digests, put together as hex text."""
    return sha256("".join(digests).encode()).hexdigest()


def nodes_of(leaves: list[str], n: int, depth: int) -> list[list[str]]:
    """All levels of a block's nodes, leaves first. A tree of n leaves that fits a block ends at one node; else each block is depth levels high."""
    levels = [leaves]
    while len(levels[-1]) > 1 if n <= ARITY**depth else len(levels) <= depth:
        below = levels[-1]
        levels.append([joined(below[i : i + ARITY]) for i in range(0, len(below), ARITY)])
    return levels


def siblings_of(levels: list[list[str]], at: int) -> list[tuple[list[str], list[str]]]:
    """Of the node at a place its siblings and those of its ancestors, level by level: to the left, to the right."""
    out = []
    for level in levels[:-1]:
        first = at - at % ARITY
        out.append((level[first:at], level[at + 1 : first + ARITY]))
        at //= ARITY
    return out


def version(above: list[tuple[list[str], list[str]]], changed: str) -> list[str]:
    """Path copying: the new leaf and the copies of its ancestors. All other nodes are those of the version before."""
    path = [changed]
    for left, right in above:
        path.append(joined([*left, path[-1], *right]))
    return path


_ABOVE = "array<struct<l: array<string>, r: array<string>>>"


def _block_roots(nodes: DataFrame, depth: int) -> DataFrame:
    """(tree, pos, n, digest) of the blocks of nodes (tree, block, pos, n, digest): pos counts blocks."""
    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by("pos")
        n = rows["n"][0].as_py()
        top = nodes_of(rows["digest"].to_pylist(), n, depth)[-1][0]
        return pa.table({"tree": rows["tree"][:1], "pos": rows["block"][:1], "n": pa.array([-(-n // ARITY**depth)], pa.int64()), "digest": [top]})

    return nodes.groupBy("tree", "block").applyInArrow(run, "tree string, pos long, n long, digest string")


def _paths(nodes: DataFrame, depth: int) -> DataFrame:
    """(tree, pos, above, root) of few nodes (tree, pos, n, digest): siblings of each from its own level to the root.

    The rows are block roots, or one a source. Blocks are held one at a time; where a tree has more than
    one block, their roots are taken in the same way, and their siblings follow.
    """
    wide = ARITY**depth
    nodes = nodes.withColumn("block", F.expr(f"pos div {wide}"))

    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by("pos")
        levels = nodes_of(rows["digest"].to_pylist(), rows["n"][0].as_py(), depth)
        above = [[{"l": a, "r": b} for a, b in siblings_of(levels, i)] for i in range(rows.num_rows)]
        kind = pa.list_(pa.struct([("l", pa.list_(pa.string())), ("r", pa.list_(pa.string()))]))
        return pa.table({"tree": rows["tree"], "block": rows["block"], "pos": rows["pos"], "n": rows["n"], "above": pa.array(above, kind), "root": pa.array([levels[-1][0]] * rows.num_rows)})

    own = checkpointed(nodes.groupBy("tree", "block").applyInArrow(run, f"tree string, block long, pos long, n long, above {_ABOVE}, root string"))
    if own.filter(F.col("n") > wide).isEmpty():
        return own.select("tree", "pos", "above", "root")
    tops = own.groupBy("tree", "block").agg(F.first("root").alias("digest"), F.first("n").alias("n"))
    upper = _paths(tops.select("tree", F.col("block").alias("pos"), F.expr(f"(n + {wide - 1}) div {wide}").alias("n"), "digest"), depth)
    upper = checkpointed(upper.select(F.col("tree").alias("__t"), F.col("pos").alias("__b"), F.col("above").alias("__above"), F.col("root").alias("__root")))
    both = join_checked(own, upper, (F.col("tree") == F.col("__t")) & (F.col("block") == F.col("__b")))
    return both.select("tree", "pos", F.concat("above", "__above").alias("above"), F.col("__root").alias("root"))


def manifest(docs: DataFrame, changed: Column, changes: dict[str, Column], key: str = "doc_id", tree: str = "source", fields: tuple[str, ...] = FIELDS, depth: int = LEVELS) -> DataFrame:
    """One row for each of docs: key, leaf, subroot, root, proof_sha256, folded_root and verified.

    Leaves of a tree ascend by key. changed says which rows a later copy of the data may hold in another form, changes what
    their fields read then; folded_root is the root of the version that this one changed leaf makes, and verified whether it
    is still the root. proof_sha256 is the digest of the siblings from leaf to root.

    A null tree comes first, then trees by bytes. Rows that repeat a key are leaves of their own, in the order of their leaf's
    digest, so equal rows may change places and nothing else changes; null keys come first. Null fields differ from empty
    ones. Texts are hashed whole where they lie, and only digests are shuffled. An empty table gives no rows and has no root.
    Other columns are not read. Each of fields must exist. Blocks are depth levels high.
    """
    c = F.col
    name = F.coalesce(F.concat(F.lit("s"), c(tree).cast("string")), F.lit(""))
    after = [changes.get(f, c(f)) for f in fields]
    digest = leaf([c(f) for f in fields])
    rows = docs.select(c(key).cast("long").alias("key"), name.alias("tree"), digest.alias("leaf"), F.when(F.coalesce(changed, F.lit(False)), leaf(after)).alias("later"))
    rows = rows.withColumn("later", F.nullif("later", "leaf"))
    leaves = placed(checkpointed(rows), "tree", [c("key"), c("leaf")])
    leaves = checkpointed(leaves.withColumn("block", F.expr(f"pos div {ARITY**depth}")))
    below = checkpointed(_block_roots(leaves.select("tree", "block", "pos", "n", c("leaf").alias("digest")), depth))
    upper = checkpointed(_paths(below, depth).withColumnRenamed("root", "subroot"))
    subroots = checkpointed(upper.groupBy("tree").agg(F.first("subroot").alias("digest")))
    sources = checkpointed(placed(subroots.select(F.lit("").alias("all"), c("tree").alias("name"), "digest"), "all", [c("name")]))
    tops = _paths(sources.select(c("all").alias("tree"), "pos", "n", "digest"), depth)
    named = checkpointed(sources.select(c("name").alias("__tree"), c("pos").alias("__pos")).join(tops.select(c("pos").alias("__p"), c("above").alias("__above"), "root"), F.expr("__pos = __p")).drop("__p", "__pos"))
    heads = join_checked(upper, named, c("tree") == c("__tree")).select("tree", c("pos").alias("block"), F.concat("above", "__above").alias("above"), "subroot", "root")

    def run(table: pa.Table, head: pa.Table) -> pa.Table:
        rows, (head,) = table.sort_by("pos"), head.to_pylist()
        levels = nodes_of(rows["leaf"].to_pylist(), rows["n"][0].as_py(), depth)
        rest = [(x["l"], x["r"]) for x in head["above"]]
        shared = "".join(d for x in rest for side in x for d in side).encode()
        proofs, folded = [], []
        for i, later in enumerate(rows["later"].to_pylist()):
            above = siblings_of(levels, i)
            proofs.append(sha256("".join(d for x in above for side in x for d in side).encode() + shared).hexdigest())
            # An unchanged leaf makes the same version again.
            folded.append(head["root"] if later is None else version(rest, version(above, later)[-1])[-1])
        out = {"key": rows["key"], "leaf": rows["leaf"], "subroot": [head["subroot"]] * len(folded), "root": [head["root"]] * len(folded), "proof_sha256": proofs, "folded_root": folded}
        return pa.table({k: v if isinstance(v, pa.ChunkedArray) else pa.array(v, pa.string()) for k, v in out.items()})

    both = leaves.groupBy("tree", "block").cogroup(heads.groupBy("tree", "block"))
    out = both.applyInArrow(run, "key long, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return out.select(c("key").alias(key), "leaf", "subroot", "root", "proof_sha256", "folded_root", (c("folded_root") == c("root")).alias("verified"))


def manifest_report(docs: DataFrame, depth: int = LEVELS) -> DataFrame:
    """manifest() of documents, of which those whose doc_id's CRC-32 is even may have lost their line feeds."""
    odd = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return manifest(docs, odd, {"text": F.replace(F.col("text").cast("string"), F.lit("\n"), F.lit(""))}, depth=depth)


#: CRC-32 of {x}, text of ASCII or UTF-8, in SQL that has lambdas and no such function: byte by byte, by the list crc_t of the one row of `crc`.
CRC_TABLE = """crc AS (SELECT list(x ORDER BY i) AS crc_t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS x FROM range(256) r(i)))"""
CRC_OF = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen({x})), lambda j: ('0x' || substr(hex(encode({x})), 2 * j + 1, 2))::BIGINT)), lambda a, b: xor(a >> 8, crc_t[xor(a & 255, b) + 1])), 4294967295)"
_FIELDS = " || ".join(f"coalesce(strlen({f}::VARCHAR) || ':' || {f}::VARCHAR, '-')" for f in FIELDS)
ORACLE = f"""
WITH RECURSIVE {CRC_TABLE},
d AS (SELECT *, {CRC_OF.format(x="doc_id::VARCHAR")} % 2 = 0 AS odd FROM documents, crc),
lf AS (SELECT doc_id, coalesce('s' || source, '') AS tree, sha256({_FIELDS}) AS leaf, sha256({_FIELDS.replace("text", "t")}) AS later
       FROM (SELECT *, CASE WHEN odd THEN replace(text, chr(10), '') ELSE text END AS t FROM d)),
pl AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM lf),
lv AS (SELECT tree, 0 AS l, pos, n, leaf AS digest FROM pl
       UNION ALL SELECT tree, l + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM lv WHERE n > 1 GROUP BY tree, l, pos // 3, n),
sr AS (SELECT tree, digest AS subroot, max(l) AS l FROM lv WHERE n = 1 GROUP BY tree, digest),
sp AS (SELECT tree, subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM sr),
tv AS (SELECT 0 AS l, pos, n, subroot AS digest FROM sp
       UNION ALL SELECT l + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM tv WHERE n > 1 GROUP BY l, pos // 3, n),
lr AS (SELECT a.tree, a.l, a.pos, a.n, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS lf, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS rt
       FROM lv a JOIN lv b ON a.tree = b.tree AND a.l = b.l AND a.pos // 3 = b.pos // 3 GROUP BY 1, 2, 3, 4),
tr AS (SELECT a.l, a.pos, a.n, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS lf, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS rt
       FROM tv a JOIN tv b ON a.l = b.l AND a.pos // 3 = b.pos // 3 GROUP BY 1, 2, 3),
fd AS (SELECT doc_id, tree, 0 AS l, pos, n, later AS h, '' AS proof FROM pl
       UNION ALL SELECT doc_id, fd.tree, fd.l + 1, fd.pos // 3, (fd.n + 2) // 3, sha256(lf || h || rt), proof || lf || rt FROM fd JOIN lr ON fd.tree = lr.tree AND fd.l = lr.l AND fd.pos = lr.pos WHERE fd.n > 1),
tf AS (SELECT doc_id, 0 AS l, sp.pos, sp.n, h, proof FROM fd JOIN sp ON fd.tree = sp.tree WHERE fd.n = 1
       UNION ALL SELECT doc_id, tf.l + 1, tf.pos // 3, (tf.n + 2) // 3, sha256(lf || h || rt), proof || lf || rt FROM tf JOIN tr ON tf.l = tr.l AND tf.pos = tr.pos WHERE tf.n > 1)
SELECT pl.doc_id, leaf, subroot, (SELECT digest FROM tv WHERE n = 1) AS root, sha256(proof) AS proof_sha256, h AS folded_root, h = (SELECT digest FROM tv WHERE n = 1) AS verified
FROM pl JOIN sp ON pl.tree = sp.tree JOIN tf ON pl.doc_id = tf.doc_id WHERE tf.n = 1
"""
