"""Merkle manifest, exact top-k search and spelling variants against plain Python, on awkward tables."""

import math
import random
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import merkle, variants, vectors

DOCS = "doc_id long, text string, lang string, source string, n_chars long, pos int, tree string, block int"


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows):
    """{(doc_id, leaf): (subroot, root, proof, folded)} by whole trees."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: digest(*map(field, (r[0], r[3], r[2], r[4], text)))

    def tree(leaves):
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append([digest(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
        return levels

    def climb(levels, at, h):
        proof = []
        for level in levels[:-1]:
            run = level[at // 3 * 3 : at // 3 * 3 + 3]
            proof += [x for i, x in enumerate(run) if i != at % 3]
            h = digest(*[h if i == at % 3 else x for i, x in enumerate(run)])
            at //= 3
        return h, proof

    by = {}
    for r in rows:
        by.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = {}
    for k, s in enumerate(names):
        for i, (_, _, own, r) in enumerate(sorted(by[s], key=lambda x: x[:3])):
            odd = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[1] is not None
            h, proof = climb(trees[s], i, leaf(r, r[1].replace("\n", "")) if odd else own)
            folded, rest = climb(top, k, h)
            out[r[0], own, digest(*proof, *rest)] = (trees[s][-1][0], top[-1][0], folded)
    return out


def test_manifest_equals_whole_trees(spark):
    rows = [(i, f"line {i}\nnext\n" if i % 3 else "plain", "de", "hot", i, 1, "t", 2) for i in range(100)]
    rows += [(200 + i, None if i % 2 else "", None, None, None, 1, "t", 2) for i in range(5)] + [(300, "x\ny" * 20_000, "", "", 0, 1, "t", 2), (301, "é\n", "fr", "ünter", -1, 1, "t", 2)]
    rows += [(7, "another 7\n", "de", "hot", 3, 1, "t", 2), (None, "no id\n", "de", "hot", 3, 1, "t", 2)] + [(400 + i, "z\n", "de", f"s{i}", 1, 1, "t", 2) for i in range(12)]
    got = merkle.manifest_report(spark.createDataFrame(rows, DOCS), depth=2).collect()  # many blocks, three levels of them
    assert {(r["doc_id"], r["leaf"], r["proof_sha256"]): (r["subroot"], r["root"], r["folded_root"]) for r in got} == plain_manifest(rows)
    assert len(got) == len(rows) and all(r["verified"] == (r["root"] == r["folded_root"]) for r in got) and {r["verified"] for r in got} == {True, False}


def test_manifest_of_one_row_and_of_none(spark):
    one = spark.createDataFrame([(5, "a", "de", "s", 1, 1, "t", 2)], DOCS)
    (r,) = merkle.manifest_report(one).collect()
    assert r["leaf"] == r["subroot"] == r["root"] and r["proof_sha256"] == digest("")
    assert merkle.manifest_report(one.limit(0)).count() == 0
    twice = merkle.manifest_report(one.union(one)).collect()
    assert len(twice) == 2 and len({r["leaf"] for r in twice}) == 1 and twice[0]["proof_sha256"] == digest(twice[0]["leaf"]) and twice[0]["root"] == digest(twice[0]["leaf"], twice[0]["leaf"])


def test_top_k_equals_all_products(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.choice([-1.0, 0.0, 0.5, 1.0, 2.0]) for _ in range(rnd.choice([2, 2, 3]))]) for i in range(300)] + [(500 + i, [1.0, 1.0]) for i in range(100)]
    rows += [(600, None), (601, [None, 1.0]), (602, [float("nan"), 1.0]), (603, [float("inf"), 0.0]), (605, []), (610, []), (606, [7.0]), (None, [1.0, 1.0]), (608, [1e12, -1e12]), (10, [2.0, 2.0])]
    good = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and good(v)]
    want = Counter()
    for q, a in whole:
        if q % 5 == 0:
            best = sorted({(-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in whole if i != q and len(a) == len(b)} if q != 10 else [(-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in whole if i != q and len(a) == len(b)])
            want.update((q, k + 1, i, max(-(1 << 63), min((1 << 63) - 1, -s))) for k, (s, i) in enumerate(best[:5]))
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, b int, qid int")
    for block, portion in ((8192, 4096), (20, 7)):
        got = Counter(tuple(r) for r in vectors.top_k(df, F.col("vec_id") % 5 == 0, 5, block=block, portion=portion).collect())
        assert got == want
    assert vectors.top_k(df.limit(0), F.col("vec_id") % 5 == 0, 5).count() == 0


def test_a_tree_passes_over_what_its_bounds_rule_out():
    rnd = np.random.default_rng(1)
    centres = rnd.normal(size=(20, 16)) * 2000
    table = np.floor(np.repeat(centres, 200, 0) + rnd.normal(size=(4000, 16)) * 20).astype(np.int64)
    tree = vectors.Tree(table, list(range(4000)))
    pages = [n.page for n in tree.nodes if n.page is not None]
    assert sorted(np.concatenate([p[0] for p in pages]).tolist()) == list(range(4000))
    for at in range(0, 4000, 400):
        got = tree.best(table[at], 5)
        scores = table @ table[at]
        assert sorted(got, key=lambda x: (-x[0], x[1])) == [(int(scores[i]), int(i)) for i in np.lexsort((np.arange(4000), -scores))[:5]]
    for n in tree.nodes:  # radii cover and stored distances to the parent are true
        if n.below is not None:
            far = np.sqrt(((n.below[1] - tree.table[n.route]) ** 2).sum(1))
            assert np.allclose(far, n.below[3]) and (far <= n.radius + 1e-6).all()


def near(a, b):
    if len(a) < len(b):
        a, b = b, a
    return a != b and (sum(x != y for x, y in zip(a, b, strict=True)) == 1 if len(a) == len(b) else len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a))))


def test_variants_equal_all_pairs(spark):
    rnd = random.Random(1)
    words = sorted({"".join(rnd.choice("abcdé") for _ in range(rnd.randint(4, 6))) for _ in range(500)} | {"a" * 300, "a" * 301})
    n = {w: rnd.randint(2, 50) for w in words}
    want = {}
    for a in words:
        if found := [b for b in words if near(a, b)]:
            form = min(found, key=lambda b: (-n[b], b))
            want[a] = (len(found), form, n[form])
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    for page, searches in ((20_000, 80_000), (3, 20)):
        assert {r["word"]: (r["n_near"], r["form"], r["form_n"]) for r in variants.near_words(df, page, searches).collect()} == want


def test_words_are_counted_in_all_rows(spark):
    texts = {1: "Address ADDRESS addresses, adress×x", 2: None, 3: "", 4: "Straßenbahn " * 3000, 5: "straßenbahn-straßenbahm straßenbahm ÉCLAIRE éclaire", None: "Address-book 12abcdefg"}
    rows = [(k, t) for k, t in texts.items() for _ in range(3)]
    count = Counter()
    for k, t in rows:
        for run in "".join(c if c.isascii() and c.isalpha() or "À" <= c <= "ÿ" else " " for c in t or "").split():
            low = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if k is None else k}:{low}".encode())
            count[low if h % 31 else low[: h % len(low)] + low[h % len(low) + 1 :]] += 1
    kept = {w: c for w, c in count.items() if len(w) >= 7 and c > 1}
    got = variants.spelling_variants(spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id int, text string, n int, word string")).collect()
    assert {r["word"]: r["n"] for r in got} == kept
    best = {w: min((b for b in kept if near(w, b)), key=lambda b: (-kept[b], b), default=None) for w in kept}
    forms = {w: f if f and kept[f] >= 10 * kept[w] else None for w, f in best.items()}
    end = lambda w: end(forms[w]) if forms[w] else w
    assert {r["word"]: (r["form"], r["root"]) for r in got} == {w: (forms[w], end(w)) for w in kept} and any(forms.values())
    assert variants.spelling_variants(spark.createDataFrame([], "doc_id int, text string")).count() == 0


def test_chains_of_forms_end_at_their_last_word(spark):
    links = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(9)] + [("v", "w3")], "word string, form string")
    assert {r["word"]: r["root"] for r in variants.roots(links).collect()} == {**{f"w{i}": "w9" for i in range(9)}, "v": "w9"}
