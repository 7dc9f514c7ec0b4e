"""The text operators against brute force, on small fixtures with nulls, empty and long texts, ties and repeats."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from ledgerloom.llm import chat, dedup, jaccard, leaks, licenses, mixing, sharding, spans, toxicity, urls

DOCS = "doc_id long, text string, source string, lang string, n_chars long"


def prose(n, seed, vocabulary=400):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}{'.' if draw.random() < 0.1 else ''}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    base = [prose(n, n) for n in (1, 3, 4, 5, 7, 20, 60, 95, 130, 200, 300, 700)]
    out = list(base)
    draw = random.Random(5)
    for i, t in enumerate(base):  # near copies with more and more words changed
        words = t.split(" ")
        for share in (0.0, 0.01, 0.03, 0.05, 0.07, 0.2):
            changed = [w if draw.random() > share else f"x{draw.randrange(10**6)}" for w in words]
            out.append(" ".join(changed).upper() if i % 3 == 0 and share == 0 else " ".join(changed))
        out.append(t + " " + prose(len(words) // 4, i + 50))  # a superset
    out += [None, "", "   \n", "a b", "A  B", prose(9000, 3)]
    return [(i, t, None if i % 11 == 0 else f"src{i % 4}" if i % 3 else "src0", "en", 0) for i, t in enumerate(out)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def lower(t):
    return t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def jump(key, n):
    """The published algorithm."""
    key, b, j = key % 2**64, -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash_is_the_published_one(spark):
    from pyspark.sql import functions as F

    keys = spark.range(500).select(F.xxhash64("id").alias("k"))
    for n in (1, 2, 8, 9, 100):
        for r in keys.select("k", sharding.jump_hash(F.col("k"), n).alias("s")).collect():
            assert r["s"] == jump(r["k"], n)


def test_shards_move_only_into_the_new_one_and_slots_have_no_gap(spark, rows, docs, empty):
    repeated = docs.unionByName(docs.limit(20)).withColumn("slot", docs["doc_id"]).withColumn("shard", docs["doc_id"])
    got = sharding.shard_report(repeated).collect()
    assert len(got) == len(rows) + 20
    by = defaultdict(list)
    for r in got:
        assert r["grown_shard"] in (r["shard"], 8) and r["law"] == "key"
        t = dict((x[0], x[1]) for x in rows)[r["doc_id"]] or ""
        assert (r["size"], r["text_crc32"]) == (len(t.encode()) + 1, zlib.crc32(t.encode()))
        by[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    again = sharding.shard_report(repeated.repartition(7)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    assert sharding.shard_report(empty).count() == 0
    assert sharding.shard_report(spark.createDataFrame([(None, "a", None, None, None)] * 3, DOCS)).count() == 3


def shingles(t):
    w = lower(t or "").encode().split()
    k = min(5, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def brute_components(rows):
    sets = [(r[0], shingles(r[1])) for r in rows]
    root = {i: i for i, _ in sets}
    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return {(i, len(s), find(i)) for i, s in sets}


def test_jaccard_components(docs, rows, empty):
    assert {tuple(r) for r in jaccard.jaccard_components(docs).collect()} == brute_components(rows)
    assert jaccard.jaccard_components(empty).count() == 0


def test_signatures_guarantee_a_match():
    import numpy as np

    draw = np.random.default_rng(1)
    for size in (5, 30, 90, 100, 130, 250, 400, 1000):
        for grown in (0, size // 8, size // 3):
            a = np.unique(draw.integers(0, 2**63, size * 2, dtype=np.uint64))[::2][:size]
            cut = (size + grown) // 8 if not grown else 0
            b = np.unique(np.r_[a[cut:], draw.integers(0, 2**63, grown + cut if not grown else grown, dtype=np.uint64)])
            both = len(np.intersect1d(a, b))
            if 4 * both >= 3 * len(np.union1d(a, b)):
                (x, least), (y, most) = jaccard.signatures(a), jaccard.signatures(b)
                assert len(np.intersect1d(x, y)) >= max(least, most)
                assert len(np.intersect1d(a[: jaccard.prefix(len(a))], b[: jaccard.prefix(len(b))])) >= max(jaccard.need(len(a)), jaccard.need(len(b)))


def test_small_sets_share_as_many_signatures_as_they_ask_for():
    import numpy as np

    draw = np.random.default_rng(7)
    links = 0
    for size in [*range(1, 41), 60, 120]:
        for _ in range(120):
            a = np.unique(draw.integers(0, 2**63, size, dtype=np.uint64) << np.uint64(1))
            gone, fresh = draw.integers(0, size // 4 + 1), draw.integers(0, size // 3 + 1)
            b = np.unique(np.r_[draw.permutation(a)[gone:], draw.integers(0, 2**63, fresh, dtype=np.uint64) << np.uint64(1)])
            both = len(np.intersect1d(a, b))
            if both < max(len(a), len(b)) and 7 * both >= 3 * (len(a) + len(b)):
                links += 1
                (x, least), (y, most) = jaccard.signatures(a), jaccard.signatures(b)
                assert len(np.intersect1d(x, y)) >= max(least, most) >= 1, (len(a), len(b), both)
    assert links > 1000


def test_benchmark_words_are_held_a_block_at_a_time(spark, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * 7 + j) % 300}" for j in range(60))) for i in range(20)], "doc_id long, text string")
    items = spark.createDataFrame([(f"b{i}", " ".join(f"w{(i * 11 + j) % 320}" for j in range(14))) for i in range(25)], "item_id string, text string")
    want = sorted(map(tuple, leaks.decontaminate(docs, items).select("doc_id", "n_hit", "items_sha256").collect()))
    alive, most, real = [0], [0], leaks._blocks

    class Held(frozenset):
        def __new__(cls, words):
            alive[0] += 1
            most[0] = max(most[0], alive[0])
            return super().__new__(cls, words)

    def watched(words, least=0):
        for block in real(words, least):
            yield Held(block)
            alive[0] -= 1  # asked for the next one: the last is done with

    monkeypatch.setattr(leaks, "BLOCK_TERMS", 50)
    monkeypatch.setattr(leaks, "_blocks", lambda words, least=0: (frozenset(b) for b in watched(words, least)))
    assert sorted(map(tuple, leaks.decontaminate(docs, items).select("doc_id", "n_hit", "items_sha256").collect())) == want and most[0] == 1 and any(w[1] for w in want)


def test_pairs_found_only_by_signatures(spark):
    """A chain of sets whose least features differ on purpose still links."""
    base = [f"t{i}" for i in range(240)]
    texts = [" ".join(base), " ".join(base[30:] + [f"z{i}" for i in range(10)]), " ".join(base[25:])]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    assert {tuple(r) for r in jaccard.jaccard_components(spark.createDataFrame(rows, DOCS)).collect()} == brute_components(rows)


def test_mixing_meets_targets(docs, rows, empty, spark):
    out = mixing.mix_report(docs).collect()
    assert len(out) == len(rows)
    source = {r[0]: r[2] for r in rows}
    size = {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows}
    names = sorted({s for s in source.values() if s is not None}) + [None]
    total = Counter()
    for i, n in size.items():
        total[source[i]] += n
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(size.values())
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * total[s]}
        if not full:
            target |= share
            break
        for s in full:
            target[s] = 2.0 * total[s]
            left -= 2 * total[s]
        open_ -= full
    taken = Counter()
    for r in out:
        s = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == total[s] and abs(r["target"] - target[s]) < 1e-6
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 0.5 + 1e-6 for s in names)
    assert sorted(map(tuple, out)) == sorted(map(tuple, mixing.mix_report(docs.repartition(5)).collect()))
    assert mixing.mix_report(empty).count() == 0
    assert [r["taken"] for r in mixing.mix_report(spark.createDataFrame([(1, None, "a", None, None)], DOCS)).collect()] == [0]


def test_decontamination(spark, docs, rows, empty):
    text = {r[0]: r[1] for r in rows}
    items = [(1, " ".join(text[10].split(" ")[5:40])), (2, text[3]), (3, None), (4, "nothing of this kind"), (2, text[3]), (5, text[9].upper()), (6, "W1?")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    words = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or "").encode())
    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 9)):
            if w:
                windows[tuple(w[k : k + 10])].add(str(i))
    want = set()
    for r in rows:
        w = words(r[1])
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[x]
        want.add((r[0], len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert {tuple(r) for r in leaks.decontaminate(docs, bench).select(columns).collect()} == want
    assert sum(x[-1] for x in want) > 5
    assert leaks.decontaminate(empty, bench).count() == 0
    assert leaks.decontaminate(docs, bench.limit(0)).filter("contaminated").count() == 0
    split = text[10].split(" ")[5:40]
    near = leaks.decontaminate(spark.createDataFrame([(1, " ".join(split[:20] + ["extra"] + split[20:]), None, None, None), (None, "x", None, None, None)], DOCS), bench, slop=2).collect()
    assert len(near) == 2


def test_levenshtein_automaton_meets_brute_force():
    def distance_to_prefix(word, term, stem):
        d = list(range(len(word) + 1))
        for i, c in enumerate(term, 1):
            e = [i]
            for j, w in enumerate(word, 1):
                e.append(min(d[j] + 1, e[j - 1] + 1, d[j - 1] + (c != w)))
            d = e
        return min(d) if stem else d[-1]

    trie = toxicity.Trie({"idiot": 2.0, "moron": 1.0, "worthless": 3.0})
    draw = random.Random(2)
    for term in ("idiot", "moron", "worthless"):
        for _ in range(300):
            w = list(term)
            for _ in range(draw.randrange(3)):
                k = draw.randrange(len(w))
                w[k : k + 1] = draw.choice([[], [draw.choice("aeot")], [w[k], draw.choice("aeot")]])
            word = "".join(w)
            near = min(distance_to_prefix(word, t, False) for t in ("idiot", "moron", "worthless"))
            edits = trie.match(word)[1]
            assert (edits == 0) == (near == 0)
            if len(word) >= toxicity.FUZZY_FROM:
                assert (edits == 1) == (near == 1)


def test_toxicity_learns_and_quotes(spark):
    draw = random.Random(3)
    bad = ("idiot", "moron", "trash", "worthless")
    rows, labels = [], []
    for i in range(1200):
        words = [f"w{draw.randrange(300)}" for _ in range(40)]
        toxic = i % 8 == 0
        if toxic:
            for _ in range(3):
                words.insert(draw.randrange(40), draw.choice(bad) if draw.random() < 0.8 else "idiott")
        rows.append((i, " ".join(words) if i != 7 else None, "s", "en", 0))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, DOCS)
    marks = spark.createDataFrame([*labels, (None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in toxicity.toxicity_report(docs, marks).collect()}
    assert len(out) == 1200
    held = [r for r in out.values() if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in out.items())
    right = sum(r["predicted"] == (r["doc_id"] % 8 == 0) for r in held) / len(held)
    assert right > 0.97 and all(0 <= r["score"] <= 1 for r in out.values())
    trie = toxicity.Trie({"idiot": 2.0})
    assert toxicity.features('he said "you idiot" and left', trie)[3] == 1 and toxicity.features("you idiot, you", trie)[1] == 1
    assert toxicity.toxicity_report(docs.limit(0), marks).count() == 0
    assert toxicity.toxicity_report(docs.limit(5), marks.limit(0)).count() == 5


def test_misspelt_forms_of_a_stem_are_found(spark):
    """A family of words of which only beginnings stay in the lexicon."""
    draw, rows = random.Random(6), []
    family = ["idiot", "idiots", "idiotic", "idiotas", "idiotie"]
    for i in range(1500):
        words = [f"w{draw.randrange(300)}" for _ in range(30)]
        if i % 5 == 0:
            words[draw.randrange(30)] = draw.choice(family)
        rows.append((" ".join(words), int(i % 5 == 0), i % 4))
    model = toxicity.learn(spark.createDataFrame(rows, "text string, label int, part int"))
    assert any(t.endswith("*") for t in model["terms"]) and not set(family) & set(model["terms"])
    trie = toxicity.Trie(model["terms"])
    assert [trie.match(w)[1] for w in ("idiot", "idiotic", "1diot", "iidiot", "xdiotic", "idots")] == [0, 0, 1, 1, 1, 1]
    assert trie.match("w123")[1] < 0 and trie.match("completely")[1] < 0


def test_license_scan(spark, empty):
    apache = "Licensed under the Apache License, Version 2.0."
    texts = [prose(50, 1) + "\n" + apache, "released UNDER the mit license", prose(90, 2), None, "", prose(400, 3) + " This work is licensed under the GNU General Public Licence, version 3. " + prose(400, 4),
             "This work is licensed under the GNU General Public License, version 3.", apache + " " + apache, "Licensed under the"]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    got = {(r["doc_id"], r["license"]): (r["containment_bp"], r["at"]) for r in licenses.scan(docs).collect()}
    assert got[(0, "Apache-2.0")] == (10000, len(re.findall(r"\w+", prose(50, 1)))) and got[(1, "MIT")] == (10000, 0) and got[(6, "GPL-3.0")] == (10000, 0) and got[(7, "Apache-2.0")] == (10000, 0)
    assert {k[0] for k in got} == {0, 1, 6, 7}
    assert licenses.scan(empty).count() == 0


def test_license_bodies_meet_brute_force(spark):
    """Near copies of bodies and headers inside prose, against containment over all windows."""
    def cut(t):
        w = re.findall(r"[^\W_]+", t.lower())
        return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]

    draw, texts = random.Random(21), []
    for _, t in licenses.TEMPLATES[4:]:
        for share in (0.0, 0.01, 0.03):
            body = " ".join(w if draw.random() >= share else f"x{draw.randrange(99)}" for w in t.split())
            texts.append(f"{prose(60, len(texts))} {body} {prose(60, len(texts) + 500)}")
    want = set()
    for i, text in enumerate(texts):
        h = cut(text)
        for name, t in licenses.TEMPLATES:
            known, n = set(cut(t)), len(cut(t))
            if max(len(known & set(h[k : k + n])) for k in range(len(h))) >= 0.75 * len(known):
                want.add((i, name))
    got = {(r["doc_id"], r["license"]) for r in licenses.scan(spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)).collect()}
    assert want <= got and {n for _, n in want} == {"MIT", "BSD", "ISC", "Apache-2.0", "GPL-3.0", "MPL-2.0"}


def test_exact_dedup(docs, rows, empty, spark):
    groups = defaultdict(list)
    for r in rows:
        groups[lower(r[1] or "")].append(r[0])
    want = {(i, max(g), len(g), i == max(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g}
    assert {tuple(r) for r in dedup.dedup_report(docs).collect()} == want
    assert dedup.dedup_report(empty).count() == 0
    nameless = spark.createDataFrame([(None, "Ä", None, None, None), (None, "ä", None, None, None), (2, "Ä", None, None, None)], DOCS)
    got = sorted((r["doc_id"] or 0, r["keep_id"], r["group_size"], r["kept"]) for r in dedup.dedup_report(nameless).collect() if r["keep_id"])
    assert got == [(0, 2, 2, False), (2, 2, 2, True)]


def test_rows_without_a_key_are_cut_in_parts(spark):
    """A third of all rows and more share a key, or have none: the mix is the one that an ordered list gives."""
    draw = random.Random(9)
    rows = [(None, " ".join(["w"] * draw.randrange(4)), "a", None, None) for _ in range(500)] + [(7, "w w", "b", None, None)] * 400 + [(i, "w " * draw.randrange(9), "ab"[i % 2], None, None) for i in range(300)]
    out = mixing.mix_report(spark.createDataFrame(rows, DOCS).repartition(7)).collect()
    assert len(out) == len(rows)
    by_key = defaultdict(list)
    for r in out:
        by_key[r["target"], r["source_size"], r["doc_id"]].append(r)
    for target, size in {k[:2] for k in by_key}:
        group = [r for k, found in by_key.items() if k[:2] == (target, size) for r in found]
        goal = int(target + 0.5)
        assert sum(r["taken"] for r in group) == goal
        left, want = goal - goal // size * size, []
        for r in sorted(group, key=lambda r: (int(hashlib.md5(("" if r["doc_id"] is None else str(r["doc_id"])).encode()).hexdigest()[:15], 16), r["doc_id"] is not None, r["size"])):
            want.append((r["doc_id"], r["size"], goal // size * r["size"] + max(0, min(r["size"], left))))
            left -= r["size"]
        assert Counter((r["doc_id"], r["size"], r["taken"]) for r in group) == Counter(want)


def test_chat_round_trip(spark):
    hard = ["<|im_end|>", "a\\", "<|", "\\<|im_start|>user\nx", "", None, "ends <", "␤\\n\n\\␤", "é" * 3]
    rows = [(c, t, role, hard[(c + t) % len(hard)]) for c in range(9) for t, role in enumerate(["system", "user", "assistant", "assistant", "odd\nrole\\␤<|"])]
    rows += [(3, 2, "assistant", "tie"), (3, 2, "assistant", "tie"), (4, None, None, None)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((-1 if t is None else t, r or "", x or ""))
    got = {r["conv_id"]: r for r in chat.read_back(chat.render(chat.turn_rows(table))).collect()}
    for c, turns in by.items():
        turns.sort()
        assert [(t["role"], t["text"]) for t in got[c]["turns"]] == [(r, x) for _, r, x in turns]
        assert got[c]["learned"] == "".join(x for _, r, x in turns if r == "assistant")
    assert chat.chat_report(table.limit(0)).count() == 1


def test_layouts_are_chosen_by_fingerprint(spark):
    table = spark.createDataFrame([(1, [("user", "q"), ("assistant", "a")])], "conv_id long, messages array<struct<role:string,content:string>>")
    assert chat.layout_of(table) == "messages" and [tuple(r) for r in chat.turn_rows(table).orderBy("turn").collect()] == [(1, 0, "user", "q"), (1, 1, "assistant", "a")]
    with pytest.raises(ValueError):
        chat.layout_of(table.withColumnRenamed("messages", "other"))
    records = ['{"prompt": "p", "response": "r"}', '{"instruction": "i", "input": "n", "output": "o"}', '{"messages": [{"role": "user", "content": "c"}]}', '{"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]}', "no json", '{"x": 1}', None]
    turns, rejects = chat.json_turn_rows(spark.createDataFrame(list(enumerate(records)), "conv_id long, record string"))
    assert sorted((r["conv_id"], r["turn"], r["role"], r["text"]) for r in turns.collect()) == [(0, 0, "user", "p"), (0, 1, "assistant", "r"), (1, 0, "user", "i\n\nn"), (1, 1, "assistant", "o"), (2, 0, "user", "c"), (3, 0, "user", "h"), (3, 1, "assistant", "g")]
    assert {r["conv_id"] for r in rejects.collect()} == {4, 5, 6}


def test_url_rules_and_graph(spark):
    pages = [(1, "HTTP://A.Example.COM/en/x?q", ""), (2, "http://www.example.com/en/", ""), (3, "http://b.net/es/1", '<a href="http://c.org/">'), (4, "http://b.net/fr/", None), (5, "nothing", ""), (6, None, None),
             (7, "http://com", ""), (8, "http://d.org/", '<a href="//b.net/es/9">x</a>'), (12, "http://f.org/", '<a href="http://d.org/">x</a>'), (9, "http://xcom/", ""), (10, "http://e.org/x", ""), (10, "http://e.org/x", ""), (11, "http://c.com/", '<a href="http://e.org">')]
    got = [tuple(r)[:5] for r in urls.judge(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()]
    by = dict((r[0], r[1:]) for r in got)
    assert len(got) == len(pages)
    assert by[1] == ("a.example.com", "/en/x", "example.com/en/", "block") and by[2] == ("www.example.com", "/en/", "www.example.com/en/", "allow")
    assert by[3] == ("b.net", "/es/1", "net/es/", "block") and by[5] == ("", "", None, "allow") and by[6] == ("", "", None, "allow")
    assert by[7] == ("com", "", None, "allow") and by[9][2] is None and by[11][2:] == ("com/", "allow")
    assert by[8] == ("d.org", "/", None, "block")  # it links to a blocked host
    assert by[12][3] == "block" and by[10][3] == "allow"  # two links away, and none
    assert urls.judge(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pagerank_meets_brute_force(spark):
    draw = random.Random(4)
    edges = sorted({(f"h{draw.randrange(12)}", f"h{draw.randrange(12)}") for _ in range(40)})
    edges = [e for e in edges if e[0] != e[1]]
    hosts = [f"h{i}" for i in range(12)]
    seeds = {"h0": (1.0, 0.0), "h1": (0.25, 0.5), "h7": (0.0, 1.0)}

    def walk(links, start):
        s, out = dict(start), Counter(a for a, _ in links)
        for _ in range(250):
            s = {h: start[h] + 0.85 * sum(s[a] / out[a] for a, b in links if b == h) for h in hosts}
        return s

    trust = walk(edges, {h: seeds.get(h, (0, 0))[0] for h in hosts})
    distrust = walk([(b, a) for a, b in edges], {h: seeds.get(h, (0, 0))[1] for h in hosts})
    table = lambda rows, schema: spark.createDataFrame(rows, schema)
    given = table([(h, *w) for h, w in seeds.items()], "host string, trust double, distrust double")
    got = urls.spread(table([(h,) for h in hosts], "host string"), table(edges, "src string, dst string"), given, tolerance=1e-7).collect()
    assert len(got) == 12 and all(abs(r["trust"] - trust[r["host"]]) < 1e-5 and abs(r["distrust"] - distrust[r["host"]]) < 1e-5 for r in got)


def test_verdicts_do_not_move_with_hosts_elsewhere(spark):
    """A chain of links to a blocked host: distrust shrinks by the damping with each link, whatever other hosts there are."""
    schema = "page_id long, url string, html string"
    chain = [(i, f"http://c{i}.org/", f'<a href="http://c{i + 1}.org/">') for i in range(20)] + [(20, "http://c20.org/", '<a href="http://bad.net/">'), (21, "http://bad.net/es/", "")]
    elsewhere = [(100 + i, f"http://o{i}.{('org', 'com', 'net')[i % 3]}/es/", "") for i in range(600)]
    alone = {r["page_id"]: r["verdict"] for r in urls.judge(spark.createDataFrame(chain, schema)).collect()}
    among = {r["page_id"]: r["verdict"] for r in urls.judge(spark.createDataFrame(chain + elsewhere, schema)).collect()}
    assert alone == {i: among[i] for i in alone}
    assert alone == {i: "block" if 0.85 ** (21 - i) > 0.1 else "allow" for i in range(22)}


def test_repeated_passages_go_but_for_the_first(spark, empty):
    passage = prose(70, 77, 10**6) + "."
    long_one = " ".join(f"q{i}" for i in range(80)) + "."
    texts = [prose(60, i + 900, 10**6) + ".\n" for i in range(8)]
    rows = [(1, texts[0] + passage + "\n" + texts[1]), (2, texts[2] + passage.upper() + "\n" + texts[3]), (3, texts[4] + long_one + " " + texts[5]), (4, long_one + "\n" + texts[6]), (5, texts[7]), (6, None), (7, ""), (8, "Of. In. It."), (9, "Of. In. It."), (5, texts[7])]
    docs = spark.createDataFrame([(i, t, "s", "en", 0) for i, t in rows], DOCS)
    got = defaultdict(list)
    for r in spans.remove_spans(docs).collect():
        got[r["doc_id"]].append(r)
    assert [k for k in sorted(got) if got[k][0]["changed"]] == [2, 4]
    assert got[2][0]["text"].strip() == (texts[2] + texts[3]).strip() and len(got[5]) == 2
    kept = got[4][0]["text"].split()
    assert sum(w.startswith("q") for w in kept) < 20 and got[6][0]["text"] is None and got[7][0]["text"] == ""
    assert spans.remove_spans(empty).count() == 0


def test_touching_stretches_become_one():
    import pyarrow as pa

    draw, lists = random.Random(2), [[]]
    for _ in range(200):
        lists.append(sorted({(a := draw.randrange(300)) << 32 | (a + draw.randrange(1, 40)) for _ in range(draw.randrange(12))}))
    batch = pa.RecordBatch.from_arrays([pa.array(range(201)), pa.array(range(201)), pa.array(lists, pa.list_(pa.int64()))], names=["key", "th", "spans"])
    for whole, found in zip(lists, next(spans._merged(iter([batch]))).column(2).to_pylist(), strict=True):
        words = {w for x in whole for w in range(x >> 32, x & 0xFFFFFFFF)}
        assert {w for x in found for w in range(x >> 32, x & 0xFFFFFFFF)} == words
        assert all(b >> 32 > a & 0xFFFFFFFF for a, b in zip(found, found[1:]))


def test_passages_inside_other_sentences_meet_a_search_by_words(spark):
    """Passages of 51 words and more at random words of other documents, with and without sentences' ends, against all repeated runs of words."""
    draw, rows = random.Random(12), []
    for trial in range(150):
        for stops in (0.0, 0.06, 0.2):
            def text(n):
                return [f"t{draw.randrange(3000)}{'.' if draw.random() < stops else ''}" for _ in range(n)]

            passage = text(draw.choice((51, 60, 80)))
            for _ in range(2):
                around, k = text(90), draw.randrange(91)
                words = [*around[:k], *passage, *around[k:]]
                rows.append((len(rows), "".join(w + draw.choice((" ", " ", " ", "\n")) for w in words), "s", "en", 0))
    got = {r["doc_id"]: r["text"] for r in spans.remove_spans(spark.createDataFrame(rows, DOCS)).collect()}
    seen: set = set()
    for i, t, *_ in rows:
        words = t.split()
        repeated = set()
        for k in range(len(words) - spans.RUN_WORDS + 1):
            run = tuple(words[k : k + spans.RUN_WORDS])
            if run in seen:
                repeated |= set(range(k, k + spans.RUN_WORDS))
        seen |= {tuple(words[k : k + spans.RUN_WORDS]) for k in range(len(words) - spans.RUN_WORDS + 1)}
        gone = len(words) - len(got[i].split())
        assert len(repeated) >= 51 if i % 2 else not repeated
        assert max(0, len(repeated) - 2 * spans.WINDOW - 2) <= gone <= len(repeated)


def test_pipeline(spark, docs, tmp_path, monkeypatch):
    import corpus_pipeline

    draw = random.Random(8)
    rows = []
    for i in range(300):
        words = [f"v{draw.randrange(500)}" for _ in range(60)]
        if i % 10 == 0:
            words[5:5] = ["idiot", "moron", "idiot"]
        rows.append((i, " ".join(words), f"src{i % 3}", "en", 0))
    rows += [(300 + i, rows[i + 1][1] + " end", "src0", "en", 0) for i in range(5)] + [(400, None, None, None, None), (None, "no key", "src1", None, None)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 10 == 0)) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, rows[33][1])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = Counter(r["doc_id"] for r in out)
    assert not any(i is not None and i < 300 and i % 10 == 0 for i in ids) and 33 not in ids and not any(300 <= (i or 0) < 305 for i in ids)
    assert max(ids.values()) <= 2 and {"shard", "grown_shard"} < set(out[0].asDict())
    size = sum(len((r["text"] or "").split()) for r in out)
    clean = [i for i in range(300) if i % 10 and i != 33]
    assert abs(size - 1.5 * 60 * len(clean)) < 400
