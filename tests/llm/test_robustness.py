"""Every operator and stage on awkward tables: clashing, dotted and map-typed columns, repeated rows, nulls, long texts and no rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import chat, dedup, jaccard, leaks, licenses, mixing, sharding, spans, toxicity, urls

DOCS = "doc_id long, text string, source string, lang string, n_chars long"


def prose(n, seed, vocabulary=3000):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}{'.' if draw.random() < 0.1 else ''}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    texts = [prose(80, i) for i in range(12)] + [prose(80, 1) + " end", prose(80, 2).upper(), None, "", "   ", prose(30000, 99), "one two"]
    out = [(i, t, None if i % 5 == 0 else f"s{i % 3}", "en", 0) for i, t in enumerate(texts)]
    return [*out, out[3], out[3], (3, prose(80, 55), "s1", "de", 1), (None, prose(80, 56), None, None, None), (None, prose(80, 56), None, None, None), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def plain(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def awkward(plain):
    """plain with columns that bear names used inside the operators, a dot in a name, a map and a struct."""
    names = ("shard", "slot", "key", "id", "h", "f", "n", "row", "sig", "size", "target", "term", "window", "spans", "n_removed", "score", "label", "part", "at", "host", "license", "__key", "__text", "__row", "__h", "c0")
    more = {n: F.lit(f"x{i}") for i, n in enumerate(names)}
    return plain.withColumns({**more, "a.b": F.lit(1), "m": F.create_map(F.lit("k"), F.lit(2)), "st": F.struct(F.lit(1).alias("doc_id"))})


def bag(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([("a", prose(40, 5), 1), ("a", prose(40, 5), 2), ("b", "one two", 3), (None, None, 4)], "item_id string, text string, n int")


def test_other_columns_change_nothing(spark, plain, awkward, bench):
    assert bag(sharding.shard_report(awkward), "doc_id", "shard", "slot") == bag(sharding.shard_report(plain), "doc_id", "shard", "slot")
    assert bag(jaccard.jaccard_components(awkward), "doc_id", "n_shingles", "component_id") == bag(jaccard.jaccard_components(plain), "doc_id", "n_shingles", "component_id")
    assert bag(mixing.mix(awkward, carry=("size", "h")), "doc_id", "size", "extra", "copies") == bag(mixing.mix(plain), "doc_id", "size", "extra", "copies")
    assert bag(leaks.decontaminate(awkward, bench), "doc_id", "n_hit", "items_sha256") == bag(leaks.decontaminate(plain, bench), "doc_id", "n_hit", "items_sha256")
    assert bag(licenses.scan(awkward.withColumn("text", F.concat("text", F.lit(" Released under the MIT License."))), key="h"), "license") == {("MIT",): 1}
    assert bag(dedup.dedup_report(awkward), "doc_id", "keep_id", "kept") == bag(dedup.dedup_report(plain), "doc_id", "keep_id", "kept")
    kept = spans.remove_spans(awkward)
    assert set(awkward.columns) <= set(kept.columns) and bag(kept, "doc_id", "text", "n_removed") == bag(spans.remove_spans(plain), "doc_id", "text", "n_removed")
    model = {"terms": {"w1": 2.0}, "weights": [1.0, 1.0, 0.0, 0.0, -9.0]}
    clean = toxicity.keep_clean(awkward, model)
    assert clean.columns == awkward.columns and clean.count() == plain.count()
    pages = awkward.select(F.col("doc_id").alias("page_id"), F.lit("http://x.com/").alias("url"), F.col("text").alias("html"), "host", "path" if "path" in awkward.columns else "score")
    assert urls.judge(pages).count() == plain.count()
    turns = awkward.select(F.col("doc_id").alias("conv_id"), F.lit(1).alias("turn"), F.lit("user").alias("role"), "text", "source", "m")
    assert chat.chat_report(turns).count() == len({r["doc_id"] for r in plain.collect()}) + 1


def test_repeated_rows_and_long_texts(spark, plain, rows, bench):
    n = len(rows)
    by = bag(jaccard.jaccard_components(plain), "doc_id", "component_id")
    assert sum(by.values()) == n and by[(3, 3)] == 4 and by[(12, 1)] == 1 and by[(13, 2)] == 1  # 3 twice more, and with another text
    got = {(r["doc_id"], r["n_words"]): r["n_hit"] for r in leaks.decontaminate(plain, bench).collect()}
    assert got[(5, 80)] == 40 and got[(17, 30000)] >= 0 and got[(18, 2)] == 2
    out = spans.remove_spans(plain).collect()
    assert len(out) == n and all(r["n_removed"] == 0 for r in out if r["doc_id"] in (3, None)) and next(r for r in out if r["doc_id"] == 12)["n_removed"] >= 60
    assert sorted(r["group_size"] for r in dedup.dedup_report(plain).filter("doc_id = 3").collect()) == [1, 3, 3, 3]
    total = sum(len((r[1] or "").split()) for r in rows)
    assert abs(mixing.mix_report(plain).agg(F.sum("taken")).first()[0] - 1.5 * total) <= total  # shares of sources of very different sizes
    labels = spark.createDataFrame([(i, int(i % 2)) for i in range(12)], "doc_id long, toxic int")
    scored = toxicity.toxicity_report(plain, labels).collect()
    assert len(scored) == n and all(0 <= r["score"] <= 1 for r in scored)


def test_no_rows(spark, plain, bench):
    none = plain.limit(0)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    for df in (sharding.shard_report(none), jaccard.jaccard_components(none), mixing.mix_report(none), leaks.decontaminate(none, bench), toxicity.toxicity_report(none, labels), licenses.scan(none), dedup.dedup_report(none), spans.remove_spans(none)):
        assert df.count() == 0
    assert leaks.decontaminate(plain, bench.limit(0)).filter("contaminated").count() == 0
    assert toxicity.toxicity_report(plain, labels).count() == plain.count()


def test_stages_on_awkward_tables(spark, awkward, plain, bench, tmp_path, monkeypatch):
    import corpus_pipeline as pipeline

    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 0) for i in range(12)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    sent = {name: stage(spark, awkward, str(tmp_path)) for name, stage in pipeline.STAGES}
    for name, out in sent.items():
        assert out.columns[: len(awkward.columns)] == awkward.columns, name
    kept = Counter(r["doc_id"] for r in sent["ngram_jaccard_join"].collect())
    assert kept[1] == 1 and kept[2] == 1 and kept[12] == 0 and kept[13] == 0 and kept[3] == 2 and kept[None] == 2
    left = Counter(r["doc_id"] for r in sent["benchmark_decontamination"].collect())
    assert left[5] == 0 and left[18] == 0 and left[3] == 4 and left[None] == 3
    assert sent["toxicity"].count() == plain.count() and sent["sharding"].count() == plain.count()
    for _, stage in pipeline.STAGES:
        assert stage(spark, plain.limit(0), str(tmp_path)).count() == 0


def brute_pipeline(rows, items, toxic_words):
    """What the pipeline keeps before it mixes, over plain Python sets."""
    def lower(t):
        return t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))

    def shingles(t):
        w = lower(t or "").split()
        k = min(5, len(w))
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()

    left = [r for r in rows if not any(x in (r[1] or "") for x in toxic_words)]
    sets = [shingles(r[1]) for r in left]
    root = list(range(len(left)))
    for i in range(len(left)):
        for j in range(i):
            if sets[i] and sets[j] and 4 * len(sets[i] & sets[j]) >= 3 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    best: dict = {}
    for i, r in enumerate(left):
        if root[i] not in best or r[0] < best[root[i]][0]:
            best[root[i]] = r
    windows = {tuple(w[i : i + 10]) for w in (lower(t).split() for t in items) for i in range(len(w) - 9)}
    return {r for r in best.values() if not any(tuple(w[i : i + 10]) in windows for w in [lower(r[1] or "").split()] for i in range(len(w) - 9))}


def test_pipeline_meets_brute_force(spark, tmp_path):
    import corpus_pipeline as pipeline

    draw, rows = random.Random(3), []
    for i in range(400):
        words = [f"v{draw.randrange(4000)}" for _ in range(70)]
        if i % 8 == 0:
            words[9:9] = ["idiot", "moron", "idiot"]
        rows.append((i, " ".join(words), f"src{i % 3}", "en", 0))
    for i in range(60):  # near copies, some of which are too far
        words = rows[8 * i % 400 + 1][1].split()
        for k in range(draw.choice((1, 2, 3, 5))):
            words[draw.randrange(len(words))] = f"z{k}"
        rows.append((400 + i, " ".join(words), "src0", "en", 0))
    items = [rows[33][1], "of " + " ".join(rows[50][1].split()[20:40])]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 8 == 0)) for i in range(400)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = brute_pipeline(rows, items, ("idiot", "moron"))
    out = pipeline.run(spark, str(tmp_path))
    found = out.collect()
    assert {tuple(r)[:5] for r in found} <= want
    before = mixing.mix_report(spark.createDataFrame(list(want), DOCS)).collect()
    times = {r["doc_id"]: r["taken"] // r["size"] + (2 * (r["taken"] % r["size"]) >= r["size"]) for r in before}
    assert Counter(r["doc_id"] for r in found) == {k: v for k, v in times.items() if v}


def test_mixed_layouts(spark):
    """Conversations dealt over all layouts, with fields that none names, come back turn by turn."""
    import json

    records = [{"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}], "id": 7}, {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}], "source": "x"},
               {"instruction": "a", "input": "", "output": "b", "text": "whole"}, {"instruction": "a", "output": "b", "score": 0.5}, {"prompt": "a", "response": "b", "id": "1"}, {"prompt": "a", "completion": "b", "meta": {"k": [1]}}]
    rows = [(i, json.dumps(r)) for i, r in enumerate(records * 3)] + [(50, json.dumps({"prompt": "a", "response": "b", "completion": "c"})), (51, '{"turn": 1, "role": "user", "text": "t"}'), (52, "[1]"), (53, "")]
    turns, rejects = chat.json_turn_rows(spark.createDataFrame(rows, "conv_id long, record string"))
    got = sorted(tuple(r) for r in turns.collect())
    assert got == sorted((i, k, role, text) for i in range(18) for k, role, text in ((0, "user", "a"), (1, "assistant", "b")))
    assert {r["conv_id"] for r in rejects.collect()} == {50, 51, 52, 53}
    table = spark.createDataFrame([(1, "p", "r", 3, {"a": 1})], "conv_id long, prompt string, response string, id long, m map<string,int>")
    assert chat.layout_of(table) == "prompt_response" and chat.turn_rows(table).count() == 2


def test_no_element_alone_decides_a_layout(spark):
    """A first message without content, empty lists, elements that are no objects, and nested contents."""
    records = ['{"messages": []}', '{"messages": [{"role": "system"}, {"role": "user", "content": "a"}]}', '{"conversations": []}', '{"messages": [1, 2]}', '{"messages": "x"}', '{"messages": null}', '{"messages": [{"role": "user", "content": {"k": 1}}]}']
    turns, rejects = chat.json_turn_rows(spark.createDataFrame(list(enumerate(records)), "conv_id long, record string"))
    assert sorted((r["conv_id"], r["turn"], r["role"], r["text"]) for r in turns.na.fill("-").collect()) == [(1, 0, "system", "-"), (1, 1, "user", "a"), (6, 0, "user", '{"k":1}')]
    assert {r["conv_id"] for r in rejects.collect()} == {3, 4, 5}


def test_toxicity_on_held_out_rows_of_the_given_tables(spark):
    """Rows of fold 0, whose labels the fit has not seen. Some that are labelled toxic hold no word that others do, so not all can be caught."""
    import os

    folder = "/root/testdata/sf0.1"
    if not os.path.isdir(folder):
        pytest.skip("the given tables are not here")
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    seen = toxicity.toxicity_report(docs, labels).filter("held_out").join(labels.select("doc_id", "toxic"), "doc_id").groupBy("toxic", "predicted").count().collect()
    n = Counter({(r["toxic"], r["predicted"]): r["count"] for r in seen})
    assert n[(1, 1)] + n[(0, 0)] >= 0.95 * sum(n.values()) and n[(0, 1)] <= 0.01 * n[(0, 0)] and n[(1, 1)] >= 0.7 * (n[(1, 1)] + n[(1, 0)])


def test_verdicts_meet_brute_force(spark):
    """Random pages that link to other hosts: rules by trying all, scores by plain power iteration."""
    draw = random.Random(17)
    hosts = [f"h{i}.org" for i in range(14)] + ["a.com", "b.net", "c.net", "x.example.com"]
    pages = []
    for i in range(90):
        links = " ".join(f'<a href="{draw.choice(("http:", "https:", ""))}//{draw.choice(hosts)}/p">' for _ in range(draw.randrange(3)))
        pages.append((i, f"http://{draw.choice(hosts)}{draw.choice(('/', '/en/x', '/es/y', '/fr/', ''))}", links))
    got = {r["page_id"]: (r["host"], r["rule"], r["verdict"]) for r in urls.judge(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}

    def rule(host, path):
        fits = [(len(h + p), v == "block", h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits)[2:] if fits else (None, None)

    cut = lambda u: (u[7:].split("/")[0], "/" + u[7:].split("/", 1)[1] if "/" in u[7:] else "")
    edges = {(cut(u)[0], part.split("/")[0]) for _, u, html in pages for part in html.split("//")[1:]}
    edges = {e for e in edges if e[0] != e[1]}
    nodes = {cut(u)[0] for _, u, _ in pages} | {b for _, b in edges}
    share = {v: {h: sum(rule(*cut(u))[1] == v for _, u, _ in pages if cut(u)[0] == h) / max(1, sum(cut(u)[0] == h for _, u, _ in pages)) for h in nodes} for v in ("allow", "block")}

    def rank(links, weight):
        s, out = dict(weight), Counter(a for a, _ in links)
        for _ in range(200):
            s = {h: weight[h] + 0.85 * sum(s[a] / out[a] for a, b in links if b == h) for h in nodes}
        return s

    trust, distrust = rank(edges, share["allow"]), rank({(b, a) for a, b in edges}, share["block"])
    for i, u, _ in pages:
        host, path = cut(u)
        name, verdict = rule(host, path)
        score = trust[host] - distrust[host]
        if verdict is None and abs(score - urls.THRESHOLD) < 0.01:
            continue  # too near the threshold for unsettled digits
        assert got[i] == (host, name, verdict or ("block" if score < urls.THRESHOLD else "allow"))
    assert {v for _, r, v in got.values() if r is None} == {"allow", "block"}
