"""Vectors, URLs, pages, mixing, sharding, components and the pipeline."""

from __future__ import annotations

import html
import random
import re
import tracemalloc
import zlib

import compare
import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from refsync.llm import components, decontaminate, embedding_dedup, html_text, jaccard_join, language_id, mixing, queries, sharding, url_filter
from refsync.llm.hnsw import Graph

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_against_sql(spark, database, name):
    assert compare.differences(contract.queries()[name](spark, SF_DIR), database, contract.oracle_sql()[name]) == ""


def test_every_operator_has_a_query():
    names = set(contract.queries())
    assert {n.split("_")[0] for n in names if re.match(r"op\d+_", n)} == {f"op{i}" for i in range(1, 11)}
    assert "pipeline" in names


def brute_components(links):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("chunk", [7, 1 << 18])
def test_components(spark, monkeypatch, chunk):
    monkeypatch.setattr(components, "CHUNK_LINKS", chunk)
    rng = random.Random(chunk)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)]
    links += [(-5, 3), (3, 3), (7, 7), links[0]]
    rows = [(a, b) for a, b in links] + [(None, 4), (5, None)]
    got = components.connected_components(spark.createDataFrame(rows, "x bigint, y bigint").repartition(5)).collect()
    want = {n: c for n, c in brute_components([p for p in links if p[0] != p[1]]).items()}
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)
    assert components.connected_components(spark.createDataFrame([], "x bigint, y bigint")).count() == 0


def test_graph_recall_by_beam():
    rng = np.random.default_rng(2)
    base = rng.normal(size=(700, 32))
    x = np.concatenate([base, base[:150] + rng.normal(0, 0.08, (150, 32)), base[:1] + rng.normal(0, 0.05, (250, 32))])
    x /= np.linalg.norm(x, axis=1)[:, None]
    q, n = Graph(x).within(x, 0.9, 24)
    true = x @ x.T >= 0.9
    found = np.zeros_like(true)
    found[q, n] = True
    assert not (found & ~true).any() and len(q) == found.sum()
    assert (found & true).sum() >= 0.99 * true.sum()
    assert [len(p) for p in Graph(x[:1]).within(x[:3], 0.9, 8)] == [int((x[:3] @ x[0] >= 0.9).sum())] * 2
    assert len(Graph(x[:0]).within(x[:3], 0.9, 8)[0]) == 0


def test_near_duplicate_vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(150, 16))
    vectors = [*base, *(base[:40] + rng.normal(0, 0.05, (40, 16))), *(base[:1] + rng.normal(0, 0.1, (60, 16))), *[base[7]] * 30, base[8] * 1e-20, -base[9]]
    rows = [(int(i * 13 % 1009), [float(x) for x in v], 1) for i, v in enumerate(vectors)]
    odd = [(2001, None, 1), (2002, [0.0] * 16, 1), (2003, [float("nan")] * 16, 1), (2004, [None, *[1.0] * 15], 1), (2005, [float("inf")] * 16, 1), (2006, [], 1), (2007, [1.0] * 3, 1), (None, [1.0] * 16, 1)]
    frame = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>, node int")
    got = embedding_dedup.near_duplicates(frame, shard_rows=40).collect()
    assert len(got) == len(rows) + len(odd)
    x = np.array([r[1] for r in rows])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    ids = [r[0] for r in rows]
    want = brute_components([(ids[i], ids[j]) for i, j in zip(*np.nonzero(near), strict=True)])
    by_id = {r["vec_id"]: r for r in got}
    wrong = sum(by_id[v]["n_links"] != near[i].sum() - 1 for i, v in enumerate(ids))
    assert wrong <= 0.02 * len(ids) and {v: by_id[v]["component_id"] for v in ids} == want
    for v, *_ in odd:
        assert by_id[v]["n_links"] == 0 and by_id[v]["component_id"] == v and by_id[v]["kept"] == (v is not None)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got if r["vec_id"] is not None)
    assert embedding_dedup.near_duplicates(frame.limit(0)).count() == 0
    assert embedding_dedup.near_duplicates(frame.filter("vec_id = 2002")).collect()[0]["kept"]
    twice = embedding_dedup.near_duplicates(spark.createDataFrame([rows[0], rows[0]], frame.schema)).collect()
    assert [(r["n_links"], r["component_id"]) for r in twice] == [(1, rows[0][0])] * 2


URLS = [
    (1, "https://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/", "allow"),
    (2, "http://notexample.net/en/", "notexample.net", "/en/", "net/", "block"),
    (3, "http://example.com/de/1#a", "example.com", "/de/1", "example.com/de/", "block"),
    (4, "http://example.com/de", "example.com", "/de", None, "allow"),
    (5, "http://x.org/fr/?", "x.org", "/fr/", "org/fr/", "allow"),
    (6, "net/", "", "", None, "allow"),
    (7, None, "", "", None, "allow"),
    (8, "http://x.net", "x.net", "", None, "allow"),
    (9, "://Ä.ORG?u=http://y.net/", "Ä.org", "", None, "allow"),
    (10, "http://www.bad.com/p/?x=1", "www.bad.com", "/p/", None, "block"),
    (11, "https://bad.com/p#z", "bad.com", "/p", None, "block"),
    (12, "https://bad.com/P", "bad.com", "/P", None, "allow"),
    (None, "https://bad.com/p", "bad.com", "/p", None, "block"),
]


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_urls(spark, broadcast_bytes):
    pages = spark.createDataFrame([(i, u, "mine", 5) for i, u, *_ in URLS], "page_id bigint, url string, canonical string, block int")
    listed = spark.createDataFrame([("ftp://bad.com/p/",), (None,), ("http://x.org/fr/",), ("",)], "u string")
    got = url_filter.filter_urls(pages, listed, broadcast_bytes=broadcast_bytes)
    assert {"canonical", "block"} <= set(got.columns)
    assert sorted(((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()), key=repr) == sorted(((i, *rest) for i, _, *rest in URLS), key=repr)
    assert {r["canonical"] for r in got.collect()} == {"mine"}
    none = url_filter.filter_urls(pages.union(pages), listed.limit(0)).collect()
    assert len(none) == 2 * len(URLS) and not any(r["listed"] for r in none)
    assert url_filter.filter_urls(pages.limit(0), listed).count() == 0


def test_bloom_filter_lets_all_listed_through(spark):
    listed = spark.range(3000).select(F.concat(F.lit("http://h/"), F.col("id").cast("string")).alias("url"))
    pages = listed.union(spark.range(3000, 9000).select(F.concat(F.lit("http://h/"), F.col("id").cast("string"))))
    got = url_filter.filter_urls(pages, listed).groupBy("listed").agg(F.count("*").alias("n"), F.sum(F.col("maybe_listed").cast("int")).alias("maybe")).collect()
    by = {r["listed"]: r for r in got}
    assert by[True]["n"] == by[True]["maybe"] == 3000 and by[False]["n"] == 6000 and by[False]["maybe"] < 60


def test_gradients_of_the_labeller():
    rng = np.random.default_rng(0)
    pages = [html_text.blocks(html_text.made_up_page(rng, ["A b c.", "D e, f."])) for _ in range(3)]
    wanted = [np.array([b.marked for b in p], float) for p in pages]
    model = html_text.Labeller()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}

    def loss():
        s, y = model.scores(pages).astype(float), np.concatenate(wanted)
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).mean()

    grads = model.step(pages, wanted)
    used = pages[0][0].path[0]
    for name, at in [("wf", (3, 5)), ("ub", (2, 9)), ("bf", (30,)), ("outb", (4,)), ("path", (used, 1)), ("out_b", (0,))]:
        size = 1e-4
        model.p[name][at] += size
        up = loss()
        model.p[name][at] -= 2 * size
        down = loss()
        model.p[name][at] += size
        assert grads[name][at] == pytest.approx((up - down) / (2 * size), rel=0.05, abs=2e-4), name


def test_blocks_of_untidy_pages():
    page = "<p>One &amp two<b> <i>three<p>a < b &lt;c&gt; &am<script>var x='</p>';</script><!-- no --><br>d\xa0e</div><td title='x>y'>cell<STYLE>p{}"
    assert [b.text for b in html_text.blocks(page)] == ["One & two three", "a < b <c> &am d e", "cell"]
    assert html_text.blocks("") == [] and html_text.blocks("<script>") == [] and [b.text for b in html_text.blocks("plain")] == ["plain"]


def test_main_text_of_pages(spark):
    def expected(page):
        inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:h1|p)>", inner)]
        return "\n\n".join(p for p in parts if p)

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    odd = spark.createDataFrame([(-1, None, None), (-2, "u", ""), (None, None, "<article><p>x</p></article>"), (-3, "u", "<p>" * 3000 + "<article>" + "<p>Long text, with words.</p>" * 9000 + "</article>")], pages.schema)
    got = {r["page_id"]: r for r in html_text.extract(pages.union(odd)).collect()}
    wanted = {r["page_id"]: expected(r["html"]) for r in pages.collect()}
    assert sum(got[i]["text"] == t for i, t in wanted.items()) >= 0.99 * len(wanted)
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert got[-1]["text"] == got[-2]["text"] == "" and got[-1]["url"] is None and None in got
    assert got[-3]["text"].count("Long text") > 8900
    assert html_text.extract(pages.limit(0)).count() == 0


def test_labeller_in_other_layouts():
    rng = np.random.default_rng(123)
    sentences = [f"{a} {b}, {c}." for a in ("One", "Two", "Red") for b in ("cat", "dog", "day") for c in ("runs", "is old", "went away")]
    labeller = html_text.train([html_text.made_up_page(rng, sentences) for _ in range(20)])
    pages = [html_text.blocks(html_text.made_up_page(rng, sentences)) for _ in range(150)]
    chosen, true = labeller.scores(pages) >= 0.5, np.array([b.marked for p in pages for b in p])
    assert (chosen == true).mean() >= 0.95


def test_mixing_meets_the_targets(spark):
    rng = random.Random(6)
    words = {0: "good fine well", 1: "spam buy now", 2: "vile foul bad"}
    docs, labels = [], []
    for i in range(600):
        domain = 0 if i % 10 < 6 else 1 if i % 10 < 9 else 2
        docs.append((i, " ".join(rng.choice(words[domain].split() + ["the", "of"]) for _ in range(rng.randrange(5, 40))), f"s{i % 3}", 9.0))
        if i % 2:
            labels.append((i, domain))
    docs += [(1000, None, None, 9.0), (None, "good of", "s", 9.0), (1001, "", None, 9.0), docs[0]]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string, rate double")
    labelled = spark.createDataFrame(labels, "doc_id bigint, domain int")
    mixed = mixing.mix(frame, labelled, targets={"good": 0.5, "junk": 0.5, "toxic": 0.0}).collect()
    assert len(mixed) == len(docs)
    whole = sum(r["n_tokens"] for r in mixed)
    held = {n: sum(r["rate"] * r["n_tokens"] * r[f"p_{n}"] for r in mixed) / whole for n in mixing.DOMAINS}
    assert held["good"] == pytest.approx(0.5, abs=0.01) and held["junk"] == pytest.approx(0.5, abs=0.01) and held["toxic"] < 0.01
    assert all(r["rate"] >= 0 and abs(r["p_good"] + r["p_junk"] + r["p_toxic"] - 1) < 1e-9 for r in mixed)
    by_id = {r["doc_id"]: r for r in mixed}
    assert by_id[1000]["n_tokens"] == by_id[1001]["n_tokens"] == 0 and by_id[None]["p_good"] > 0.5
    wrong = sum(by_id[i][f"p_{mixing.DOMAINS[d]}"] < 0.5 for i, d in ((i, 0 if i % 10 < 6 else 1 if i % 10 < 9 else 2) for i in range(600)))
    assert wrong <= 12
    drawn = mixing.draw(mixing.mix(frame, labelled)).collect()
    counts = {}
    for r in drawn:
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + 1
        assert r["copy"] <= r["rate"] + 1
    assert mixing.mix(frame, labelled.limit(0)).count() == len(docs)
    assert mixing.mix(frame.limit(0), labelled).count() == 0


def test_targets_with_overlapping_domains(spark, monkeypatch):
    """Against the same problem solved by many plain projected gradient steps in numpy."""
    rng = np.random.default_rng(5)
    p = rng.dirichlet([0.3, 0.2, 0.15], 400)
    n = rng.integers(1, 300, 400).astype(float)
    rows = [(i, int(t), *map(float, q)) for i, (t, q) in enumerate(zip(n, p, strict=True))]
    judged = spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint, p_good double, p_junk double, p_toxic double")
    targets = {"good": 0.7, "junk": 0.27, "toxic": 0.03}
    for most in (None, 3.0):
        monkeypatch.setattr(mixing, "LEAST_PULL", mixing.PULL)  # one problem, without the weaker pulls
        found = mixing.fit(judged, mixing.DOMAINS, targets, 1.0, most=most)
        held, wanted = n @ p, np.array([0.7, 0.27, 0.03]) * n.sum()
        multipliers = np.zeros(3)
        for _ in range(200_000):
            rate = np.clip(1 - p @ multipliers, 0, most)
            step = ((rate * n) @ p - wanted - mixing.PULL * held * multipliers) / held
            multipliers = multipliers + step
            if np.abs(step * held).sum() < 1e-7 * n.sum():
                break
        got = judged.select(found.rate.alias("rate")).toPandas()["rate"].to_numpy()
        assert np.abs(got - rate).max() < 0.01 and got.min() >= 0
        assert list(found.reached.values()) == pytest.approx(((rate * n) @ p).tolist(), abs=1e-3 * n.sum())
    monkeypatch.undo()
    free = mixing.fit(judged, mixing.DOMAINS, targets, 1.0)
    assert max(abs(free.reached[d] - free.wanted[d]) for d in free.wanted) < 1e-3 * n.sum()


def test_labels_and_draws_of_repeated_ids(spark):
    docs = spark.createDataFrame([(1, "good fine"), (2, "spam buy"), (3, "good")], "doc_id bigint, text string")
    once = spark.createDataFrame([(1, 0), (2, 1)], "doc_id bigint, domain int")
    often = once.union(once.filter("doc_id = 1").crossJoin(spark.range(50)).drop("id"))
    prior, table = mixing.train(docs, often, 2)
    assert np.exp(prior).tolist() == pytest.approx([51 / 52, 1 / 52])  # an id that is labelled often teaches often
    rates = spark.range(4_000).select(F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, 2).alias("doc_id"), F.lit(0.5).alias("rate"))
    drawn = mixing.draw(rates.repartition(8)).groupBy("doc_id").count().collect()
    assert all(500 < r["count"] < 840 for r in drawn) and len(drawn) == 3  # ids, and rows without one, are not drawn alike


def test_label_domains(spark):
    rows = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 1), (4, None, None), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert {(r[0], r[1]) for r in mixing.label_domains(rows).collect()} == {(1, 0), (2, 1), (3, 2)}


@pytest.mark.parametrize("ranges", [4, 64])
def test_shards(spark, monkeypatch, ranges):
    monkeypatch.setattr(sharding, "LEAST_RANGES", ranges)
    rng = random.Random(ranges)
    docs = [(i, "x" * rng.randrange(1, 400) + str(i), "d", 1) for i in range(900)] + [(2000 + i, "hot text " * 20, "d", 1) for i in range(500)]
    docs += [(3000 + i, f"pair {i // 2} " * 5, "d", 1) for i in range(60)] + [(None, None, None, None), (5000, "", None, None), docs[0], (6000, "é" * 20_000, "d", 1)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string, shard int")
    got = sharding.shard(frame).collect()
    assert len(got) == len(docs) and {r["law"] for r in got} == {"bytes"} and all(r["grown_shard"] is None for r in got)
    sizes, slots, shards_of = {}, {}, {}
    for r in got:
        text = (r["text"] or "").encode()
        assert r["size"] == len(text) + 8 and r["text_crc32"] == zlib.crc32(text)
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        shards_of.setdefault(r["text"] or "", set()).add(r["shard"])
    assert all(sorted(own) == list(range(len(own))) for own in slots.values()) and set(slots) <= set(range(24))
    mean = sum(sizes.values()) / 24
    assert max(v for k, v in sizes.items()) <= mean * 1.15 + 40_008
    assert sum(len(s) > 1 for t, s in shards_of.items() if "hot" not in t) == 0
    assert len(shards_of["hot text " * 20]) > 5
    assert sharding.shard(frame.limit(0)).count() == 0
    assert sharding.shard(frame.limit(1)).collect()[0]["slot"] == 0


def test_places_do_not_depend_on_what_travels(spark):
    rng = random.Random(9)
    rows = [(i, "t" * rng.randrange(1, 300) + str(i % 40), i) for i in range(300)] + [(7, "again", k) for k in range(400)] + [(None, None, 1), (None, None, 2)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, mark int")
    wide, narrow = (sharding.shard(frame, keep=keep).select("doc_id", "text_crc32", "shard", "slot") for keep in (None, ["doc_id"]))
    assert sorted(map(str, wide.collect())) == sorted(map(str, narrow.collect()))
    assert sorted(r["mark"] for r in sharding.shard(frame).filter("text = 'again'").collect()) == list(range(400))


def words_of(text):
    return (text or "").encode().lower().split()


def shingle_set(text, k):
    own = words_of(text)
    return {tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if len(own) >= k else ({tuple(own)} if own else set())


def test_pipeline_stage_by_stage(spark):
    """Each stage on its own input; near-duplicates, benchmarks and shards against brute force, the models by effect."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, None
    for name, step in corpus_pipeline.STAGES:
        own = docs.collect()
        after = step(spark, docs, SF_DIR)
        after = spark.createDataFrame(after.collect(), after.schema)
        kept = [r["doc_id"] for r in after.collect()]
        assert len(kept) == len(set(kept)) and set(kept) <= {r["doc_id"] for r in own}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == columns
        if name == "language":
            assert len(kept) >= 0.97 * len(own)
        if name == "near_duplicates":
            sets = [(r["doc_id"], shingle_set(r["text"], 5)) for r in own]
            links = [(a, b) for i, (a, s) in enumerate(sets) for b, t in sets[:i] if s and t and 10 * len(s & t) >= 8 * len(s | t)]
            gone = {d for d, c in brute_components(links).items() if d != c}
            assert set(kept) == {d for d, _ in sets} - gone and gone
        if name == "benchmarks":
            items = [shingle_set(r["text"], 5) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
            held = {r["doc_id"] for r in own for s in items if s and 5 * len(s & shingle_set(r["text"], 5)) >= 4 * len(s)}
            assert set(kept) == {r["doc_id"] for r in own} - held
        if name == "weights":
            good = {r["doc_id"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").filter("quality = 1 AND toxic = 0").collect()} & {r["doc_id"] for r in own}
            assert len(good & set(kept)) >= 0.95 * len(good)
        if name == "shards":
            assert len(kept) == len(own)
        docs, before = after, own
    assert before


def test_near_duplicates_of_a_repeated_id(spark):
    text = lambda i: " ".join(f"w{i}x{j}" for j in range(40))
    rows = [(7, text(i), "s") for i in range(30)] + [(7, text(0), "r"), (3, text(1), "s"), (9, text(2) + " more", "s"), (5, text(40), "s"), (8, text(40), "s")]
    rows += [(None, text(3), "s"), (None, text(3), "s"), (7, None, "s"), (7, "", "s")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    want = {(7, text(i), "s") for i in range(30) if i not in (0, 1)} | {(7, text(0), "r"), (3, text(1), "s"), (5, text(40), "s"), (None, text(3), "s"), (7, None, "s"), (7, "", "s")}
    for some in (frame, frame.repartition(7)):
        got = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, some, "").collect()]
        assert set(got) == want and len(got) == len(want) + 1


def test_pipeline_of_odd_rows(spark, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, component_id string, rate string"
    text = "die und der " * 30
    rows = [(1, text, "de", "s", 1, "c", "r"), (1, text, "de", "s", 1, "c", "r"), (2, text, None, None, None, "c", "r"), (None, "und " + text, "de", "s", 1, "c", "r"), (3, None, None, None, None, None, None), (4, "", "de", None, 0, None, None), (5, "word " * 60_000, "en", "s", 1, "c", "r")]
    empty = spark.createDataFrame([], schema)
    for path, some in (("some", spark.createDataFrame(rows, schema)), ("none", empty)):
        folder = str(tmp_path / path)
        some.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, "no such item in there at all"), (None, None)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
        spark.createDataFrame([(1, 1, 0), (None, None, None)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        got = corpus_pipeline.run(spark, folder).collect()
        assert sorted(repr(r["doc_id"]) for r in got) == (["1", "5", "None"] if path == "some" else [])
        assert all(r["component_id"] == "c" and r["rate"] == "r" for r in got)


def test_stages_keep_columns_with_the_names_of_their_own(spark, tmp_path):
    columns = ("lang_pred", "score", "shard", "slot", "size", "n_tokens", "p_good", "rate", "copy", "held_out")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60)
    marked = docs.select("*", *[F.lit(f"my {c}").alias(c) for c in columns])
    for name, step in corpus_pipeline.STAGES:
        after = step(spark, marked, SF_DIR)
        kept = [f"{c}_in" if name == "shards" and c in sharding.OUTPUTS else c for c in columns]
        if name == "shards":
            assert {"shard", "slot", "size"} <= set(after.columns)
        else:
            assert after.columns == marked.columns
        assert {tuple(r) for r in after.select(*kept).collect()} == {tuple(f"my {c}" for c in columns)}


def test_last_round_of_the_join_divides_hot_keys(spark, monkeypatch):
    """Texts that are all nearly alike, so that few keys hold all sets: any division gives the same components."""
    rng = random.Random(12)
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(f"x{rng.randrange(10**6)}" if rng.random() < 0.05 else w for w in base) for _ in range(120)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    sets = [shingle_set(t, 3) for t in texts]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if 10 * len(sets[a] & sets[b]) >= 7 * len(sets[a] | sets[b])]
    want = {i: i for i in range(len(sets))} | brute_components(links)
    for size, rounds in ((4096, 2), (5, 0)):
        monkeypatch.setattr(jaccard_join, "KEY_SETS", size)
        monkeypatch.setattr(jaccard_join, "STAR_ROUNDS", rounds)
        got = jaccard_join.jaccard_components(frame, k=3, percent=70).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_items_by_size_class():
    items = decontaminate.Items([np.arange(1, 9, dtype=np.uint64) << np.uint64(58), np.array([5], np.uint64)], 0.8)
    assert items.whole == [1] or items.whole == [0, 1]
    assert jaccard_join.difference(19, 90) == 1


def test_keys_of_one_set_fall_out_at_any_batch_size():
    rng = np.random.default_rng(5)
    keys = np.sort(rng.integers(0, 60, 90)) - 30
    nodes = np.arange(90)
    table = pa.table({"key": keys, "node": nodes})
    wanted = [(k, n) for k, n in zip(keys.tolist(), nodes.tolist(), strict=True) if (keys == k).sum() > 1]
    for size in (1, 2, 7, 90):
        found = pa.Table.from_batches(jaccard_join._repeated(iter(table.to_batches(max_chunksize=size))), table.schema)
        assert list(zip(*found.to_pydict().values(), strict=True)) == wanted
    assert not list(jaccard_join._repeated(iter([])))


def test_of_keys_with_the_same_sets_one_is_kept(spark):
    groups = {1: [10, 20], 2: [20, 10], 3: [10, 20, 30], 4: [10, 10, 20], 5: [30, 20, 10], 6: [30, 40]}
    rows = spark.createDataFrame([(k, n) for k, own in groups.items() for n in own], "key bigint, node bigint")
    kept = jaccard_join._distinct_groups(rows).collect()
    assert sorted((r["key"], r["node"]) for r in kept) == sorted((k, n) for k in (1, 3, 4, 6) for n in groups[k])


@pytest.mark.parametrize("rounds", [0, 2])
def test_similar_sets_with_different_numbers_of_bins(spark, monkeypatch, rounds):
    rng = random.Random(11)
    texts = []
    for size in (192, 200, 384, 390, 780):
        words = [f"w{rng.randrange(10**6)}" for _ in range(size + 2)]
        texts += [words, words[: size * 93 // 100], words[: size * 85 // 100], [*words, *(f"n{rng.randrange(10**6)}" for _ in range(size // 15))]]
    monkeypatch.setattr(jaccard_join, "STAR_ROUNDS", rounds)
    got = jaccard_join.jaccard_components(spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")).collect()
    sets = [{tuple(w[i : i + 3]) for i in range(len(w) - 2)} for w in texts]
    component = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if 100 * len(a & b) >= 90 * len(a | b):
                    component[i] = component[j] = min(component[i], component[j])
    assert {r["doc_id"]: r["component_id"] for r in got} == dict(enumerate(component))


def test_bins_are_stored_and_sent_once():
    table = pa.table({"doc_id": [1], "text": [" ".join(f"w{i}" for i in range(900))]})
    [described] = jaccard_join._describe(3)(iter(table.to_batches()))
    assert described.schema.names == ["doc_id", "n_shingles", "s1", "s2", "parity"]


def test_columns_of_texts_take_the_memory_of_a_slice():
    rng = random.Random(21)
    texts = pa.array([" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(400)) for _ in range(800)])
    whole = texts.nbytes
    sizes = lambda: [sum(len(own) for own in decontaminate._sets(texts, 5)), sum(len(own) for *_, own, _ in jaccard_join._sets(texts, 5))]
    sizes(), language_id.grams(["a"])  # tables that stay
    for work in (sizes, lambda: [language_id.grams(own)[0].size for _, own in language_id._text_slices(texts)]):
        tracemalloc.start()
        found = work()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert all(found) and whole > 2 << 20 and peak < 50 << 20
    assert sizes() == [800 * 396] * 2


def test_pipeline_sends_texts_in_bounded_batches(spark, monkeypatch, tmp_path):
    def rows_and_bytes(docs, *_):
        def run(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

        return docs.mapInArrow(run, "n bigint, size bigint")

    monkeypatch.setattr(decontaminate, "drop_contaminated", rows_and_bytes)
    spark.createDataFrame([(1, "a")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.range(0, 900, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 2000).alias("text"))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        for held, most in (("64m", 4 << 20), ("1m", 1 << 20)):  # a smaller bound of the session stays
            spark.conf.set(key, held)
            found = corpus_pipeline.benchmarks(spark, docs, str(tmp_path)).collect()
            assert sum(r["n"] for r in found) == 900 and max(r["size"] for r in found) < most + 20_000
    finally:
        spark.conf.set(key, before)


def test_language_gets_each_text_once(spark, capsys):
    model = language_id.Model(["de", "en"], np.random.default_rng(3).integers(0, 50, (2, language_id.BUCKETS)).astype(float))
    docs = spark.createDataFrame([(1, "one text", "x", "kept"), (2, None, "y", "lang"), (3, "zwei Texte", None, None)], "doc_id bigint, text string, lang_pred string, other string")
    whole, alone = language_id.predict(docs, model), language_id.predict(docs, model, keep=["doc_id"])
    assert whole.columns == ["doc_id", "text", "other", "lang_pred", "score"] and alone.columns == ["doc_id", "lang_pred", "score"]
    assert sorted(whole.select(alone.columns).collect()) == sorted(alone.collect())
    assert [r["text"] for r in whole.orderBy("doc_id").collect()] == ["one text", None, "zwei Texte"]
    capsys.readouterr()
    whole.explain(True)
    assert "__text" not in capsys.readouterr().out
