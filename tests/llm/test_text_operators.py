"""Operators on texts against brute force, with nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from refsync.llm import decontaminate, jaccard_join, language_id, passage_pairs, substring_dedup, textops, token_counts

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words_of(text):
    return text.encode().lower().split() if text else []


def shingles_of(text, k):
    own = words_of(text)
    return {tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if len(own) >= k else ({tuple(own)} if own else set())


def invented(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edited(rng, text, changes):
    own = text.split(" ")
    for _ in range(changes):
        own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
    return " ".join(own)


def test_words_and_shingles():
    texts = [None, "", " \t\n", "One", "one  TWO\x0bthree\x0cfour", "é É x a", "a " * 5000, "x" * 100_000, "A b C d e f"]
    data, offsets = textops.text_buffers(pa.array(texts, pa.string()).slice(0))
    found = textops.words(data, offsets)
    assert np.diff(found.offsets).tolist() == [len(words_of(t)) for t in texts]
    by_word = {}
    for own, (a, b) in zip(texts, zip(found.offsets[:-1], found.offsets[1:], strict=True), strict=True):
        for word, value in zip(words_of(own), found.hashes[a:b].tolist(), strict=True):
            assert by_word.setdefault(word, value) == value
    assert len(set(by_word.values())) == len(by_word)
    for k in (1, 3, 5):
        values, own = textops.distinct(*textops.shingles(found.hashes, found.offsets, k))
        assert np.diff(own).tolist() == [len(shingles_of(t, k)) for t in texts]
    assert list(textops.slices(np.array([0, 5, 6, 100, 101]), 10)) == [(0, 2), (2, 3), (3, 4)]


def test_sliced_arrays():
    column = pa.array(["skip me", "a b", None, "c"]).slice(1)
    data, offsets = textops.text_buffers(column)
    assert np.diff(textops.words(data, offsets).offsets).tolist() == [2, 0, 1]


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80), (1, 70)])
def test_jaccard_join_is_exact(spark, k, percent):
    rng = random.Random(k)
    texts = [None, "", " ", "one", "one", "one two", "One TWO"]
    for n in (4, 9, 10, 12, 20, 60, 61, 300):
        base = invented(rng, n)
        texts += [base, base.upper(), base + " tail", *[edited(rng, base, rng.randrange(1, 1 + max(2, n // 12))) for _ in range(12)]]
    texts += ["same thing again and again"] * 40 + [invented(rng, 8) for _ in range(60)] + [invented(rng, 30_000, 10**6)]
    rows = [(i * 7 % 1009, t, None, None, None) for i, t in enumerate(texts)]
    rows += [rows[10], rows[10], (None, texts[8], None, None, None), (rows[20][0], texts[40], None, None, None)]
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, DOCS), k=k, percent=percent).collect()

    sets = [(d, shingles_of(t, k)) for d, t, *_ in rows]
    parent = {d: d for d, _ in sets if d is not None}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for i, (d, s) in enumerate(sets):
        for e, t in sets[:i]:
            if d is not None and e is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                a, b = sorted((root(d), root(e)))
                parent[b] = a
    want = sorted((repr(d), len(s), None if d is None else root(d)) for d, s in sets)
    assert sorted((repr(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in got) == want


def test_jaccard_join_without_rows(spark):
    assert jaccard_join.jaccard_components(spark.createDataFrame([], DOCS)).count() == 0


def test_allocation_keeps_the_pigeonhole_bound():
    for different in range(30):
        for size in (1, 5, 40, 300):
            for documents in (1, 1000, 10**9):
                segments, deletions = jaccard_join.allocate(different, size, documents)
                assert segments + deletions == different + 1 and 0 <= deletions <= segments
    # many small sets: fewer and larger segments
    assert jaccard_join.allocate(5, 20, 10**9)[1] > jaccard_join.allocate(5, 20, 10)[1]


def test_decontamination(spark):
    rng = random.Random(5)
    items = [(i, invented(rng, n, 10**6)) for i, n in enumerate([1, 3, 5, 6, 8, 14, 25, 40, 59, 200])] + [(90, None), (91, ""), (7, None)]
    items += [items[6], (None, invented(rng, 30, 10**6))]
    docs = [(0, None), (1, ""), (2, "one"), (3, items[0][1]), (4, items[1][1].upper())]
    for i, (_, text) in enumerate(items[2:10]):
        own = text.split(" ")
        docs.append((10 + i, " ".join([invented(rng, 3000), text, invented(rng, 10)])))
        docs.append((30 + i, " ".join([invented(rng, 50), *own[: int(len(own) * 0.95)], invented(rng, 50)])))
        docs.append((50 + i, " ".join([invented(rng, 50), *own[: len(own) // 2], invented(rng, 50)])))
        docs.append((70 + i, edited(rng, invented(rng, 30) + " " + text, 3)))
    docs += [docs[7], (None, items[8][1]), (99, invented(rng, 40_000, 10**6) + " " + items[9][1])]
    frame = spark.createDataFrame([(d, t, 1.5) for d, t in docs], "doc_id bigint, text string, item_id double")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = set()
    for d, t in docs:
        for i, item in items:
            s = shingles_of(item, 5)
            n = len(s & shingles_of(t, 5))
            if s and 5 * n >= 4 * len(s):
                want.add((d, i, n, len(s)))
    got = decontaminate.find_contamination(frame, bench, block_shingles=60).collect()
    assert {(r["doc_id"], r["item_id"], r["n_shared"], r["n_item"]) for r in got} == want
    assert len(want) > 15
    held = {d for d, *_ in want}
    clean = decontaminate.drop_contaminated(frame, bench, block_shingles=60).collect()
    assert sorted(repr(r["doc_id"]) for r in clean) == sorted(repr(d) for d, _ in docs if d not in held)
    assert {r["item_id"] for r in clean} == {1.5}
    assert decontaminate.find_contamination(frame.limit(0), bench).count() == 0
    assert decontaminate.drop_contaminated(frame, bench.limit(0)).count() == len(docs)


def test_bins_bound_the_misses():
    assert decontaminate.bins_per_shingle(1) is None
    assert decontaminate.bins_per_shingle(200) == 1
    assert decontaminate.bins_per_shingle(8) > decontaminate.bins_per_shingle(30)


def test_language_mixtures(spark):
    rng = random.Random(1)
    letters = {"aa": "abcdeh", "bb": "hijklm", "cc": "üößäwz"}

    def say(lang, n):
        return " ".join("".join(rng.choice(letters[lang]) for _ in range(rng.randrange(2, 9))) for _ in range(n))

    rows = [(i, say(lang, 60), lang, None, None) for i in range(90) for lang in letters]
    rows += [(1000, None, "aa", None, None), (1001, "12 !?", None, None, None), (1002, "", None, None, None), (None, say("bb", 50), None, None, None)]
    rows += [(1003, say("aa", 50) + " " + say("cc", 25), None, None, None), (1004, say("cc", 40_000), None, None, None), (1004, say("cc", 9), None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    model = language_id.train_on_folds(docs)
    assert model.langs == ["aa", "bb", "cc"]
    judged = language_id.predict(docs.withColumn("score", F.lit("clash")), model)
    assert judged.columns == [*docs.columns, "lang_pred", "score"]
    got = judged.collect()
    assert len(got) == len(rows)
    known = [(r["lang"], r["lang_pred"]) for r in got if r["lang"] and r["text"]]
    assert sum(a == b for a, b in known) >= 0.99 * len(known)
    by_id = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got if r["doc_id"] is None or r["doc_id"] > 999}
    assert by_id[1000] == by_id[1001] == by_id[1002] == ("und", 0.0)
    assert by_id[None][0] == "bb" and by_id[1004][0] == "cc"
    assert by_id[1003][0] == "aa" and 0.5 < by_id[1003][1] < 0.85
    assert all(0 <= r["score"] <= 1 for r in got)
    untaught = language_id.train_on_folds(docs.filter("lang IS NULL"))
    assert {r["lang_pred"] for r in language_id.predict(docs, untaught).collect()} == {"und"}
    assert language_id.predict(docs.limit(0), model).count() == 0


def test_language_of_held_out_documents(spark):
    rows = language_id.op3_language_id(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id"
    ).filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)


TEXTS = [
    None, "", " \n\t ", "Plain words, don't they're 12 34!", "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", "é é ́x ΑΣ ΑΣ. Σ",
    "中文 字符混合abc", "a b c　d", "$$$%%% word$$$ (word) word). w...", "x" * 50_000, "word " * 30_000, "tab\tnew\nline\x0bvt\x0cff\rcr", "🙂🙂 ok🙂", "\x00\x1f a",
]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_token_counts_are_those_of_the_library(spark, name):
    encode = token_counts.encoder(token_counts.tokenizer_path(name))
    split = name.startswith("word")
    own = token_counts.Counter(encode, split)
    sizes, counts = token_counts.lengths(pa.array(TEXTS, pa.string()), own)
    assert sizes.tolist() == [len((t or "").encode()) for t in TEXTS]
    assert counts.tolist() == [encode([t or ""])[0] for t in TEXTS]


def test_token_count_rows(spark):
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(TEXTS)] + [(None, "a b", None, None, None), (3, TEXTS[3], None, None, None)]
    got = token_counts.count_tokens(spark.createDataFrame(rows, DOCS).withColumn("n_tokens", F.lit("clash"))).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == {"doc_id", "n_bytes", "n_tokens", "over_limit"}
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in got)
    assert sum(r["over_limit"] for r in got) == 2
    assert token_counts.count_tokens(spark.createDataFrame([], DOCS)).count() == 0


def brute_chain_score(pos, other, k, cost):
    best = [0.0] * len(pos)
    for i in range(len(pos)):
        best[i] = k + max([0.0, *[best[j] - cost * (pos[i] - pos[j] + other[i] - other[j]) for j in range(i) if pos[j] < pos[i] and other[j] < other[i]]])
    return max(best)


def test_chains_find_the_best_score():
    rng = random.Random(3)
    for _ in range(60):
        matches = sorted({(rng.randrange(60), rng.randrange(60)) for _ in range(rng.randrange(1, 40))})
        pos, other = [m[0] for m in matches], [m[1] for m in matches]
        found = substring_dedup.chains(pos, other, 5, 0.12)
        assert found[0][0] == pytest.approx(brute_chain_score(pos, other, 5, 0.12))
        assert sorted(m for _, own in found for m in own) == list(range(len(pos)))
        for _, own in found:
            assert all(pos[a] < pos[b] and other[a] < other[b] for a, b in zip(own, own[1:], strict=False))


def test_edits_is_edit_distance():
    assert substring_dedup.edits(list("kitten"), list("sitting")) == 3
    assert substring_dedup.edits([], list("ab")) == 2 and substring_dedup.edits(list("ab"), list("ab")) == 0


def test_winnowing_keeps_a_place_in_every_window():
    values = np.random.default_rng(1).integers(0, 50, 500).astype(np.uint64)
    kept = set(substring_dedup.winnow(values, 10).tolist())
    equal = np.concatenate([values, np.full(100, 3, np.uint64)])
    assert all(kept & set(range(i, i + 10)) or len(set(values[i : i + 10])) < 9 for i in range(491))
    assert len(substring_dedup.winnow(equal[500:], 10)) < 20


def test_repeated_passages(spark):
    rng = random.Random(9)
    passage, other = invented(rng, 70, 10**6), invented(rng, 200, 10**6)
    fuzzy = " ".join(w if i % 23 else f"y{i}" for i, w in enumerate(other.split(" ")))
    fresh = lambda n: invented(rng, n, 10**6)
    docs = [(1, f"{fresh(40)} {passage} {fresh(30)}"), (2, passage.upper()), (3, f"{fresh(9000)}\n{passage.replace(' ', '  ')}"), (4, f"{fresh(5)} {other}"), (5, f"{fuzzy} {fresh(8)}")]
    docs += [(6, fresh(300)), (7, " ".join(passage.split(" ")[:30]) + " " + fresh(40)), (8, None), (9, ""), (10, "For " * 4000), (11, "For " * 3000), (None, passage), (6, fresh(80)), (2, passage.upper())]
    docs += [(20 + i, f"{fresh(3)} {passage} {fresh(3)}") for i in range(40)]
    frame = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id bigint, text string, anchor string")
    got = {(r["doc_id"], r["other_id"]): r for r in substring_dedup.repeated_passages(frame).collect() if r["doc_id"] not in (10, 11)}
    assert {k for k in got} == {(2, 1), (3, 1), (5, 4), *[(20 + i, 1) for i in range(40)]}
    texts = {}
    for d, t in docs:
        texts.setdefault(d, words_of(t))
    for (d, o), r in got.items():
        own, others = texts[d][r["start_word"] : r["end_word"]], texts[o][r["other_start"] : r["other_end"]]
        if d != 5:
            assert b" ".join(own) == b" ".join(others) == passage.encode() and r["identity"] == 1
        else:
            assert len(own) >= 190 and r["identity"] >= 0.9
    assert substring_dedup.repeated_passages(frame.limit(0)).count() == 0


def test_passages_of_repeated_words_and_lines(spark):
    rng = random.Random(12)
    line, lead = invented(rng, 23, 10**6), invented(rng, 17, 10**6)
    passage = invented(rng, 60, 10**6)
    docs = [(1, "For " * 4000), (2, "for " * 3000), (3, f"{lead} " + f"{line} " * 120), (4, f"{line} " * 90), (5, f"{line} " * 130)]
    docs += [(6, passage), (7, f"{passage} {lead[:40]} {passage}")]
    found = substring_dedup.repeated_passages(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    texts = {d: words_of(t) for d, t in docs}
    covered: dict[tuple, set] = {}
    for r in found:
        own, others = texts[r["doc_id"]][r["start_word"] : r["end_word"]], texts[r["other_id"]][r["other_start"] : r["other_end"]]
        assert r["identity"] < 1 or own == others
        covered.setdefault((r["doc_id"], r["other_id"]), set()).update(range(r["start_word"], r["end_word"]))
    assert len(covered[2, 1]) >= 2950 and len(covered[4, 3]) >= 23 * 90 - 23
    assert len(covered[5, 3] | covered.get((5, 4), set())) >= 23 * 120 - 23
    assert len(covered[7, 6]) == 120
    assert len(found) < 20


def test_passages_whose_parts_occurred_in_different_documents(spark):
    rng = random.Random(13)
    fresh = lambda n: invented(rng, n, 10**6)
    passage = fresh(80).split(" ")
    part = lambda a, b: " ".join(passage[a:b])
    docs = [(1, f"{fresh(30)} {part(0, 40)} {fresh(9)}"), (2, f"{part(40, 80)} {fresh(20)}"), (3, f"{fresh(7)} {part(22, 57)}")]
    docs += [(100, f"{fresh(60)} {part(0, 80)} {fresh(3)}"), (200, f"{fresh(11)} {part(0, 80)} {fresh(50)}"), (300, part(0, 80))]
    found = substring_dedup.repeated_passages(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"], r["other_id"], r["n_words"], r["identity"], r["start_word"]) for r in found) == [(200, 100, 80, 1, 11), (300, 100, 80, 1, 0)]


def test_passages_of_the_sample_are_found(spark):
    """Every exact run of 60 words that two documents share lies in a reported passage of the later one."""
    sf_dir = "/root/testdata/sf0.001"
    found = {}
    for r in substring_dedup.op10_substring_dedup(spark, sf_dir).collect():
        found.setdefault(r["doc_id"], []).append((r["start_word"], r["end_word"]))
    first, missing = {}, 0
    for r in sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").collect(), key=lambda r: r["doc_id"]):
        own = words_of(r["text"])
        for i in range(len(own) - 59):
            key = tuple(own[i : i + 60])
            if len(set(key)) > 20 and first.setdefault(key, r["doc_id"]) != r["doc_id"]:
                missing += not any(a <= i and i + 60 <= b for a, b in found.get(r["doc_id"], []))
    assert missing == 0


def has_passage(a, b, least, identity):
    """Whether some stretches of `least` words or more that begin and end equal have that identity, by edit distance of all."""
    for i in range(len(a)):
        for j in (j for j in range(len(b)) if a[i] == b[j]):
            row = list(range(len(b) - j + 1))
            for x in range(1, len(a) - i + 1):
                diagonal, row[0] = row[0], x
                for y in range(1, len(b) - j + 1):
                    diagonal, row[y] = row[y], min(diagonal + (a[i + x - 1] != b[j + y - 1]), row[y] + 1, row[y - 1] + 1)
                    if x >= least and y >= least and a[i + x - 1] == b[j + y - 1] and max(x, y) - row[y] >= identity * max(x, y) - 1e-9:
                        return True
    return False


def changed(rng, base, rate):
    out = []
    for w in base:
        kind = rng.random() / rate
        out += [w] if kind > 1 else [[], [rng.randrange(10**6)], [rng.randrange(10**6)], [w, rng.randrange(10**6)]][int(kind * 4) % 4]
    return out


def test_best_passages_against_all_stretches():
    rng = random.Random(5)
    fresh = lambda n: [rng.randrange(10**6) for _ in range(n)]
    seen = set()
    for _ in range(120):
        base = fresh(14)
        a, b = fresh(rng.randrange(4)) + base + fresh(rng.randrange(4)), fresh(rng.randrange(4)) + changed(rng, base, 0.25) + fresh(rng.randrange(4))
        places = [(i, j) for i in range(len(a) - 2) for j in range(len(b) - 2) if a[i : i + 3] == b[j : j + 3]]
        own, others = np.array(a, np.int32), np.array(b, np.int32)
        found = passage_pairs.best_passages([own] * len(places), [others] * len(places), [p for p, _ in places], [q for _, q in places], 10, 0.8) if places else []
        want = has_passage(a, b, 10, 0.8)
        assert any(found) == want
        seen.add(want)
    assert seen == {True, False}


def test_prefixes_of_two_windows_meet():
    """Windows that share `shared` values have one of them, the first in the order, among their prefixes."""
    rng = np.random.default_rng(4)
    for _ in range(200):
        width, shared = 12, int(rng.integers(1, 6))
        rank = rng.integers(0, 30, 40)
        kept = set(passage_pairs.prefixes(rank.astype(np.uint64), width, shared).tolist())
        for a in range(len(rank) - width + 1):
            common = rng.choice(width, shared, replace=False) + a
            first = min(rank[common])
            assert all(i in kept for i in range(a, a + width) if rank[i] == first)
    assert passage_pairs.fewest(50, 0.8) == 12 and passage_pairs.reach(50, 0.8) == 167


def test_changed_passages_lose_no_pair(spark):
    rng = random.Random(21)
    fresh = lambda n: invented(rng, n, 10**6)
    docs, wanted = [], set()

    def pair(passage, other, least=True):
        doc = 1000 + 10 * len(docs)
        docs.extend([(doc, f"{fresh(20)} {passage} {fresh(20)}"), (doc + 1, f"{fresh(35)} {other} {fresh(5)}")])
        wanted.update([(doc + 1, doc)] if least else [])

    for n in (50, 55, 60, 90, 150):
        for step in (5, 6, 8, 11) if n > 50 else (5, 6, 8):
            words = fresh(n).split(" ")
            pair(" ".join(words), " ".join(w if i % step != step // 2 else f"y{i}" for i, w in enumerate(words)))
            words = fresh(n).split(" ")
            inserted = " ".join(w if i % step != step // 2 or step == 5 else f"{w} y{i}" for i, w in enumerate(words))
            pair(" ".join(words), inserted)
    for n in (60, 75):  # all changes in the middle
        words = fresh(n).split(" ")
        pair(" ".join(words), " ".join(w if not n * 2 // 5 <= i < n * 3 // 5 else f"y{i}" for i, w in enumerate(words)))
    words = fresh(60).split(" ")
    pair(" ".join(words), " ".join(w if i % 4 else f"y{i}" for i, w in enumerate(words)), least=False)
    # parts of these passages occurred before, in shorter pieces
    words = fresh(80).split(" ")
    docs += [(1 + i, f"{fresh(9)} {' '.join(words[i * 16 : i * 16 + 16])} {fresh(9)}") for i in range(5)]
    pair(" ".join(words), " ".join(w if i % 9 else f"y{i}" for i, w in enumerate(words)))
    # two changed copies of a changed passage: all three pairs
    words = fresh(100).split(" ")
    docs += [(500 + j, " ".join(w if (i + 3 * j) % 10 else f"z{i}-{j}" for i, w in enumerate(words))) for j in range(3)]
    wanted |= {(501, 500), (502, 500), (502, 501)}
    rows = substring_dedup.repeated_passages(spark.createDataFrame([*docs, (7, None), (None, docs[0][1])], "doc_id bigint, text string")).collect()
    assert {(r["doc_id"], r["other_id"]) for r in rows} == wanted
    texts = {d: words_of(t) for d, t in docs}
    for r in rows:
        assert r["identity"] >= 0.8 and min(r["end_word"] - r["start_word"], r["other_end"] - r["other_start"]) >= 50
        assert r["end_word"] <= len(texts[r["doc_id"]]) and r["other_end"] <= len(texts[r["other_id"]])


def test_all_passages_of_a_pair_are_reported(spark):
    """Also those of pairs that have a row of another passage, or exact copies of another passage of a third document."""
    rng = random.Random(33)
    fresh = lambda n: invented(rng, n, 10**6)
    edited = lambda text: " ".join(w if i % 5 != 4 else f"y{i}" for i, w in enumerate(text.split(" ")))
    pieces = lambda text: [" ".join(text.split(" ")[i : i + 45]) for i in (0, 10, 20, 30, 35)]
    same, near, far, again, whole = fresh(70), fresh(74), fresh(94), fresh(80), fresh(80)
    docs = [(1000, f"{fresh(20)} {same} {fresh(30)} {near} {fresh(400)} {far} {fresh(9)}")]
    docs += [(1001, f"{fresh(3)} {same} {fresh(25)} {edited(near)} {fresh(380)} {edited(far)} {fresh(40)}")]
    # parts of these passages occurred before, each in a shorter piece
    docs += [(i, f"{fresh(9)} {piece} {fresh(9)}") for i, piece in enumerate([*pieces(again), *pieces(whole)])]
    docs += [(50, f"{fresh(30)} {same}")] + [(d, f"{fresh(40)} {same} {fresh(300)} {again} {fresh(30)}") for d in (2000, 2001)]
    docs += [(3000 + i, whole) for i in range(3)]
    rows = substring_dedup.repeated_passages(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    texts = {d: words_of(t) for d, t in docs}

    def reported(doc, other, passage):
        own = words_of(passage)
        at = next(i for i in range(len(texts[doc])) if texts[doc][i : i + 3] == own[:3])
        held = {i for r in rows if (r["doc_id"], r["other_id"]) == (doc, other) for i in range(r["start_word"], r["end_word"])}
        return set(range(at + 6, at + len(own) - 6)) <= held

    assert reported(1001, 1000, edited(near)) and reported(1001, 1000, edited(far)) and reported(1001, 50, same) and reported(1000, 50, same)
    assert reported(2000, 50, same) and reported(2001, 50, same) and reported(2001, 2000, again)
    assert {(r["doc_id"], r["other_id"]) for r in rows if r["doc_id"] >= 3000 and r["n_words"] == 80} == {(3001, 3000), (3002, 3000)}
    assert not [r for r in rows if (r["doc_id"], r["other_id"]) == (2001, 2000) and r["end_word"] <= 200]  # the copy of 50 is enough
    assert len({tuple(r) for r in rows}) == len(rows)


def test_no_import_from_elsewhere():
    import pathlib

    root = pathlib.Path(__file__).parents[2]
    for path in root.joinpath("refsync").rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"refsync\.llm|corpus_pipeline", path.read_text()), path
