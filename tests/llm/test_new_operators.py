"""Cross-tokenizer alignment, spelling variants and repeated strings against brute force."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest

from refsync.llm import run_index, spelling, suffix_dedup, token_alignment

DOCS = "doc_id bigint, text string, n_a string, word string"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", "y") for d, t in rows], DOCS)


# --- run-length index -----------------------------------------------------------------------------------------


def texts_of(parts, homes):
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return run_index.Texts(np.frombuffer(b"".join(parts), np.uint8), offsets, np.array(homes, np.int64))


@pytest.mark.parametrize("seed", range(5))
def test_matching_statistics(seed):
    rng = random.Random(seed)
    for _ in range(20):
        letters = b"abcd"[: rng.choice([1, 2, 4])]
        made = lambda n: [bytes(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(n)]  # noqa: B023, E731
        indexed, queries = made(rng.randrange(1, 12)), made(rng.randrange(8))
        homes, own = [rng.randrange(3) for _ in indexed], [rng.randrange(4) for _ in queries]
        got = run_index.RunIndex(texts_of(indexed, homes)).matching_statistics(texts_of(queries, own))
        want = []
        for q, h in zip(queries, own, strict=True):
            for i in range(len(q)):
                n = 0
                while i + n < len(q) and any(q[i : i + n + 1] in x for x, y in zip(indexed, homes, strict=True) if y == h):
                    n += 1
                want.append(n)
        assert got.tolist() == want
        some = run_index.RunIndex(texts_of(indexed, homes)).matching_statistics(texts_of(queries, own), least=7)
        assert [max(n, 6) for n in some.tolist()] == [max(n, 6) for n in want]


def test_runs_of_repetitive_texts_are_few():
    text = bytes(random.Random(1).randrange(97, 123) for _ in range(300))
    one, many = (run_index.RunIndex(texts_of([text] * n, [0] * n)) for n in (1, 50))
    assert len(many.run_start) < 1.2 * len(one.run_start)  # not 50 times as many


# --- repeated strings -----------------------------------------------------------------------------------------


def kept_by_brute_force(rows):
    first = {}
    for d, t in rows:
        raw = (t or "").encode()
        for i in range(len(raw) - 49) if d is not None else ():
            first[raw[i : i + 50]] = min(d, first.get(raw[i : i + 50], d))
    out = []
    for d, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - 49) if d is not None else ():
            gone[i : i + 50] |= first[raw[i : i + 50]] < d
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(raw) else 0
        out.append((d, len(raw), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [suffix_dedup.HOT_PIECES, 3])
def test_repeated_strings(spark, hot):
    rng = random.Random(2)
    text = lambda n: "".join(rng.choice("abcdefgh é€\n") for _ in range(n))
    passage, other = text(200), text(90)
    rows = [(7, None), (8, ""), (9, "x" * 49), (3, "x" * 50), (4, "x" * 50), (5, "x" * 700), (2, "xy" * 400), (6, "yx" * 300)]
    rows += [(100 + i, text(60) + passage[rng.randrange(60) : 200 - rng.randrange(60)] + text(30)) for i in range(40)]
    rows += [(200 + i, other + text(5)) for i in range(20)]  # many pieces under few keys
    rows += [(300, text(20_000)), (301, passage + passage), (302, other + passage + other)]
    rows += [rows[10]] * 3 + [(rows[10][0], passage), (None, passage), (-5, rows[12][1]), (None, rows[12][1])]
    rows += [(400 + i, passage) for i in range(60)]
    rng.shuffle(rows)
    got = suffix_dedup.remove_repeated(frame(spark, rows), hot_pieces=hot)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == kept_by_brute_force(rows)


def test_no_texts_to_compare(spark):
    assert suffix_dedup.remove_repeated(frame(spark, [(1, "a")]).limit(0)).count() == 0
    assert [tuple(r)[1:4] for r in suffix_dedup.remove_repeated(frame(spark, [(1, "a"), (2, None)])).orderBy("doc_id").collect()] == [(1, 0, 0), (0, 0, 0)]


# --- alignment ------------------------------------------------------------------------------------------------


def aligned_by_brute_force(rows):
    from tokenizers import Tokenizer

    path = token_alignment.tokenizer_path
    library = Tokenizer.from_file(path(token_alignment.TOKENIZER_A))
    library.encode_special_tokens = True
    bytes_a = token_alignment.open_byte_level(path(token_alignment.TOKENIZER_A)).tokens
    second = token_alignment.open_pieces(path(token_alignment.TOKENIZER_B))
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=path(token_alignment.TOKENIZER_B))
    held, counts = [], collections.Counter()
    for d, t in rows:
        a, b = (library.encode(" " + t, add_special_tokens=False).ids, pieces.encode(t)) if t else ([], [])
        whole = (" " + (t or "")).encode()
        x, y = [bytes_a[i] for i in a], [second.tokens[i] for i in b]
        if b"".join(x) != whole or b"".join(y) != whole:
            held.append((d, 0, 0, [], []))
            continue
        ends_a, ends_b = np.cumsum([len(i) for i in x]).tolist(), np.cumsum([len(i) for i in y]).tolist()
        groups, from_a, from_b = [], 0, 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            to_a, to_b = ends_a.index(cut) + 1, ends_b.index(cut) + 1
            groups.append((a[from_a:to_a], b[from_b:to_b]))
            from_a, from_b = to_a, to_b
        links = [(i, j) for u, v in groups for i in u for j in v]
        counts.update(set(links))
        held.append((d, len(a), len(b), groups, links))
    most = collections.defaultdict(int)
    for (i, _), n in counts.items():
        most[i] = max(most[i], n)
    out = []
    for d, n_a, n_b, groups, links in held:
        written = ";".join(f"{','.join(map(str, u))}|{','.join(map(str, v))}" for u, v in groups)
        digest = hashlib.sha256(written.encode()).hexdigest() if groups else ""
        out.append((d, n_a, n_b, len(groups), len(links), sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links), digest))
    return sorted(out, key=str)


def test_alignment(spark):
    rng = random.Random(3)
    words = ["The", "naïve", "tokenizer", "<|endoftext|>", "<s>", "don't", "12345", "x_y", "\n\n", "  ", "日本語", "🙂👍🏽", "²³", "\x1c", "́", "ﬁ", "\t", "<0x41>", "▁", "a" * 70]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))) for _ in range(40)]
    texts += ["".join(rng.choice(words) for _ in range(20)) for _ in range(20)] + ["=" * 5_000, " " * 300, " lead", "trail ", "é", "A", "🙂" * 200]
    rows = [(i, t) for i, t in enumerate(texts)] + [(900, None), (901, ""), (None, texts[0]), (902, texts[1]), (902, texts[1]), (902, texts[2])]
    got = token_alignment.align(frame(spark, rows))
    assert got.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").count() == len(rows)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.select(columns).collect()), key=str) == aligned_by_brute_force(rows)
    assert token_alignment.align(frame(spark, rows).limit(0)).count() == 0


def test_groups_with_many_links_and_small_chunks(spark, monkeypatch):
    rows = [(i, f"word{i % 7} other{i % 3} " + "=" * (i * 3)) for i in range(60)]
    want = sorted(map(str, token_alignment.align(frame(spark, rows)).collect()))
    aligner = token_alignment._aligner(token_alignment.TOKENIZER_A, token_alignment.TOKENIZER_B)
    listed = aligner([t for _, t in rows])
    monkeypatch.setattr(token_alignment, "LISTED_LINKS", 0)
    counted = aligner([t for _, t in rows])
    for x, y in zip(listed, counted, strict=True):
        assert x[:5] == y[:5] and (x.pairs == y.pairs).all() and (x.times == y.times).all()
    texts = token_alignment.distinct_texts(frame(spark, rows))
    chunks = token_alignment.align_texts(texts, chunk_pairs=50).filter("text_id IS NULL").count()
    assert chunks > 5 and len(want) == 60


# --- spelling -------------------------------------------------------------------------------------------------


def grouped_by_brute_force(counts):
    near = {w: [v for v in counts if spelling.one_edit_apart(w, v)] for w in counts}
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, counts[w], len(near[w]), form[w], form[w] and counts[form[w]], root))
    return sorted(out, key=str)


def edit_distance_is_one(a, b):
    table = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, table[0] = table[0], i
        for j, y in enumerate(b, 1):
            before, table[j] = table[j], min(table[j] + 1, table[j - 1] + 1, before + (x != y))
    return table[-1] == 1


def test_one_edit_apart():
    rng = random.Random(5)
    for _ in range(2_000):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(6))) for _ in range(2))
        assert spelling.one_edit_apart(a, b) == edit_distance_is_one(a, b)


@pytest.mark.parametrize("levels", [spelling.DEALT_LEVELS, spelling.WIDE_LEVELS])
def test_near_words(spark, monkeypatch, levels):
    rng = random.Random(6)
    monkeypatch.setattr(spelling, "WIDE", 0 if levels == spelling.WIDE_LEVELS else 10**9)
    monkeypatch.setattr(spelling, "BLOCK", 64)
    counts = {}
    for _ in range(120):
        word = "".join(rng.choice("abeé") for _ in range(rng.randrange(6, 9)))
        counts[word] = rng.randrange(5, 400)
        counts["".join(rng.sample(word, len(word)))] = rng.randrange(5, 50)
    long_ = "ab" * 50
    counts |= {long_: 500, long_ + "a": 60, long_[1:]: 5, "x" * 1500: 10, "x" * 1499: 50, "aaaaaa": 5, "aaaaaaa": 25, "aaaaaaaa": 125}
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    got = spelling.group_spellings(words).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert sorted(map(tuple, got), key=str) == grouped_by_brute_force(counts)
    assert {r["root"] for r in got if r["word"] == "aaaaaa"} == {"aaaaaaaa"}


def test_vocabulary_of_documents(spark, monkeypatch):
    import re
    import zlib

    monkeypatch.setattr(spelling, "BLOCK_LETTERS", 50)
    rng = random.Random(7)
    bases = ["spelling", "Variant", "élève", "naïveté", "ÉCOLE", "x×÷yzabc", "groups"]
    rows = [(i, " ".join(rng.choice(bases) + rng.choice(["", "s", ".", "1a", "-"]) for _ in range(80))) for i in range(120)]
    rows += [(None, "spelling spelling"), (1, None), (2, ""), (3, "z" * 300), (4, rows[0][1]), (4, rows[0][1])]
    want = collections.Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{d}:{run}".encode()) if d is not None else 1
            want[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    want = {w: n for w, n in want.items() if len(w) >= 6 and n >= 5}
    got = spelling.vocabulary(frame(spark, rows))
    assert dict(map(tuple, got.collect())) == want
    assert spelling.group_spellings(spelling.vocabulary(frame(spark, rows).limit(0))).count() == 0
