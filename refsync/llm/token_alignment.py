"""Cross-tokenizer alignment: how the tokens of two tokenizers cover the same bytes, per document and corpus-wide.

Texts are first made distinct by a shuffle on the full text that counts the copies. Each distinct text is tokenised and
aligned once. Byte offsets where tokens of both tokenizers end cut a text into groups; every A token of a group is linked
with every B token of it. A pair of ids counts the documents that hold it linked, so the pairs of a text weigh as many
documents as there are copies of it. At last the measures of a text are joined to the ids of all documents that have it.

What travels is small: a task puts aligned texts into chunks of a bounded number of pairs and writes, per chunk, the
distinct pairs once with their weights and, per text, places in that list. Only the lists are counted and joined with the
corpus-wide counts; a pair that every document holds has one row per chunk. Counts return to the chunk they came from.

Defined results: texts that are null or empty, or that one of the tokenizers cannot give back byte by byte, have no tokens
(zeros, empty digest). Repeated rows and equal texts count as documents of their own and get the same measures; null ids
are kept. An empty table gives an empty result. Other columns of the input are not looked at. Texts are encoded by parts
that are encoded alike wherever they stand (pieces of the first tokenizer's pattern; words with the spaces before them for
the second), each part once per task; where that is not certain, texts are encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refsync.llm.token_counts import tokenizer_path
from refsync.sources.storage import stage

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
#: Bound of a chunk: distinct pairs of its texts, each text counted for itself.
CHUNK_PAIRS = 1 << 20
#: Texts that are encoded together.
BATCH_BYTES = 1 << 19
#: Groups with more links than this are counted by distinct ids instead of listing their links.
LISTED_LINKS = 4096
#: Parts of texts that a task remembers the encoding of, and the longest of them.
KNOWN_PARTS, LONGEST_KNOWN = 400_000, 64


class Tokenizer(NamedTuple):
    """Splitting of a text into parts that are encoded alike wherever they stand, encoding of parts, bytes of every token."""

    parts: Callable[[str], list[str]]
    encode: Callable[[list[str]], list[list[int]]]
    tokens: list[bytes]


def _byte_letters() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable bytes stand for themselves, the others follow from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


#: Letters whose class is the same in all character tables (and numbers that are no digits left out); other texts are encoded whole.
_SETTLED = re.compile("[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f\u2010-\u2027\u4e00-\u9fa5]")
#: `public_tokenizers.PATTERN` for such texts, in which letters and digits are what `\w` matches besides `_`.
_PARTS = re.compile(r"'(?:[sdmt]|ll|ve|re)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


def open_byte_level(path: str) -> Tokenizer:
    """A byte-level tokenizer; special strings are plain text. Its merges stay inside the pieces of the usual splitting
    pattern; a tokenizer that splits otherwise gets whole texts."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer as Library

    tokenizer = Library.from_file(path)
    tokenizer.encode_special_tokens = True
    tokenizer.no_truncation()
    tokenizer.no_padding()
    letters = _byte_letters()
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    tokens = [b""] * (max(vocabulary.values()) + 1)
    for entry, i in vocabulary.items():
        tokens[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
    batch = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
    encode = lambda texts: [e.ids for e in batch(texts, add_special_tokens=False)]
    setup = json.loads(tokenizer.to_str())
    usual = setup["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} and not setup["normalizer"]
    split = lambda text: [text] if not usual or _SETTLED.search(text) else _PARTS.findall(text)
    return Tokenizer(split, encode, tokens)


_WITH_SPACES = re.compile(" *[^ ]+| +")


def open_pieces(path: str) -> Tokenizer:
    """A sentence-piece model, which adds the space itself; byte pieces are bytes, U+2581 is a space.

    If no piece goes on after a space that follows something else, and spaces are kept, parts end before spaces."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens, inner = [], False
    for i in range(pieces.get_piece_size()):
        piece = pieces.id_to_piece(i)
        inner |= "▁" in piece.lstrip("▁")
        tokens.append(bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode())
    probe = " a  b\n c "
    found = pieces.encode(probe)
    safe = not inner and b"".join(tokens[i] for i in found) == f" {probe}".encode()
    alone = found[-1:]  # a space that nothing follows

    def encode(texts: list[str]) -> list[list[int]]:
        """Every part begins with a space, which the model adds, but not to an empty rest."""
        ids = pieces.encode([t[1:] for t in texts], num_threads=1)
        return [alone if t == " " else own for t, own in zip(texts, ids, strict=True)]

    # a written U+2581 is a space to the model
    split = lambda text: _WITH_SPACES.findall(text) if safe and "▁" not in text else [text]
    return Tokenizer(split, encode, tokens)


def open_tokenizer(name: str) -> Tokenizer:
    path = tokenizer_path(name)
    return open_pieces(path) if path.endswith(".model") else open_byte_level(path)


class Encoder:
    """Encodes texts with a space before each; parts that were met before are not encoded again (a bounded memory)."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer = tokenizer
        self.known: dict[str, bytes] = {}  # ids as 32-bit integers
        self.odd: set[str] = set()  # parts whose tokens do not give back their bytes

    def __call__(self, texts: list[str]) -> tuple[list[bytes], list[bool]]:
        """(ids of each text, whether they give back its bytes)"""
        split = [self.tokenizer.parts(" " + text) for text in texts]
        wanted = set().union(*split)
        new = wanted.difference(self.known)
        if len(self.known) + len(new) > KNOWN_PARTS:
            self.known.clear()
            new = wanted
        parts = list(new)
        for part, ids in zip(parts, self.tokenizer.encode(parts), strict=True):
            self.known[part] = np.array(ids, np.int32).tobytes()
            if b"".join(map(self.tokenizer.tokens.__getitem__, ids)) != part.encode("utf-8"):
                self.odd.add(part)
        found = [b"".join(map(self.known.__getitem__, own)) for own in split]
        good = [True] * len(texts)
        if self.odd and self.odd & wanted:
            tokens = self.tokenizer.tokens.__getitem__
            good = [b"".join(map(tokens, np.frombuffer(ids, np.int32).tolist())) == b" " + t.encode("utf-8") for ids, t in zip(found, texts, strict=True)]
        for part in parts:
            if len(part) > LONGEST_KNOWN:
                del self.known[part]
                self.odd.discard(part)
        return found, good


class Alignment(NamedTuple):
    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    digest: str
    pairs: np.ndarray  # distinct linked pairs, a << 32 | b, and their number of links
    times: np.ndarray


NOTHING = Alignment(0, 0, 0, 0, "", *[np.zeros(0, np.int64)] * 2)


class Aligner:
    """Aligns the tokens of two tokenizers over the bytes of texts."""

    def __init__(self, first: Tokenizer, second: Tokenizer):
        self.tokens = first.tokens, second.tokens
        self.encode = Encoder(first), Encoder(second)
        self.sizes = [np.array([len(t) for t in tokens], np.int64) for tokens in self.tokens]
        #: Written forms of an id inside a group and at the end of its side, for both sides.
        self.written = [f"{i}{mark}" for tokens, marks in zip(self.tokens, (",|", ",;"), strict=True) for mark in marks for i in range(len(tokens))]
        self.starts = np.cumsum([0, len(first.tokens), len(first.tokens), len(second.tokens)])

    def __call__(self, texts: list[str]) -> list[Alignment]:
        (ids_a, good_a), (ids_b, good_b) = (encode(texts) for encode in self.encode)
        good = [i for i in range(len(texts)) if good_a[i] and good_b[i]]
        found = [NOTHING] * len(texts)
        for i, own in zip(good, self.align([ids_a[i] for i in good], [ids_b[i] for i in good]) if good else (), strict=True):
            found[i] = own
        return found

    def align(self, ids_a: list[bytes], ids_b: list[bytes]) -> list[Alignment]:
        """Groups and links of two encodings of the same texts. The texts are worked on as one, since both encodings end
        where a text ends."""
        a, b = (np.frombuffer(b"".join(own), np.int32).astype(np.int64) for own in (ids_a, ids_b))
        n_a, n_b = ([len(x) // 4 for x in own] for own in (ids_a, ids_b))
        end_a, end_b = np.cumsum(n_a), np.cumsum(n_b)
        ends_a, ends_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        cuts = ends_a[ends_b[np.searchsorted(ends_b, ends_a)] == ends_a]
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        in_a, in_b = np.bincount(group_a), np.bincount(group_b)
        first_a, first_b = (np.concatenate([[0], np.cumsum(n)]) for n in (in_a, in_b))
        links = in_a * in_b
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[first_a[1:] - 1] = 1
        last_b[first_b[1:] - 1] = 1
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + first_b[group_a]] = a + self.starts[last_a]
        order[np.arange(len(b)) + first_a[group_b + 1]] = b + self.starts[2 + last_b]
        texts = len(ids_a)
        last_group = group_a[end_a - 1] + 1
        first_group = np.concatenate([[0], last_group[:-1]])
        text_of = np.repeat(np.arange(texts), last_group - first_group)
        listed = self._listed(a, b, first_a, first_b, in_b, links)
        counted = list(self._counted(a, b, first_a, first_b, links))
        text, pair, times = (np.concatenate(x) for x in zip(listed, *counted, strict=True))
        text = text_of[text]
        ordered = np.lexsort((pair, text))
        text, pair, times = text[ordered], pair[ordered], times[ordered]
        at = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (text[1:] != text[:-1])]))
        times = np.add.reduceat(times, at)
        pair, bounds = pair[at], np.searchsorted(text[at], np.arange(texts + 1))
        total = np.concatenate([[0], np.cumsum(links)])
        spans = np.concatenate([[0], end_a + end_b])
        written, codes = self.written.__getitem__, order.tolist()
        out = []
        for i in range(texts):
            digest = hashlib.sha256("".join(map(written, codes[spans[i] : spans[i + 1]]))[:-1].encode()).hexdigest()
            own = slice(bounds[i], bounds[i + 1])
            n_links = int(total[last_group[i]] - total[first_group[i]])
            out.append(Alignment(n_a[i], n_b[i], int(last_group[i] - first_group[i]), n_links, digest, pair[own], times[own]))
        return out

    def _listed(self, a, b, first_a, first_b, in_b, links) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(group, pair, 1) of every link of the groups with few of them."""
        own = np.flatnonzero(links <= LISTED_LINKS)
        n = links[own]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        width = np.repeat(in_b[own], n)
        left = np.repeat(first_a[own], n) + inner // np.maximum(width, 1)
        right = np.repeat(first_b[own], n) + inner % np.maximum(width, 1)
        return np.repeat(own, n), a[left] << 32 | b[right], np.ones(len(inner), np.int64)

    def _counted(self, a, b, first_a, first_b, links) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Groups with many links: distinct ids times distinct ids, with how often each occurs."""
        for g in np.flatnonzero(links > LISTED_LINKS):
            left, n_left = np.unique(a[first_a[g] : first_a[g + 1]], return_counts=True)
            right, n_right = np.unique(b[first_b[g] : first_b[g + 1]], return_counts=True)
            pairs = (left[:, None] << 32 | right).ravel()
            yield np.full(len(pairs), g), pairs, (n_left[:, None] * n_right).ravel()


@lru_cache(maxsize=1)
def _aligner(first: str, second: str) -> Aligner:
    """One per worker: its tasks share what it remembers."""
    return Aligner(open_tokenizer(first), open_tokenizer(second))


MEASURES = ("n_a", "n_b", "n_groups", "n_links")
_CHUNK_SCHEMA = (
    "chunk bigint, text_id binary, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "at array<int>, times array<bigint>, a array<int>, b array<int>, documents array<bigint>"
)
_ARROW = pa.schema(
    [
        ("chunk", pa.int64()), ("text_id", pa.binary()), *[(c, pa.int64()) for c in MEASURES], ("groups_sha256", pa.string()),
        ("at", pa.list_(pa.int32())), ("times", pa.list_(pa.int64())),
        ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())), ("documents", pa.list_(pa.int64())),
    ]
)


def _batches(rows: Iterator[tuple[bytes, str, int]]) -> Iterator[list[tuple[bytes, str, int]]]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[1]) + 64
        if size >= BATCH_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts) if parts else [], kind))


def _chunk(number: int, held: list[tuple[bytes, int, Alignment]]) -> pa.RecordBatch:
    """A row per text, and a first row with the chunk's distinct pairs and the documents that hold them."""
    sizes = [len(x.pairs) for _, _, x in held]
    weight = np.repeat(np.array([copies for _, copies, _ in held], np.int64), sizes)
    pairs, place = np.unique(np.concatenate([x.pairs for _, _, x in held]), return_inverse=True)
    documents = np.zeros(len(pairs), np.int64)
    np.add.at(documents, place, weight)
    texts = len(held)
    bounds = np.cumsum(sizes)[:-1]
    nothing = np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number] * (texts + 1), pa.int64()),
            pa.array([None, *[text_id for text_id, _, _ in held]], pa.binary()),
            *[pa.array([None, *[getattr(x, c) for _, _, x in held]], pa.int64()) for c in MEASURES],
            pa.array([None, *[x.digest for _, _, x in held]], pa.string()),
            _lists([nothing, *np.split(place, bounds)], pa.int32()),
            _lists([nothing, *[x.times for _, _, x in held]], pa.int64()),
            _lists([pairs >> 32, *[nothing] * texts], pa.int32()),
            _lists([pairs & 0xFFFFFFFF, *[nothing] * texts], pa.int32()),
            _lists([documents, *[nothing] * texts], pa.int64()),
        ],
        schema=_ARROW,
    )


def align_texts(texts: DataFrame, first: str = TOKENIZER_A, second: str = TOKENIZER_B, chunk_pairs: int = CHUNK_PAIRS) -> DataFrame:
    """Alignments of distinct texts (text_id, text, copies), in chunks: see `_chunk`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        rows = (row for batch in batches for row in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True))
        held, size, chunks = [], 0, 0
        for group in _batches(rows):
            for (text_id, _, copies), found in zip(group, _aligner(first, second)([text for _, text, _ in group]), strict=True):
                held.append((text_id, copies, found))
                size += len(found.pairs) + 16
                if size >= chunk_pairs:
                    yield _chunk(task + chunks, held)
                    held, size, chunks = [], 0, chunks + 1
        if held:
            yield _chunk(task + chunks, held)

    return texts.select("text_id", "text", "copies").mapInArrow(run, _CHUNK_SCHEMA)


def _measured(key: tuple, texts: pa.Table, counts: pa.Table) -> pa.Table:
    """Measures of one chunk's texts from the corpus-wide counts of its pairs."""
    at = counts["at"].to_numpy()
    count, best = np.zeros(len(at), np.int64), np.zeros(len(at), bool)
    count[at], best[at] = counts["count"].to_numpy(), counts["best"].to_numpy()
    lists = texts["at"].combine_chunks()
    places, sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
    times = texts["times"].combine_chunks().flatten().to_numpy()
    ends = np.cumsum(sizes)

    def sums(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[ends] - total[ends - sizes]

    out = texts.drop_columns(["chunk", "at", "times"])
    out = out.append_column("n_best", pa.array(sums(times * best[places]), pa.int64()))
    return out.append_column("count_sum", pa.array(sums(times * count[places]), pa.int64()))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, count, best): documents that hold a pair linked, and whether no pair of the same a has more."""
    pairs = aligned.select(F.explode(F.arrays_zip("a", "b", "documents")).alias("p"))
    counts = stage(pairs.groupBy(F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.sum("p.documents").alias("count")), "pair-counts")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def distinct_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(text_id, text, copies) of the texts that are not empty: a shuffle by the full text, copies counted before it."""
    own = docs.select(docs[text].alias("text")).filter("text <> ''")
    return own.groupBy("text").agg(F.count("*").alias("copies")).select(F.unhex(F.sha2("text", 256)).alias("text_id"), "text", "copies")


def align(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", first: str = TOKENIZER_A, second: str = TOKENIZER_B) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    aligned = stage(align_texts(distinct_texts(docs, text), first, second), "aligned")
    counts = stage(pair_counts(aligned.filter("text_id IS NULL")), "pair-best")
    listed = aligned.filter("text_id IS NULL").select(F.col("chunk").alias("of_chunk"), F.posexplode(F.arrays_zip("a", "b")).alias("at", "p"))
    known = listed.select("of_chunk", "at", F.col("p.a").alias("a"), F.col("p.b").alias("b")).join(counts, ["a", "b"]).select("of_chunk", "at", "count", "best")
    texts = aligned.filter("text_id IS NOT NULL").select("chunk", "text_id", *MEASURES, "groups_sha256", "at", "times")
    schema = "text_id binary, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, n_best bigint, count_sum bigint"
    measured = stage(texts.groupBy("chunk").cogroup(known.groupBy("of_chunk")).applyInArrow(_measured, schema), "measured")
    own = docs.select(docs[doc_id].alias("doc_id"), F.unhex(F.sha2(docs[text], 256)).alias("text_id"))
    joined = own.join(measured, "text_id", "left")
    numbers = [F.coalesce(c, F.lit(0)).alias(c) for c in (*MEASURES, "n_best", "count_sum")]
    return joined.select("doc_id", *numbers, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of the byte-level and the piece tokenizer over all documents."""
    return align(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op11_cross_tokenizer_alignment": op11_cross_tokenizer_alignment}
SQL: dict[str, str] = {}
