"""Token counts: batch encoding inside Arrow functions that return lengths only.

Texts are split at safe boundaries, which is right after an ASCII white space byte: for tokenizers that drop white
space no token, no special string and no normalisation (composition never starts at a space) reaches across it. So a
text's count is the sum of its words' counts, and only words that a task has not met yet are encoded. They are packed
into batches of about equal bytes, and long texts are split in blocks first, so that neither a long text nor many of
them decide a task's memory. Tokenizers for which white space is part of a token (`split=False`) get whole texts.

Nulls: a null text counts as empty (0 bytes, 0 tokens, not over the limit); a null id is kept. Repeated rows are counted
one by one, an empty table gives an empty result. Texts without a safe boundary are encoded whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from refsync.llm import textops

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
BATCH_BYTES = 1 << 19
BLOCK_BYTES = 1 << 20
KNOWN_WORDS = 800_000
_ENDING = b".,;:!?$%&#*)"
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str) -> Callable[[list[str]], list[int]]:
    """Lengths of the encodings of some texts, without added special tokens, truncation or padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in pieces.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    encode = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
    return lambda texts: [len(e) for e in encode(texts, add_special_tokens=False)]


def packed(texts: Iterable[bytes], batch_bytes: int = BATCH_BYTES) -> Iterator[list[bytes]]:
    """Groups of about `batch_bytes`, in order."""
    group: list[bytes] = []
    held = 0
    for text in texts:
        group.append(text)
        held += len(text) + 64  # an encoding costs something besides its bytes
        if held >= batch_bytes:
            yield group
            group, held = [], 0
    if group:
        yield group


def blocks(text: bytes, block_bytes: int = BLOCK_BYTES) -> Iterator[bytes]:
    """A long text in blocks of about `block_bytes` that end at white space; without any it stays whole."""
    begin = 0
    while len(text) - begin > block_bytes:
        space = _SPACE.search(text, begin + block_bytes)
        if space is None:
            break
        yield text[begin : space.end()]
        begin = space.end()
    yield text[begin:]


class Counter:
    """Token counts of texts, with a bounded memory of words that were encoded before."""

    def __init__(self, encode: Callable[[list[str]], list[int]], split: bool = True):
        self.encode, self.split = encode, split
        self.known: dict[bytes, int] = {}

    def _learn(self, words: set[bytes]) -> None:
        """Encode the words not met before: each as stem and punctuation at its end, where both are safe to part.

        After an ASCII letter or digit, punctuation up to the white space is a piece of its own; A-Z become a-z. Words
        that may hold a special string are encoded as they are.
        """
        new = words.difference(self.known)
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known.clear()
            new = words
        parts: dict[bytes, tuple[bytes, bytes]] = {}
        for word in new:
            stem = word.rstrip(_ENDING)
            if stem[-1:].isalnum() and b"<|" not in word:
                parts[word] = stem.lower(), word[len(stem) :]
        alone = new.difference(parts).union(*parts.values()) if parts else new
        alone = alone.difference(self.known, [b""])
        self.known[b""] = 0
        for group in packed(alone):
            self.known.update(zip(group, self.encode([w.decode("utf-8") for w in group]), strict=True))
        for word, (stem, ending) in parts.items():
            self.known[word] = self.known[stem] + self.known[ending]

    def count(self, texts: list[bytes]) -> list[int]:
        if not self.split:
            return [n for group in packed(texts) for n in self.encode([t.decode("utf-8") for t in group])]
        found = [text.split() for text in texts]
        self._learn(set().union(*found))
        return [sum(map(self.known.__getitem__, own)) for own in found]


def lengths(texts: pa.Array, counter: Counter) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, tokens) of every text. New words of several texts are encoded together."""
    data, offsets = textops.text_buffers(texts)
    tokens = np.zeros(len(offsets) - 1, np.int64)
    for first, last in textops.slices(offsets, BLOCK_BYTES):
        own = [data[offsets[i] : offsets[i + 1]].tobytes() for i in range(first, last)]
        if counter.split and last == first + 1:
            tokens[first] = sum(counter.count([block])[0] for block in blocks(own[0]))
        else:
            tokens[first:last] = counter.count(own)
    return np.diff(offsets), tokens


def count_tokens(docs: DataFrame, text: str = "text", tokenizer: str = TOKENIZER, limit: int = LIMIT, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` with n_bytes, n_tokens and over_limit (n_tokens > `limit`).

    `tokenizer` is the name of a public tokenizer file; each worker opens its own machine's copy. Sentence-piece models
    treat white space as part of pieces, so texts are not split for them.
    """
    names = [c for c in keep if c not in ("n_bytes", "n_tokens", "over_limit")]
    source = docs.select(*names, docs[text].alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "__text")
    split = not tokenizer.endswith(".model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            counter = counter or Counter(encoder(tokenizer_path(tokenizer)), split)
            n_bytes, n_tokens = lengths(batch.column(batch.num_columns - 1), counter)
            columns = [*batch.columns[:-1], pa.array(n_bytes), pa.array(n_tokens), pa.array(n_tokens > limit)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "n_bytes", "n_tokens", "over_limit"])

    return source.mapInArrow(run, f"{fields}, n_bytes bigint, n_tokens bigint, over_limit boolean")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op6_token_counts": op6_token_counts}
SQL: dict[str, str] = {}
