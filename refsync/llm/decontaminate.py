"""Benchmark decontamination: MinHash containment search partitioned by size, then exact shingle containment.

A short item inside a long document has a tiny Jaccard similarity with it, so one MinHash signature for all sizes finds
nothing. Documents are therefore partitioned by size (powers of two of their shingle count), and each partition has its
own number of MinHash bins: one permutation, cut into `bins_per_shingle` times the partition's largest size, the
minimum of each bin is the signature. A shared shingle is then the minimum of its bin in both signatures with a known
probability p, and an item that shares s of its shingles is missed with (1 - p)^s. `bins_per_shingle` is chosen from
that, for the smallest item, so that a miss has a chance below `MISS`. Items so small that no number of bins is enough
have all their shingles compared instead. Every candidate is verified with its whole shingle sets.

The items' signatures travel to the tasks in blocks of at most `BLOCK_SHINGLES` shingles; more items mean more passes
over the documents, never a larger block. Documents are not shuffled.

Definitions: words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased; the shingles of a text are the distinct runs of five
words, or its whole sequence if it has fewer words. A document is contaminated by an item if it holds at least 0.8 of
the item's shingles. Shingles are compared as 64-bit hashes. Null or wordless texts hold and are nothing; null ids are
carried along; a repeated document row is reported for each row, a repeated item row once; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refsync.llm import textops

WORDS_PER_SHINGLE = 5
THRESHOLD = 0.8
MISS = 1e-9
MOST_BINS_PER_SHINGLE = 16
BLOCK_SHINGLES = 1 << 20


def bins_per_shingle(shared: int, miss: float = MISS) -> int | None:
    """Smallest power of two for which `shared` common shingles are all missed with a chance of at most `miss`."""
    bins = 1
    while bins <= MOST_BINS_PER_SHINGLE:
        load = 1 / bins  # at most, as a partition's sizes reach up to its bound
        if (1 - (1 - math.exp(-load)) / load) ** shared <= miss:
            return bins
        bins *= 2
    return None


class Items:
    """A block of items: shingle sets, and their signatures for each size partition."""

    def __init__(self, sets: list[np.ndarray], threshold: float):
        self.sets = sets
        self.needed = [max(1, math.ceil(Fraction(str(threshold)) * len(s))) for s in sets]
        per_item = [bins_per_shingle(n) for n in self.needed]
        self.whole = [i for i, bins in enumerate(per_item) if bins is None]
        self.signed = [i for i, bins in enumerate(per_item) if bins is not None]
        self.log_bins = int(math.log2(max([per_item[i] for i in self.signed], default=1)))
        self._tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self._whole = self._table(self.whole, None)

    def _table(self, items: list[int], shift: int | None) -> tuple[np.ndarray, np.ndarray]:
        values = [self.sets[i] if shift is None else minima(self.sets[i], shift) for i in items]
        owners = np.repeat(np.array(items, np.int64), [len(v) for v in values])
        joined = np.concatenate(values) if values else np.zeros(0, np.uint64)
        order = np.argsort(joined, kind="stable")
        return joined[order], owners[order]

    def table(self, size_class: int) -> tuple[np.ndarray, np.ndarray]:
        if size_class not in self._tables:
            self._tables[size_class] = self._table(self.signed, 64 - size_class - self.log_bins)
        return self._tables[size_class]

    def candidates(self, shingles: np.ndarray) -> set[int]:
        """Items that share a minimum (or, if very small, any shingle) with a text's sorted distinct shingles."""
        found: set[int] = set()
        size_class = max(0, math.ceil(math.log2(len(shingles))))
        signature = minima(shingles, 64 - size_class - self.log_bins)
        for (values, owners), own in ((self.table(size_class), signature), (self._whole, shingles)):
            if len(values):
                low, high = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
                for a, b in zip(low[low < high].tolist(), high[low < high].tolist(), strict=True):
                    found.update(owners[a:b].tolist())
        return found

    def held_by(self, shingles: np.ndarray) -> list[tuple[int, int]]:
        """(item, shared shingles) of the items that a text holds."""
        out = []
        for i in sorted(self.candidates(shingles)) if len(shingles) else ():
            own = self.sets[i]
            places = np.minimum(np.searchsorted(shingles, own), len(shingles) - 1)
            shared = int((shingles[places] == own).sum())
            if shared >= self.needed[i]:
                out.append((i, shared))
        return out


def minima(values: np.ndarray, shift: int) -> np.ndarray:
    """First of each bin of sorted values; a value's bin is its leading bits."""
    if shift <= 0:
        return values
    bins = values >> np.uint64(min(shift, 63)) if shift < 64 else np.zeros(len(values), np.uint64)
    return values[np.concatenate([[True], bins[1:] != bins[:-1]])] if len(values) else values


def _sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    data, offsets = textops.text_buffers(texts)
    for first, last in textops.slices(offsets, textops.SMALL_SLICE_BYTES):
        found = textops.words(data, offsets[first : last + 1])
        hashes, own = textops.shingles(found.hashes, found.offsets, k)
        for a, b in zip(own[:-1].tolist(), own[1:].tolist(), strict=True):
            yield np.unique(hashes[a:b])


def _blocks(items: DataFrame, k: int, block_shingles: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    """(ids, shingle sets) of the items in bounded blocks, one partition at a time on the driver."""
    ids: list = []
    sets: list[np.ndarray] = []
    held = 0
    for row in items.toLocalIterator():
        own = next(_sets(pa.array([row[1]], pa.string()), k))
        if len(own):
            ids.append(row[0])
            sets.append(own)
            held += len(own)
        if held >= block_shingles:
            yield ids, sets
            ids, sets, held = [], [], 0
    if ids:
        yield ids, sets


def _item_rows(benchmark: DataFrame, item_id: str, item_text: str) -> DataFrame:
    return benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).dropna(subset=["text"]).dropDuplicates()


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    k: int = WORDS_PER_SHINGLE,
    threshold: float = THRESHOLD,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment) of every document and item it is contaminated by."""
    spark = docs.sparkSession
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type, item_type = source.schema["doc_id"].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString()
    schema = f"doc_id {id_type}, item_id {item_type}, n_shared bigint, n_item bigint, containment double"
    out = spark.createDataFrame([], schema)
    for ids, sets in _blocks(_item_rows(benchmark, item_id, item_text), k, block_shingles):
        shared_block = spark.sparkContext.broadcast((ids, sets))

        def run(batches: Iterator[pa.RecordBatch], block=shared_block) -> Iterator[pa.RecordBatch]:
            names, item_sets = block.value
            items = Items(item_sets, threshold)
            for batch in batches:
                rows, found, counts = [], [], []
                for row, own in enumerate(_sets(batch.column(1), k)):
                    for item, shared in items.held_by(own):
                        rows.append(row)
                        found.append(item)
                        counts.append(shared)
                if not rows:
                    continue
                sizes = [len(item_sets[i]) for i in found]
                taken = batch.column(0).take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [taken, pa.array([names[i] for i in found]), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(np.array(counts) / np.array(sizes))],
                    ["doc_id", "item_id", "n_shared", "n_item", "containment"],
                )

        out = out.unionByName(source.mapInArrow(run, schema))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", k: int = WORDS_PER_SHINGLE, threshold: float = THRESHOLD, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """The documents that hold no item, all columns as they are."""
    at = docs.columns.index(text)
    for _, sets in _blocks(_item_rows(benchmark, item_id, item_text), k, block_shingles):
        shared_block = docs.sparkSession.sparkContext.broadcast(sets)

        def run(batches: Iterator[pa.RecordBatch], block=shared_block) -> Iterator[pa.RecordBatch]:
            items = Items(block.value, threshold)
            for batch in batches:
                clean = [not items.held_by(own) for own in _sets(batch.column(at), k)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contaminated documents, one row per document and item."""
    return find_contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
_SHINGLES = "CASE WHEN len(w) >= 5 THEN list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END"
SQL = {
    "op1_decontamination": f"""
WITH d AS (SELECT doc_id, unnest({_SHINGLES}) AS s FROM (SELECT doc_id, {_WORDS} AS w FROM documents)),
b AS (SELECT item_id, len(ss) AS n_item, unnest(ss) AS s FROM (SELECT item_id, {_SHINGLES} AS ss FROM (SELECT item_id, {_WORDS} AS w FROM benchmark)))
SELECT doc_id, item_id, count(*) AS n_shared, n_item::BIGINT AS n_item, count(*) / n_item AS containment
FROM d JOIN b USING (s) GROUP BY doc_id, item_id, n_item HAVING count(*) * 5 >= n_item * 4""",
}
QUERIES = {"op1_decontamination": op1_decontamination}
