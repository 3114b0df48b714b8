"""N-gram Jaccard join by partitioning the universe of shingles, exact.

Documents are sets of distinct word shingles. Sizes are cut into bands such that two linked sets lie in one band or in
neighbouring ones. A band's scheme hashes every shingle into one of m segments. Two linked sets differ in at most H
shingles (H follows from the band's largest sizes), so by the pigeonhole principle, with m = e + d segments and
e + 2 d = H + 1, they are equal in one of e segments, or differ by at most one shingle in one of d segments. Hence each
set is indexed by its e segment subsets, and by the subsets and their one-deletion neighbourhoods for the other d. How
many segments are of which kind is decided per band by cost: rows to index, which deletions raise, against false
candidates, which few and large segments avoid; the sizes of the bands come from all documents.

Sets that share a key are candidates. Keys and their sets are shuffled once, at which a key of one set falls out, and of
keys that the same sets share one is kept. Equal sets are one node from the start. A key with many sets is not expanded into
pairs: in `STAR_ROUNDS` rounds each key's sets are compared with one of them only, and what is linked becomes one
component; in the last round the sets of a key that are still in different components are compared with each other, in
blocks inside tasks that give out nothing but the pairs left; a key with more than `KEY_SETS` sets is divided into blocks
of sets, and every two of its blocks meet in a task of their own.
Links inside a component do not change it, so components are exact. Before its shingles are compared, a pair must pass
an exact bound: parities of the shingles' hashes in bins (256, more for large sets) differ in no more places than the
sets differ. In the last round the sets of a key meet with `COARSE` times as many bins, and the pairs that are left are
looked at once more with `FINE` times as many.

Definitions: words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased. A set with fewer than k words holds its whole word
sequence; without words it is empty and linked with nothing, as are null texts. Two documents link when
100 * intersection >= threshold * union. Rows of the same doc_id are the same node, even if their texts differ. A row
without doc_id is returned with a null component. Repeated rows are returned each, empty tables give no rows, other
columns are not used. Shingles are compared as 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refsync.llm import textops
from refsync.llm.components import connected_components
from refsync.sources.storage import discard_staged, stage

PARITY_BINS = 256
COARSE, FINE = 2, 16
STAR_ROUNDS = 2
#: Sets of a key that meet in one task in the last round, and pairs that are compared at once.
KEY_SETS, PAIR_BLOCK = 4096, 1 << 15
BROADCAST_IDS = 1_000_000
SLICE_TEXTS = 4096
PAIR_COST = 0.005
#: Scrambles the order of nodes, so that each star round has other centers.
ROUND_MASKS = (0, 0x5DEECE66D1234567, 0x2545F4914F6CDD1D)


class Bands:
    """Bands of set sizes: a partner of a set in band k lies in band k - 1, k or k + 1."""

    def __init__(self, percent: int, largest: int):
        self.percent = percent
        lows = [1]
        while lows[-1] <= largest:
            lows.append(lows[-1] * 100 // percent + 1)
        self.lows = np.array([*lows, lows[-1] * 100 // percent + 1])

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.lows, sizes, side="right") - 1

    def difference(self, band: int) -> int:
        """Most shingles in which a set of this band and a linked set of its size or larger can differ."""
        top = int(self.lows[band + 1]) - 1
        return difference(top + top * 100 // self.percent, self.percent)


def difference(sizes: int, percent: int) -> int:
    """Most shingles in which two linked sets with `sizes` shingles in all can differ."""
    return sizes * (100 - percent) // (100 + percent)


def allocate(most_different: int, size: int, documents: int) -> tuple[int, int]:
    """(segments in all, of which with one-deletion neighbourhoods) of least cost for a band.

    A segment costs a row per document; with deletions, a row more per shingle in it. Two unrelated sets agree in a
    segment mostly when both have nothing there, so with a chance of about exp(-2 * shingles per segment). To compare two
    sets that share a key costs little next to a row of the index: `PAIR_COST` of it.
    """
    best = None
    for deletions in range((most_different + 1) // 2 + 1):
        segments = most_different + 1 - deletions
        mean = size / segments
        rows = documents * (segments + deletions * mean)
        chance = documents * documents * segments * math.exp(-2 * mean)
        cost = rows + PAIR_COST * chance
        if best is None or cost < best[0]:
            best = cost, segments, deletions
    return best[1], best[2]


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), _signed(values))


def _keys(hashes: np.ndarray, offsets: np.ndarray, schemes: np.ndarray, segments: np.ndarray, deletions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index keys of each set under its scheme (-1: none), and the set each key belongs to."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    count = np.where(schemes >= 0, segments[np.maximum(schemes, 0)], 0)
    base = np.concatenate([[0], np.cumsum(count)])
    used = count[owner] > 0
    hashes, owner = hashes[used], owner[used]
    place = ((textops.mix(hashes ^ np.uint64(0x51ED27)) >> np.uint64(32)) * count[owner].astype(np.uint64)) >> np.uint64(32)
    slot = base[owner] + place.astype(np.int64)
    value = textops.mix(hashes ^ np.uint64(0xA0761D6478BD642F))
    total = np.zeros(base[-1], np.uint64)
    np.add.at(total, slot, value)
    slot_owner = np.repeat(np.arange(len(count)), count)
    number = np.arange(base[-1]) - base[slot_owner]
    salt = textops.mix((schemes[slot_owner].astype(np.uint64) << np.uint64(32)) + number.astype(np.uint64) + np.uint64(1))
    keys, owners = [textops.mix(total ^ salt)], [slot_owner]
    near = place.astype(np.int64) < np.where(schemes >= 0, deletions[np.maximum(schemes, 0)], 0)[owner]
    if near.any():
        keys.append(textops.mix((total[slot[near]] - value[near]) ^ salt[slot[near]]))
        owners.append(owner[near])
    return np.concatenate(keys), np.concatenate(owners)


def _sets(texts: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, sorted distinct shingles, offsets) by slices of a text column."""
    data, offsets = textops.text_buffers(texts)
    for first, last in textops.slices(offsets, textops.SMALL_SLICE_BYTES):
        for a in range(first, last, SLICE_TEXTS):
            b = min(last, a + SLICE_TEXTS)
            found = textops.words(data, offsets[a : b + 1])
            yield a, b, *textops.distinct(*textops.shingles(found.hashes, found.offsets, k))


def _signature(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two order-free 64-bit sums of each set."""
    first = textops.sum_by_text(textops.mix(hashes ^ np.uint64(0x1234567)), offsets)
    return first, textops.sum_by_text(textops.mix(hashes ^ np.uint64(0x89ABCDEF01)), offsets)


def _parity(hashes: np.ndarray, offsets: np.ndarray, fine: int = 1) -> pa.Array:
    """Parity bins of each set as 64-bit words: `PARITY_BINS`, or for large sets the power of two from 2/3 of its size on
    (`fine` times as many). For partners of the next lower power the two halves of the bins are added up."""
    sizes = np.diff(offsets)
    bins = np.maximum(PARITY_BINS, fine << np.ceil(np.log2(np.maximum(sizes, 1) / 1.5)).clip(0).astype(int))
    ends = np.concatenate([[0], np.cumsum(bins // 64)])
    flat = np.zeros(ends[-1], np.uint64)
    mixed, owner = textops.mix(hashes), np.repeat(np.arange(len(sizes)), sizes)
    for level in np.unique(bins):
        own = np.flatnonzero(bins == level)
        place = np.full(len(sizes), -1)
        place[own] = np.arange(len(own))
        inside = place[owner] >= 0
        at = place[owner[inside]] * level + (mixed[inside] & np.uint64(level - 1)).astype(np.int64)
        odd = (np.bincount(at, minlength=len(own) * level) & 1).astype(np.uint8)
        table = np.packbits(odd).view(np.uint64).reshape(len(own), level // 64)
        flat[(ends[own][:, None] + np.arange(level // 64)).ravel()] = table.ravel()
    return _lists(flat, ends)


def _describe(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, hashes, offsets in _sets(batch.column(1), k):
                first, second = _signature(hashes, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(offsets)), _signed(first), _signed(second), _parity(hashes, offsets)],
                    ["doc_id", "n_shingles", "s1", "s2", "parity"],
                )

    return run


def _index(k: int, bands: Bands, segments: np.ndarray, deletions: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, hashes, offsets in _sets(batch.column(1), k):
                sizes = np.diff(offsets)
                band = np.where(sizes > 0, bands.of(np.maximum(sizes, 1)), -1)
                own = _keys(hashes, offsets, band, segments, deletions)
                lower = _keys(hashes, offsets, np.where(band > 0, band - 1, -1), segments, deletions)
                keys, owners = np.concatenate([own[0], lower[0]]), np.concatenate([own[1], lower[1]])
                order = np.argsort(owners, kind="stable")
                ends = np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=b - a))])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), _lists(keys[order], ends)], ["node", "keys"])

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, node) whose key stands in another row, too; rows come in order of keys."""
    keys, nodes, again = np.zeros(0, np.int64), np.zeros(0, np.int64), False  # the last row, and if the one before it has its key
    for batch in batches:
        keys, nodes = np.concatenate([keys, batch.column(0).to_numpy()]), np.concatenate([nodes, batch.column(1).to_numpy()])
        if not len(keys):
            continue
        kept, same = np.zeros(len(keys), bool), keys[1:] == keys[:-1]
        kept[0] = again
        kept[1:] |= same
        kept[:-1] |= same
        yield pa.RecordBatch.from_arrays([pa.array(keys[:-1][kept[:-1]]), pa.array(nodes[:-1][kept[:-1]])], ["key", "node"])
        keys, nodes, again = keys[-1:], nodes[-1:], bool(kept[-1])
    if again:
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(nodes)], ["key", "node"])


def _distinct_groups(members: DataFrame) -> DataFrame:
    """The rows (key, node) of one key of all that have the same nodes; keys are told apart by their number of rows and three
    sums of 31 bits of their nodes' hashes."""
    sums = [F.sum(F.shiftrightunsigned(F.xxhash64(F.lit(i), "node"), 33)).alias(f"sum{i}") for i in range(3)]
    groups = members.groupBy("key").agg(F.count("*").alias("rows"), *sums)
    kept = groups.groupBy("rows", "sum0", "sum1", "sum2").agg(F.min("key").alias("key")).select("key")
    return members.join(kept, "key", "left_semi")


def _shingle_sets(k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, hashes, offsets in _sets(batch.column(1), k):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), _lists(hashes, offsets)], ["node", "shingles"])

    return run


def _sketches(k: int, fine: int) -> Callable:
    """Sets with finer parity bins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, hashes, offsets in _sets(batch.column(1), k):
                columns = [batch.column(0).slice(a, b - a), pa.array(np.diff(offsets)), _parity(hashes, offsets, fine)]
                yield pa.RecordBatch.from_arrays(columns, ["node", "n", "parity"])

    return run


def _pairs_of(groups: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of places inside runs of equal values, the earlier place first, in blocks of about PAIR_BLOCK pairs."""
    n = len(groups)
    last = np.searchsorted(groups, groups, side="right")
    after = last - np.arange(n) - 1  # partners of each place
    ends = np.cumsum(after)
    for first in range(0, int(ends[-1]) if n else 0, PAIR_BLOCK):
        number = np.arange(first, min(first + PAIR_BLOCK, int(ends[-1])))
        left = np.searchsorted(ends, number, side="right")
        yield left, left + 1 + number - (ends[left] - after[left])


class _Bins:
    """Parity bins of several sets, rows of equal length together."""

    def __init__(self, lists: pa.ListArray):
        self.words = lists.value_lengths().to_numpy()
        flat = lists.flatten().to_numpy().view(np.uint64)
        starts = np.cumsum(self.words) - self.words
        self.place, self.tables = np.zeros(len(self.words), np.int64), {}
        for words in np.unique(self.words):
            own = np.flatnonzero(self.words == words)
            self.place[own] = np.arange(len(own))
            self.tables[int(words)] = flat[starts[own][:, None] + np.arange(words)]

    def rows(self, at: np.ndarray, words: int) -> np.ndarray:
        return self.tables[words][self.place[at]]

    def folded(self, at: np.ndarray, words: int) -> np.ndarray:
        """Rows of twice as many words, folded to so many."""
        table = self.rows(at, 2 * words)
        return table[:, :words] ^ table[:, words:]


def _close_pairs(table: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs under a common key that pass the bounds and lie in different components and, of a divided key, in the right blocks."""
    table = table.combine_chunks()
    key, node, component, n, own, other = (table[c].to_numpy() for c in ("group", "node", "component", "n", "own", "other"))
    bins = _Bins(table["parity"].chunk(0))
    found: list[np.ndarray] = []
    for a, b in _pairs_of(key):
        kept = (component[a] != component[b]) & (np.maximum(n[a], n[b]) * percent <= np.minimum(n[a], n[b]) * 100)
        kept &= (own[a] != own[b]) | (own[a] == other[a])  # pairs of one block meet where the block meets itself
        a, b = a[kept], b[kept]
        differ = np.zeros(len(a), np.int64)
        least = np.minimum(bins.words[a], bins.words[b])
        sides = [(bins.rows, bins.rows, bins.words[a] == bins.words[b])]
        sides += [(bins.folded, bins.rows, bins.words[a] == 2 * bins.words[b]), (bins.rows, bins.folded, 2 * bins.words[a] == bins.words[b])]
        for of_a, of_b, fits in sides:
            for width in np.unique(least[fits]):
                at = np.flatnonzero(fits & (least == width))
                differ[at] = np.bitwise_count(of_a(a[at], int(width)) ^ of_b(b[at], int(width))).sum(1, dtype=np.int64)
        good = differ * (100 + percent) <= (n[a] + n[b]) * (100 - percent)
        if good.any():
            found.append(np.sort(np.stack([node[a[good]], node[b[good]]], 1), axis=1))
    if found:
        pairs = np.unique(np.concatenate(found), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _compared(percent: int) -> Callable:
    """`_close_pairs` over a partition in order of keys; groups are taken together up to KEY_SETS rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            rows += batch.num_rows
            last = batch.column("group")[-1].as_py()
            if rows >= KEY_SETS and held[0]["group"][0].as_py() != last:
                whole = pa.concat_tables(held)
                cut = int(np.searchsorted(whole["group"].to_numpy(), last, side="left"))
                yield from _close_pairs(whole.slice(0, cut), percent)
                held, rows = [whole.slice(cut)], whole.num_rows - cut
        if held:
            yield from _close_pairs(pa.concat_tables(held), percent)

    return run


def _possible(a: str, b: str, percent: int) -> Column:
    """Exact bound: sets that cannot link are out. Columns n and parity of both sides have these prefixes."""
    sizes = F.col(f"{a}n") + F.col(f"{b}n")
    one, other = F.col(f"{a}parity"), F.col(f"{b}parity")
    few = PARITY_BINS // 64
    small = F.bit_count(one[0].bitwiseXOR(other[0]))
    for i in range(1, few):
        small = small + F.bit_count(one[i].bitwiseXOR(other[i]))
    far = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda t, n: t + n)
    half = lambda x: (F.size(x) / 2).cast("int")
    folded = lambda x: F.zip_with(F.slice(x, 1, half(x)), F.slice(x, half(x) + 1, half(x)), lambda p, q: p.bitwiseXOR(q))
    differ = (
        F.when((F.size(one) == few) & (F.size(other) == few), small)
        .when(F.size(one) == F.size(other), far(one, other))
        .when(F.size(one) == F.size(other) * 2, far(folded(one), other))
        .when(F.size(one) * 2 == F.size(other), far(one, folded(other)))
        .otherwise(F.lit(0))
    )
    near = F.greatest(f"{a}n", f"{b}n") * percent <= F.least(f"{a}n", f"{b}n") * 100
    return near & (differ * (100 + percent) <= sizes * (100 - percent))


def _plan(sets: DataFrame, percent: int) -> tuple[Bands, np.ndarray, np.ndarray]:
    """(bands, segments, deletions by band) from the sizes of all sets."""
    largest = sets.agg(F.max("n_shingles")).first()[0] or 1
    bands = Bands(percent, largest)
    number = F.floor(F.log("n_shingles") / math.log(100 / percent))  # close to the bands; only for the costs
    per_band = {int(row[0]): row[1] for row in sets.filter("n_shingles > 0").groupBy(number.alias("band")).count().collect()}
    plan = []
    for band, (low, high) in enumerate(zip(bands.lows[:-1].tolist(), bands.lows[1:].tolist(), strict=True)):
        numbers = range(int(math.log(low) / math.log(100 / percent)), int(math.log(high) / math.log(100 / percent)) + 2)
        plan.append(allocate(bands.difference(band), low, max(1, sum(per_band.get(i, 0) for i in numbers))))
    return bands, np.array([p[0] for p in plan]), np.array([p[1] for p in plan])


def _small(table: DataFrame, rows: int) -> DataFrame:
    """The table, to be broadcast if it has at most so many rows (of one bigint)."""
    return F.broadcast(table) if table.count() <= rows else table


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of `docs`. Only the result stays in the work folder."""
    with discard_staged(docs.sparkSession):
        return stage(_components(docs, doc_id, text, k, percent), "jaccard", keep=True)


def _components(docs: DataFrame, doc_id: str, text: str, k: int, percent: int) -> DataFrame:
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    sets = stage(docs.mapInArrow(_describe(k), "doc_id bigint, n_shingles bigint, s1 bigint, s2 bigint, parity array<bigint>"), "jaccard-sets")
    same = ["s1", "s2", "n_shingles"]
    nodes = stage(sets.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*same).agg(F.min("doc_id").alias("node")), "jaccard-nodes")
    placed = stage(sets.join(nodes, same, "left").select("doc_id", F.col("n_shingles").alias("n"), "parity", "node"), "jaccard-placed")
    # documents whose text stands for its set are indexed, copies are not
    stands = F.max(F.col("doc_id") == F.col("node"))
    copies = stage(placed.filter("node IS NOT NULL").groupBy("doc_id").agg(stands.alias("stands")).filter("NOT stands").select("doc_id"), "jaccard-copies")
    chosen = docs.filter("doc_id IS NOT NULL").join(_small(copies, BROADCAST_IDS), "doc_id", "left_anti").select("doc_id", "text")
    keys = chosen.mapInArrow(_index(k, *_plan(sets, percent)), "node bigint, keys array<bigint>").select("node", F.explode("keys").alias("key"))
    sorted_keys = keys.select("key", "node").repartition("key").sortWithinPartitions("key")
    shared = stage(sorted_keys.mapInArrow(_repeated, "key bigint, node bigint"), "jaccard-shared")
    members = stage(_distinct_groups(shared), "jaccard-keys")
    info = placed.filter("doc_id = node").select("node", "n", "parity")
    side = lambda c: info.select(*[F.col(x).alias(c if x == "node" else f"{c}_{x}") for x in info.columns])

    def verified(pairs: DataFrame) -> DataFrame:
        named = stage(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "jaccard-ends")
        wanted = docs.join(_small(named, BROADCAST_IDS), "doc_id", "left_semi").select("doc_id", "text")
        shingle_sets = stage(wanted.mapInArrow(_shingle_sets(k), "node bigint, shingles array<bigint>"), "jaccard-shingles")
        whole = lambda c: shingle_sets.select(F.col("node").alias(c), F.col("shingles").alias(f"{c}_set"))
        both = pairs.join(whole("a"), "a").join(whole("b"), "b")
        shared = F.size(F.array_intersect("a_set", "b_set"))
        linked = shared * 100 >= (F.size("a_set") + F.size("b_set") - shared) * percent
        return stage(both.filter(linked).select("a", "b"), "jaccard-links")

    def sketched(named: DataFrame, fine: int) -> DataFrame:
        """(node, n, parity) of the sets of some documents, one row per set."""
        named = stage(named.distinct(), "jaccard-named")
        wanted = docs.join(_small(named, BROADCAST_IDS), "doc_id", "left_semi").select("doc_id", "text")
        found = wanted.mapInArrow(_sketches(k, fine), "node bigint, n bigint, parity array<bigint>")
        return stage(found, "jaccard-fine")

    links, tried = None, None
    labelled = members.withColumn("component", F.col("node"))
    for mask in [*ROUND_MASKS[:STAR_ROUNDS], None]:
        if links is not None:
            found = connected_components(links)
            labelled = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        if mask is not None:
            order = F.col("node").bitwiseXOR(F.lit(mask))
            ends = (F.min("component").alias("low"), F.max("component").alias("high"))
            groups = labelled.groupBy("key").agg(F.min(order).bitwiseXOR(F.lit(mask)).alias("c"), F.min_by("component", order).alias("c_component"), *ends)
            centers = stage(groups.filter("low < high").drop("low", "high"), "jaccard-centers")
            near = labelled.join(centers, "key").filter("component <> c_component")
            near = near.select(F.least("node", "c").alias("a"), F.greatest("node", "c").alias("b")).distinct()
            pairs = near.join(side("a"), "a").join(side("b"), "b").filter(_possible("a_", "b_", percent)).select("a", "b")
        else:
            counts = (F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("sets"))
            groups = labelled.groupBy("key").agg(*counts).filter("low < high")
            groups = stage(groups.select("key", F.ceil(F.col("sets") / KEY_SETS).cast("int").alias("parts")), "jaccard-open")
            rest = stage(labelled.join(groups, "key").select("key", "node", "component", "parts"), "jaccard-rest")
            coarse = sketched(rest.select(F.col("node").alias("doc_id")), COARSE)
            # every block of a divided key meets every block of it, itself included
            rest = rest.withColumn("own", F.pmod(F.xxhash64(F.lit(5), "node"), F.col("parts")).cast("int"))
            rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            meeting = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("group")
            met = rest.select(meeting, "node", "component", "own", "other").join(coarse, "node")
            met = met.repartition("group").sortWithinPartitions("group", "n")
            close = stage(met.mapInArrow(_compared(percent), "a bigint, b bigint").distinct(), "jaccard-close")
            fine = sketched(close.select(F.col("a").alias("doc_id")).union(close.select("b")), FINE)
            side = lambda c: fine.select(*[F.col(x).alias(c if x == "node" else f"{c}_{x}") for x in fine.columns])
            pairs = close.join(side("a"), "a").join(side("b"), "b").filter(_possible("a_", "b_", percent)).select("a", "b")
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stage(pairs, "jaccard-pairs")
        if pairs.isEmpty():
            continue
        tried = pairs if tried is None else tried.union(pairs)
        new = verified(pairs)
        links = new if links is None else links.union(new)
    # copies belong to their set's node, which also unites rows of one id with different texts
    copied = placed.filter("doc_id <> node").select("node", "doc_id")
    found = stage(connected_components(copied if links is None else copied.union(links)), "jaccard-components")
    result = placed.join(found, "node", "left").withColumnRenamed("n", "n_shingles")
    return result.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id")).alias("component_id"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, similarity 0.9, all documents."""
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
SQL = {
    "op2_jaccard_join": f"""
WITH RECURSIVE sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct([array_to_string(w[i:i + 2], ' ') for i in range(1, len(w) - 1)])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM (SELECT doc_id, {_WORDS} AS w FROM documents)),
sized AS (SELECT doc_id, len(s) AS n, hash(list_sort(s)::VARCHAR) AS h, s FROM sets),
nodes AS (SELECT min(doc_id) AS node, n, h, any_value(s) AS s FROM sized WHERE n > 0 GROUP BY n, h),
tokens AS (SELECT node, n, unnest(s) AS t FROM nodes),
pairs AS (
  SELECT a.node AS a, b.node AS b FROM tokens a JOIN tokens b ON a.t = b.t AND a.node < b.node
    AND a.n * 100 >= b.n * 90 AND b.n * 100 >= a.n * 90
  GROUP BY a.node, b.node, a.n, b.n HAVING count(*) * 100 >= (a.n + b.n - count(*)) * 90),
edges AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach AS (SELECT node AS start, node AS last FROM nodes UNION SELECT start, b FROM reach JOIN edges ON last = a),
comp AS (SELECT start AS node, min(last) AS component FROM reach GROUP BY start)
SELECT d.doc_id, d.n AS n_shingles, coalesce(component, d.doc_id) AS component_id
FROM sized d LEFT JOIN nodes x ON d.n = x.n AND d.h = x.h LEFT JOIN comp USING (node)""",
}
QUERIES = {"op2_jaccard_join": op2_jaccard_join}
