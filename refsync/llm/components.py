"""Connected components of a table of links, without collecting links or components anywhere.

Tasks first replace the links of bounded chunks by forests of stars (the union of what a chunk shows), which keeps
connectivity and leaves fewer links than nodes. If there was more than one chunk, rounds of contraction follow as joins:
every node moves to the neighbour that comes first in an order that changes by round, links are renamed to where their
ends went, and are reduced in chunks again. The number of nodes left falls by a constant share per round, whatever the
shape (long chains, stars). Every round's table is written to the shared work folder, which cuts the lineage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refsync.sources.storage import stage

CHUNK_LINKS = 1 << 18
_MASKS = [int(x) for x in np.random.default_rng(31).integers(0, 1 << 62, 64)]  # node ^ mask: another order per round


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for the nodes of links a - b."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = places[: len(a)], places[len(a) :]
    parent = np.arange(len(nodes))
    while True:
        low, high = np.minimum(parent[x], parent[y]), np.maximum(parent[x], parent[y])
        apart = low != high
        if not apart.any():
            return nodes, nodes[parent]
        x, y = x[apart], y[apart]
        np.minimum.at(parent, high[apart], low[apart])
        while (parent[parent] != parent).any():
            parent = parent[parent]


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def reduced() -> pa.RecordBatch:
        node, root = roots(*(np.concatenate(side) for side in zip(*held, strict=True)))
        kept = node != root
        return pa.RecordBatch.from_arrays([pa.array(root[kept]), pa.array(node[kept])], ["a", "b"])

    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        size += batch.num_rows
        if size >= CHUNK_LINKS:
            yield reduced()
            held, size = [], 0
    if size:
        yield reduced()


def stars(links: DataFrame, chunks: int | None = None) -> DataFrame:
    """Fewer links (a, b), a < b, with the same components; `links` has two bigint columns."""
    a, b = links.columns[:2]
    own = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    return (own.coalesce(chunks) if chunks else own).mapInArrow(_stars, "a bigint, b bigint")


def _reduced(links: DataFrame) -> tuple[DataFrame, bool]:
    """(stars of written links, whether they are whole components)."""
    chunks = -(-links.count() // CHUNK_LINKS)
    return (stage(stars(links, chunks), "links"), chunks == 1) if chunks else (links, True)


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link; component is the smallest node it reaches.

    `links` has two bigint columns; rows with a null end or with equal ends say nothing. No links give no rows.
    """
    links = links.toDF("a", "b").dropna()
    left, whole = _reduced(stage(stars(links), "links"))
    if whole:
        return left.select(F.col("b").alias("node"), F.col("a").alias("component")).union(left.select("a", "a").distinct())
    nodes = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    moves: list[DataFrame] = []
    while not left.isEmpty():
        mask = F.lit(_MASKS[len(moves) % len(_MASKS)])
        ordered = lambda c: F.col(c).bitwiseXOR(mask)  # noqa: B023, E731
        both = left.union(left.select("b", "a")).toDF("node", "to")
        first = both.groupBy("node").agg(F.min(ordered("to")).alias("first"))
        move = stage(first.select("node", F.least("first", ordered("node")).bitwiseXOR(mask).alias("to")), "moves")
        moves.append(move)
        renamed = left.join(move.select(F.col("node").alias("a"), F.col("to").alias("x")), "a").join(
            move.select(F.col("node").alias("b"), F.col("to").alias("y")), "b"
        )
        left, _ = _reduced(stage(stars(renamed.select("x", "y").filter("x <> y")), "links"))
    at = nodes.select("node", F.col("node").alias("root"))
    for move in moves:
        at = at.join(move.select(F.col("node").alias("root"), "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    at = stage(at, "roots")
    smallest = stage(at.groupBy("root").agg(F.min("node").alias("component")), "components")
    return at.join(smallest, "root").select("node", "component")
