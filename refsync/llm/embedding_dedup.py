"""Near-duplicate vectors: a navigable small-world graph per shard, every shard queried by every vector.

Equal vectors are one node. Nodes are dealt to shards by hash: at least `LEAST_SHARDS`, and so many that no shard holds
more than about `SHARD_ROWS` vectors, which bounds a task's memory. The table of all nodes is sent once per shard, sorted
so that a shard's task first gets its members, then the audit queries (ids divisible by 100), then all others, as a
stream: a task holds one graph and one batch of queries. The audit compares the graph's answers with brute force; while
its recall is below `RECALL`, the beam is widened, before any other query is asked. Candidates are verified by cosine in
double precision.

A task returns, for each query, the number of vectors it links with in the shard and the local components that these
belong to, never the pairs; so a group of copies of any size costs a row per member and shard. Components are then
united over all shards.

Nulls: vectors that are null, empty, zero, of another length than most or hold null or non-finite components link with
nothing; null ids are kept and link with nothing (component null). Repeated rows are vectors of their own: each
counts the others; rows of one id with different vectors are one node. An empty table gives no rows. Other columns are
not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refsync.llm.components import connected_components, roots
from refsync.llm.hnsw import Graph
from refsync.sources.storage import stage

THRESHOLD = 0.9
SHARD_ROWS = 100_000
LEAST_SHARDS = 12
BEAM = 24
WIDEST_BEAM = 1024
RECALL = 0.99
AUDIT_EVERY = 100
SLACK = 1e-4  # the graph works in single precision
_MEMBER, _AUDIT, _QUERY = 0, 1, 2


class Shard:
    """A shard's members, their graph and their local components; counts what queries link with."""

    def __init__(self, nodes: np.ndarray, copies: np.ndarray, vectors: np.ndarray, threshold: float, beam: int = BEAM):
        self.nodes, self.copies, self.threshold, self.beam = nodes, copies, threshold, beam
        self.exact = unit(vectors)
        self.graph = Graph(self.exact)
        self.checked = self.hit = 0
        self.labels: np.ndarray | None = None

    def _verified(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        q, n = self.graph.within(queries, self.threshold - SLACK, beam)
        kept = np.zeros(len(q), bool)
        for a in range(0, len(q), 1 << 16):
            kept[a : a + (1 << 16)] = np.einsum("ij,ij->i", queries[q[a : a + (1 << 16)]], self.exact[n[a : a + (1 << 16)]]) >= self.threshold
        return q[kept], n[kept]

    def audit(self, queries: np.ndarray) -> None:
        """Widen the beam until it finds enough of what brute force finds, over all audit queries so far."""
        for a in range(0, len(queries), 256):
            some = queries[a : a + 256]
            true = int(((some @ self.exact.T) >= self.threshold).sum())
            while True:
                hit = len(self._verified(some, self.beam)[0])
                if self.hit + hit >= RECALL * (self.checked + true) or self.beam >= WIDEST_BEAM:
                    break
                self.beam *= 2
            self.checked, self.hit = self.checked + true, self.hit + hit

    def label(self) -> None:
        """Smallest node of each member's component inside the shard."""
        if self.labels is None:
            self.labels = self.nodes.copy()
            found = [self._verified(self.exact[a : a + 4096], self.beam) for a in range(0, len(self.exact), 4096)]
            q = np.concatenate([f[0] + 4096 * i for i, f in enumerate(found)]) if found else np.zeros(0, np.int64)
            n = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)
            apart = q != n
            if apart.any():
                node, root = roots(self.nodes[q[apart]], self.nodes[n[apart]])
                order = np.argsort(self.nodes, kind="stable")
                self.labels[order[np.searchsorted(self.nodes[order], node)]] = root

    def answer(self, nodes: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(node, linked vectors in the shard, a local component) rows; the count is on a query's first row only."""
        self.label()
        q, n = self._verified(unit(vectors), self.beam)
        other = self.nodes[n] != nodes[q]
        count = np.bincount(q[other], self.copies[n[other]], len(nodes)).astype(np.int64)
        # a member's label is also needed for itself: it ties it to its local component
        pair = np.unique(np.stack([q, self.labels[n]]), axis=1) if len(q) else np.zeros((2, 0), np.int64)
        first = np.concatenate([[True], pair[0, 1:] != pair[0, :-1]]) if pair.shape[1] else np.zeros(0, bool)
        return nodes[pair[0]], np.where(first, count[pair[0]], 0), pair[1]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision, whatever their scale."""
    vectors = np.asarray(vectors, np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True) if len(vectors) else vectors
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _search(width: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: Shard | None = None
        number = -1
        members: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def opened() -> Shard:
            nonlocal shard
            if shard is None:
                shard = Shard(*(np.concatenate(side) for side in zip(*members, strict=True)), threshold)
                members.clear()
            return shard

        for batch in batches:
            of, role, node, copies = (batch.column(i).to_numpy() for i in range(4))
            vectors = _matrix(batch.column(4), width)
            # runs of one shard and role
            edges = np.flatnonzero((of[1:] != of[:-1]) | (role[1:] != role[:-1])) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(of)], strict=True):
                if of[a] != number:
                    shard, number = None, of[a]
                    members.clear()
                if role[a] == _MEMBER:
                    members.append((node[a:b], copies[a:b], vectors[a:b]))
                    continue
                if shard is None and not members:
                    continue  # a shard without members
                if role[a] == _AUDIT:
                    opened().audit(unit(vectors[a:b]))
                for c in range(a, b, 4096):
                    rows = opened().answer(node[c : min(b, c + 4096)], vectors[c : min(b, c + 4096)])
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows], ["node", "n_links", "label"])

    return run


def near_duplicates(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    rows = table.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    clean = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    usable = F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & clean
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    width = rows.filter("usable").groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").first()
    if width is None:
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    keyed = rows.withColumns({"usable": F.col("usable") & (F.size("v") == width["w"]), "h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(1), "v")})
    ids = keyed.filter("usable").groupBy("h1", "h2").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    ids = stage(ids, "vectors-ids")
    chosen = keyed.filter("usable").join(ids.withColumnRenamed("node", "vec_id"), ["h1", "h2", "vec_id"])
    # a repeated row would give its node twice
    nodes = stage(chosen.groupBy("h1", "h2").agg(F.first("vec_id").alias("node"), F.first("copies").alias("copies"), F.first("v").alias("v")), "vectors-nodes")
    shards = max(LEAST_SHARDS, -(-nodes.count() // shard_rows))
    # nodes whose id is that of another node (repeated ids with different vectors) are told apart by their hash
    own = F.pmod(F.xxhash64(F.lit(3), "node", "h1"), F.lit(shards)).cast("int")
    member = nodes.select(own.alias("shard"), F.lit(_MEMBER).alias("role"), "node", "copies", "v")
    role = F.when(F.col("node") % AUDIT_EVERY == 0, _AUDIT).otherwise(_QUERY)
    asked = nodes.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), role.alias("role"), "node", "copies", "v")
    dealt = member.union(asked).repartitionByRange(shards, "shard").sortWithinPartitions("shard", "role")
    found = stage(dealt.mapInArrow(_search(width["w"], threshold), "node bigint, n_links bigint, label bigint"), "vectors-links")

    links = found.groupBy("node").agg(F.sum("n_links").alias("linked"))
    components = stage(connected_components(found.select("node", "label").distinct()), "vectors-components")
    by_node = ids.join(links, "node", "left").join(components, "node", "left")
    result = stage(by_node.select("h1", "h2", "copies", F.coalesce("linked", F.lit(0)).alias("linked"), F.coalesce("component", "node").alias("component")), "vectors-result")
    usable = keyed.filter("usable").select("vec_id", "h1", "h2").join(result, ["h1", "h2"])
    linked = usable.select("vec_id", (F.col("linked") + F.col("copies") - 1).alias("n_links"), F.col("component").alias("component_id"))
    alone = keyed.filter("NOT usable").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors, whatever their labels."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = {
    "op4_embedding_dedup": """
WITH RECURSIVE valid AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
edges AS (SELECT a.vec_id AS a, b.vec_id AS b FROM valid a JOIN valid b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (SELECT vec_id AS start, vec_id AS last FROM embeddings UNION SELECT start, b FROM reach JOIN edges ON last = a),
comp AS (SELECT start, min(last) AS component_id FROM reach GROUP BY start),
degree AS (SELECT a, count(*) AS n FROM edges GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN comp ON vec_id = start LEFT JOIN degree ON vec_id = a""",
}
QUERIES = {"op4_embedding_dedup": op4_embedding_dedup}
