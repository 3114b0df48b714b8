"""Hierarchical navigable small-world graph over the vectors of one shard, in numpy, searched by batches of queries.

Rows are unit vectors; similarity is the inner product. All work is done for many queries at once: a beam search moves
every query of a batch by one step, so the cost per query is that of array operations, not of Python.
"""

from __future__ import annotations

import numpy as np

LINKS = 12  # per node and upper level; twice as many at the ground level
BUILD_BEAM = 48
INSERT_BATCH = 512
CELLS = 1 << 22  # of the visited table: queries per batch times nodes


class Graph:
    def __init__(self, vectors: np.ndarray, seed: int = 17):
        self.x = np.ascontiguousarray(vectors, np.float32)
        n = len(self.x)
        rng = np.random.default_rng(seed)
        self.level = np.minimum((-np.log(rng.random(n) + 1e-12) / np.log(LINKS)).astype(int), 6) if n else np.zeros(0, int)
        order = np.argsort(-self.level, kind="stable")  # the nodes of upper levels come first and route the others
        self.levels = [np.full((n, 2 * LINKS if k == 0 else LINKS), -1, np.int32) for k in range(self.level.max() + 1 if n else 1)]
        self.entry = int(order[0]) if n else -1
        self._into: tuple[np.ndarray, np.ndarray] | None = None
        done = min(n, 64)
        for k in range(len(self.levels)):
            own = order[:done][self.level[order[:done]] >= k]
            self._connect(k, own, own)
        while done < n:
            some = order[done : done + min(INSERT_BATCH, done)]
            self._insert(some)
            done += len(some)

    def _insert(self, some: np.ndarray) -> None:
        """Link new nodes at all their levels, to older nodes and to each other."""
        queries = self.x[some]
        at = self._descend(queries, 0)
        for k in range(min(self.level[some].max(), len(self.levels) - 1), -1, -1):
            own = np.flatnonzero(self.level[some] >= k)
            starts = at[own] if k == 0 else self._descend(queries[own], k)
            found, _ = self._beam(k, queries[own], starts, BUILD_BEAM, None)
            near = queries[own] @ queries[own].T
            np.fill_diagonal(near, -2)
            best = np.argsort(-near, axis=1)[:, : 2 * LINKS]
            pool = np.concatenate([found, np.where(np.take_along_axis(near, best, 1) > -2, some[own][best], -1)], axis=1)
            self._link(k, some[own], pool)

    def _connect(self, k: int, own: np.ndarray, among: np.ndarray) -> None:
        if len(own) < 2:
            return
        near = self.x[own] @ self.x[among].T
        near[own[:, None] == among[None, :]] = -2
        best = np.argsort(-near, axis=1)[:, : min(len(among) - 1, 4 * LINKS)]
        self._link(k, own, among[best].astype(np.int64))

    def _select(self, nodes: np.ndarray, pool: np.ndarray, most: int) -> np.ndarray:
        """Of each node's candidates (-1: none), the nearest that are nearer to it than to those taken before.

        Places left over are filled with the nearest of the rest, so that close groups stay linked among themselves.
        """
        pool = np.where(pool == nodes[:, None], -1, pool)
        ordered = np.sort(pool, axis=1)
        again = np.concatenate([np.zeros((len(pool), 1), bool), ordered[:, 1:] == ordered[:, :-1]], axis=1)
        pool = np.where(again, -1, ordered)
        near = np.einsum("bd,bkd->bk", self.x[nodes], self.x[pool])
        near[pool < 0] = -3
        order = np.argsort(-near, axis=1, kind="stable")[:, : max(most, BUILD_BEAM)]
        pool, near = np.take_along_axis(pool, order, 1), np.take_along_axis(near, order, 1)
        vectors = self.x[pool]
        among = np.einsum("bkd,bjd->bkj", vectors, vectors)
        taken = np.zeros(pool.shape, bool)
        for r in range(pool.shape[1]):
            closest = np.where(taken, among[:, r, :], -3).max(axis=1)
            taken[:, r] = (pool[:, r] >= 0) & (near[:, r] > closest) & (taken.sum(axis=1) < most)
        rank = np.argsort(np.where(taken, 0, np.where(pool >= 0, 1, 2)), axis=1, kind="stable")[:, :most]
        out = np.take_along_axis(pool, rank, 1)
        if out.shape[1] < most:
            out = np.concatenate([out, np.full((len(out), most - out.shape[1]), -1, out.dtype)], axis=1)
        return out.astype(np.int32)

    def _link(self, k: int, nodes: np.ndarray, pool: np.ndarray) -> None:
        table = self.levels[k]
        most = table.shape[1]
        table[nodes] = self._select(nodes, pool, most)
        source = np.repeat(nodes, most)
        target = table[nodes].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        ends, first, counts = np.unique(target, return_index=True, return_counts=True)
        widest = 4 * most  # a node that very many chose at once keeps the first of them
        for a in range(0, len(ends), INSERT_BATCH):
            own, begin, count = ends[a : a + INSERT_BATCH], first[a : a + INSERT_BATCH], np.minimum(counts[a : a + INSERT_BATCH], widest)
            place = np.arange(count.max())
            new = np.where(place < count[:, None], source[np.minimum(begin[:, None] + place, len(source) - 1)], -1)
            table[own] = self._select(own, np.concatenate([table[own], new], axis=1), most)

    def _descend(self, queries: np.ndarray, to: int) -> np.ndarray:
        """Greedy walk through the levels above `to`; the node reached for each query."""
        at = np.full(len(queries), self.entry)
        best = queries @ self.x[self.entry]
        for k in range(len(self.levels) - 1, to, -1):
            moving = np.arange(len(queries))
            while len(moving):
                near = self.levels[k][at[moving]]
                reach = np.einsum("bd,bkd->bk", queries[moving], self.x[near])
                reach[near < 0] = -3
                to_place = reach.argmax(axis=1)
                value = reach[np.arange(len(moving)), to_place]
                better = value > best[moving]
                moving_on = moving[better]
                at[moving_on] = near[better, to_place[better]]
                best[moving_on] = value[better]
                moving = moving_on
        return at

    def _beam(self, k: int, queries: np.ndarray, starts: np.ndarray, beam: int, threshold: float | None) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray] | None]:
        """(nodes of each query's beam, or with a threshold all pairs (query, node) at or above it that are reached)."""
        found = np.full((len(queries), beam), -1, np.int64)
        pairs: list[tuple[np.ndarray, np.ndarray]] = []
        size = int(np.clip(CELLS // max(1, len(self.x)), 16, INSERT_BATCH))
        for a in range(0, len(queries), size):
            ids, hits = self._beam_of(k, queries[a : a + size], starts[a : a + size], beam, threshold)
            found[a : a + size] = ids
            if hits is not None:
                pairs.append((hits[0] + a, hits[1]))
        if threshold is None:
            return found, None
        return found, tuple(np.concatenate(side) for side in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int64),) * 2

    def _beam_of(self, k, queries, starts, beam, threshold):
        table, x = self.levels[k], self.x
        n_queries = len(queries)
        every = np.arange(n_queries)
        seen = np.zeros((n_queries, len(x)), np.int32)  # 0: not yet; else the place that claimed it
        ids = np.full((n_queries, beam), -1, np.int64)
        near = np.full((n_queries, beam), -3, np.float32)
        open_ = np.zeros((n_queries, beam), bool)
        ids[:, 0], near[:, 0], open_[:, 0] = starts, np.einsum("bd,bd->b", queries, x[starts]), True
        seen[every, starts] = 1
        hit_query, hit_node = [], []
        if threshold is not None:
            hit_query, hit_node = [every[near[:, 0] >= threshold]], [starts[near[:, 0] >= threshold]]
        active = every
        step = 1
        while len(active):
            key = np.where(open_[active], near[active], -4)
            best = np.argpartition(-key, 1, axis=1)[:, :2] if beam > 2 else key.argmax(axis=1)[:, None]
            usable = np.take_along_axis(key, best, 1) > -3
            going = usable.any(axis=1)
            active, best, usable = active[going], best[going], usable[going]
            if not len(active):
                break
            chosen = np.where(usable, ids[active[:, None], best], -1)
            open_[active[:, None], best] = False
            new = np.where(chosen[:, :, None] >= 0, table[chosen], -1).reshape(len(active), -1)
            new = np.where((new >= 0) & (seen[active[:, None], new] == 0), new, -1)
            place = np.arange(new.shape[1]) + step
            step += new.shape[1]
            row = np.broadcast_to(active[:, None], new.shape)
            some = new >= 0
            seen[row[some], new[some]] = np.broadcast_to(place, new.shape)[some]
            some &= seen[row, new] == place  # the same node by two ways counts once
            value = np.einsum("bd,bkd->bk", queries[active], x[new])
            value[~some] = -3
            if threshold is not None:
                hit = value >= threshold
                hit_query.append(row[hit])
                hit_node.append(new[hit])
            all_near = np.concatenate([near[active], value], axis=1)
            top = np.argpartition(-all_near, beam - 1, axis=1)[:, :beam]
            near[active] = np.take_along_axis(all_near, top, 1)
            ids[active] = np.take_along_axis(np.concatenate([ids[active], np.where(some, new, -1)], axis=1), top, 1)
            open_[active] = np.take_along_axis(np.concatenate([open_[active], some], axis=1), top, 1)
        if threshold is None:
            return ids, None
        query, node = np.concatenate(hit_query), np.concatenate(hit_node)
        # from every hit on, all hits around it, along links and against them: groups larger than the beam come whole
        edge_query, edge_node = query, node
        queries_of, nodes_of = [query], [node]
        while len(edge_query):
            next_query, next_node = [], []
            for a in range(0, len(edge_query), 1 << 13):
                row, new = self._around(edge_query[a : a + (1 << 13)], edge_node[a : a + (1 << 13)])
                some = seen[row, new] == 0
                pair = np.unique(row[some] * len(x) + new[some])
                row, new = pair // len(x), pair % len(x)
                seen[row, new] = 1
                hit = np.einsum("bd,bd->b", queries[row], x[new]) >= threshold
                next_query.append(row[hit])
                next_node.append(new[hit])
            edge_query, edge_node = np.concatenate(next_query), np.concatenate(next_node)
            queries_of.append(edge_query)
            nodes_of.append(edge_node)
        return ids, (np.concatenate(queries_of), np.concatenate(nodes_of))

    def _around(self, query: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, neighbour) of all links from and to the nodes at the ground level."""
        if self._into is None:
            table = self.levels[0]
            source, target = np.repeat(np.arange(len(table)), table.shape[1]), table.ravel()
            source, target = source[target >= 0], target[target >= 0]
            order = np.argsort(target, kind="stable")
            self._into = source[order], np.searchsorted(target[order], np.arange(len(table) + 1))
        out = self.levels[0][node]
        some = out >= 0
        source, offsets = self._into
        counts = offsets[node + 1] - offsets[node]
        places = np.repeat(offsets[node] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        rows = np.broadcast_to(query[:, None], out.shape)[some]
        return np.concatenate([rows, np.repeat(query, counts)]).astype(np.int64), np.concatenate([out[some], source[places]]).astype(np.int64)

    def within(self, queries: np.ndarray, threshold: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) of the pairs at or above the threshold that the search reaches."""
        if not len(self.x) or not len(queries):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        queries = np.ascontiguousarray(queries, np.float32)
        return self._beam(0, queries, self._descend(queries, 0), min(beam, len(self.x)) if len(self.x) > 1 else 1, threshold)[1]
