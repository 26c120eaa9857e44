"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Vectors get one more component that makes their lengths equal, which turns the largest inner
product into the smallest distance; the graph is built and walked on these. A shard holds vectors of
one magnitude only: beside a far longer one the others would all look alike. A shard's graph is a
row of flat neighbour arrays, one per layer. Construction inserts in growing batches: a batch
searches the graph so far and its own rows, links by the diversity rule, and full neighbour lists
are cut by the same rule. Searches walk many queries in step.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved
from .vectors import best_rows, clean, distinct_vectors, matrix, query_blocks, search_shards, sharded

LINKS = 16
EF_BUILD = 64
EF_SEARCH = 240
SHARD = 8_192
QUERY_BLOCK = 512
#: Best open candidates that are expanded together in a step.
AT_ONCE = 8


def beam(x, neighbours, queries, entry, ef):
    """Best-first search of many queries in step: ids and similarities (queries, ef), best first;
    -1 where fewer are reached. entry: (queries, any) start nodes, -1 for none."""
    b, n = len(queries), len(x)
    seen = np.zeros((b, n + 1), bool)
    seen[:, n] = True
    rows = np.arange(b)[:, None]

    def fresh(nodes):
        nodes = np.sort(nodes, axis=1)
        nodes[:, 1:][nodes[:, 1:] == nodes[:, :-1]] = -1
        nodes[seen[rows, nodes]] = -1
        seen[rows, nodes] = True
        sims = np.einsum("bcd,bd->bc", x[nodes], queries, optimize=True)
        sims[nodes < 0] = -np.inf
        return nodes, sims

    ids = np.full((b, ef), -1, np.int32)
    sims = np.full((b, ef), -np.inf, np.float32)
    done = np.ones((b, ef), bool)
    nodes, near = fresh(entry.astype(np.int32))
    while True:
        ids = np.concatenate([ids, nodes], axis=1)
        sims = np.concatenate([sims, near], axis=1)
        done = np.concatenate([done, nodes < 0], axis=1)
        best = np.argsort(-sims, axis=1, kind="stable")[:, :ef]
        ids, sims, done = (np.take_along_axis(a, best, 1) for a in (ids, sims, done))
        open_first = np.argsort(done, axis=1, kind="stable")[:, :AT_ONCE]
        is_open = ~np.take_along_axis(done, open_first, 1)
        if not is_open.any():
            return ids, sims
        chosen = np.where(is_open, np.take_along_axis(ids, open_first, 1), -1)
        np.put_along_axis(done, open_first, True, 1)
        around = neighbours[chosen]
        around[chosen < 0] = -1
        nodes, near = fresh(around.reshape(b, -1))


def diverse(x, targets, candidates, most):
    """The neighbours each target keeps: from its candidates (-1: none), nearest first, those
    nearer to the target than to any one kept, then the nearest of the rest."""
    sims = np.einsum("bcd,bd->bc", x[candidates], x[targets], optimize=True)
    sims[(candidates < 0) | (candidates == targets[:, None])] = -np.inf
    order = np.argsort(-sims, axis=1, kind="stable")
    candidates, sims = np.take_along_axis(candidates, order, 1), np.take_along_axis(sims, order, 1)
    same = np.zeros(candidates.shape, bool)
    by_id = np.sort(candidates, axis=1)
    if (by_id[:, 1:] == by_id[:, :-1]).any():
        for c in range(1, candidates.shape[1]):
            same[:, c] = (candidates[:, :c] == candidates[:, c : c + 1]).any(axis=1)
    fine = np.isfinite(sims) & ~same
    among = np.matmul(x[candidates], x[candidates].transpose(0, 2, 1))
    kept = np.zeros(candidates.shape, bool)
    for c in range(candidates.shape[1]):
        close = (kept[:, :c] & (among[:, c, :c] > sims[:, c : c + 1])).any(axis=1)
        kept[:, c] = fine[:, c] & ~close & (kept[:, :c].sum(axis=1) < most)
    rank = np.argsort(np.where(kept, 0, np.where(fine, 1, 2)), axis=1, kind="stable")[:, :most]
    out = np.where(np.take_along_axis(fine, rank, 1), np.take_along_axis(candidates, rank, 1), -1)
    if out.shape[1] < most:
        out = np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)
    return out.astype(np.int32)


class Graph:
    """Layers over unit vectors: neighbours[l] is (nodes, most) with -1 for empty places."""

    def __init__(self, x: np.ndarray, levels: np.ndarray, neighbours: list[np.ndarray]):
        self.x, self.levels, self.neighbours = x, levels, neighbours

    @staticmethod
    def padded(x: np.ndarray) -> np.ndarray:
        """A zero row at the end, which index -1 meets."""
        return np.vstack([x, np.zeros((1, x.shape[1]), np.float32)])

    @classmethod
    def build(cls, x: np.ndarray, seed: int = 0) -> Graph:
        n = len(x)
        drawn = np.random.default_rng(seed).random(n)
        levels = np.floor(-np.log(1.0 - drawn) / math.log(LINKS)).astype(np.int32)
        order = np.argsort(-levels, kind="stable")  # the top layer first: it holds every entry
        caps = [2 * LINKS] + [LINKS] * int(levels.max())
        graph = cls(cls.padded(x), levels, [np.full((n + 1, c), -1, np.int32) for c in caps])
        at, size = 1, 32
        while at < n:
            graph._insert(order[at : at + size], order[0])
            at += size
            size = min(1024, max(size, at // 2))
        return graph

    def _insert(self, batch: np.ndarray, top: int) -> None:
        entry = np.full((len(batch), 1), top, np.int32)
        for layer in range(len(self.neighbours) - 1, -1, -1):
            here = self.levels[batch] >= layer
            if not here.any():
                entry, _ = beam(self.x, self.neighbours[layer], self.x[batch], entry, 1)
                continue
            found, _ = beam(self.x, self.neighbours[layer], self.x[batch], entry, EF_BUILD)
            entry = found[:, :8]
            rows = batch[here]
            own = self.x[rows] @ self.x[rows].T
            np.fill_diagonal(own, -np.inf)
            near = np.argsort(-own, axis=1, kind="stable")[:, : min(LINKS, len(rows) - 1)]
            self._link(layer, rows, np.hstack([found[here], rows[near].astype(np.int32)]))

    def _link(self, layer: int, rows: np.ndarray, candidates: np.ndarray) -> None:
        lists = self.neighbours[layer]
        chosen = diverse(self.x, rows, candidates, LINKS)
        lists[rows, :LINKS] = chosen
        source, target = np.repeat(rows, LINKS), chosen.ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, first, many = np.unique(target, return_index=True, return_counts=True)
        added = np.full((len(nodes), many.max(initial=0)), -1, np.int32)
        slot = np.arange(len(target)) - np.repeat(first, many)
        added[np.repeat(np.arange(len(nodes)), many), slot] = source
        for at in range(0, len(nodes), 256):
            part = nodes[at : at + 256]
            extra = added[at : at + 256, : many[at : at + 256].max()]
            lists[part] = diverse(self.x, part, np.hstack([lists[part], extra]), lists.shape[1])

    def search(self, queries: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
        top = int(np.argmax(self.levels))
        entry = np.full((len(queries), 1), top, np.int32)
        for layer in range(len(self.neighbours) - 1, 0, -1):
            entry, _ = beam(self.x, self.neighbours[layer], queries, entry, 8)
        return beam(self.x, self.neighbours[0], queries, entry, ef)


def equal_length(v: np.ndarray) -> np.ndarray:
    """Unit vectors, by one more component, whose order of inner products with a query (which has
    0 there) is that of v."""
    v = v / np.abs(v).max()  # squares of very large or small ones leave the doubles' range
    norms = np.linalg.norm(v, axis=1)
    longest = norms.max()
    rest = np.sqrt(np.maximum(longest**2 - norms**2, 0.0))
    return (np.hstack([v, rest[:, None]]) / longest).astype(np.float32)


def build_index(vectors: DataFrame) -> DataFrame:
    """One row per shard and length of vector: dim, shard, ids, vectors, levels, neighbours (the
    layers' flat arrays, one after the other). vectors: v, ids, dim, shard."""

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(first=[i[0] for i in group["ids"]]).sort_values("first")
        v = matrix(group["v"])
        graph = Graph.build(equal_length(v))
        return pd.DataFrame(
            {
                "dim": [v.shape[1]],
                "shard": [int(group["shard"].iloc[0])],
                "ids": [[list(i) for i in group["ids"]]],
                "data": [v.tobytes()],
                "levels": [graph.levels.tobytes()],
                "neighbours": [b"".join(a.tobytes() for a in graph.neighbours)],
            }
        )

    return vectors.groupBy("dim", "shard").applyInPandas(
        build,
        "dim int, shard int, ids array<array<long>>, data binary, levels binary, neighbours binary",
    )


def load_graph(data: np.ndarray, levels: bytes, neighbours: bytes) -> Graph:
    levels = np.frombuffer(levels, np.int32)
    flat, lists, at = np.frombuffer(neighbours, np.int32), [], 0
    for layer in range(int(levels.max()) + 1):
        cap = LINKS if layer else 2 * LINKS
        size = (len(levels) + 1) * cap
        lists.append(flat[at : at + size].reshape(-1, cap))
        at += size
    return Graph(Graph.padded(equal_length(data)), levels, lists)


def nearest_neighbours(
    df: DataFrame,
    queries: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    ef: int = EF_SEARCH,
    shard_size: int = SHARD,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (inner product of the original vectors in double
    precision): the k nearest rows found for each query row, its own left out, ties to smaller
    ids. queries: condition on id (long).

    Every row is indexed; recall is tested against brute force. Vectors null, empty, zero or with
    null or non-finite components, and rows without id, take no part; repeated ids count once;
    only vectors of the query's length are its candidates. Fewer candidates than k: all of them.
    No rows or no queries: no rows. Other columns are not read.
    """
    rows = saved(clean(df, id_col, vec_col, nonzero=True))
    vectors, shards = sharded(saved(distinct_vectors(rows, k + 1)), shard_size, by_length=True)
    index = saved(build_index(vectors))
    blocks = saved(query_blocks(rows, queries, QUERY_BLOCK))

    def search(row) -> pd.DataFrame:
        own = np.frombuffer(row.ids, np.int64)
        asked = np.frombuffer(row.vectors, np.float64).reshape(len(own), row.dim)
        data = np.frombuffer(row.data, np.float64).reshape(-1, row.dim)
        graph = load_graph(data, row.levels, row.neighbours)
        unit = asked / np.abs(asked).max(axis=1, keepdims=True)
        length = np.linalg.norm(unit, axis=1, keepdims=True)
        sent = np.hstack([unit / length, np.zeros_like(length)]).astype(np.float32)
        found, _ = graph.search(sent, max(ef, 2 * k))
        out = []
        for q, entries in zip(range(len(own)), found):
            entries = entries[entries >= 0]
            scores = dict(zip(entries.tolist(), (data[entries] * asked[q]).sum(axis=1).tolist()))
            order = sorted(entries.tolist(), key=lambda e: -scores[e])
            out += [(int(own[q]), i, s) for i, s in best_rows(row.entries, own[q], order, scores, k)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    index = index.withColumnRenamed("ids", "entries")
    return search_shards(index, blocks, shards, search, "double", k)
