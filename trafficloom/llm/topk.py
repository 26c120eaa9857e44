"""Exact top-k search by aggregation without random access.

A shard keeps one sorted list per component. A query reads its lists from the end that adds most,
all in step first, then those that leave the widest gap to their end; every entry has a lower bound
(what it has shown, and the least the rest can add) and an upper bound (what it has shown, and what
its unread lists show now). Reading stops when no outsider's upper bound reaches the k-th lower
bound, or the k-th score of the shards that the task has seen; the few entries left are then scored
in full, in exact integers. Ties at the end stay inside, so equal scores go to the smaller id. The
bounds of a block of queries are matrix products. They are doubles; where their sums are not exact
they are widened by the rounding error.
"""

from __future__ import annotations

import math
import operator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved
from .vectors import best_rows, clean, distinct_vectors, matrix, query_blocks, search_shards, sharded

SCALE = 1024
SHARD = 8_192
QUERY_BLOCK = 128
FIRST_STRETCH = 128
#: Ends of a long.
LEAST, LARGEST = -(2**63), 2**63 - 1


def rounded(v: np.ndarray) -> np.ndarray:
    """floor(SCALE * component) / SCALE, which a double holds exactly for every finite component."""
    small = np.abs(v) < 2.0**53  # larger ones have no fraction
    return np.where(small, np.floor(SCALE * np.where(small, v, 0.0)) / SCALE, v) + 0.0


def units(v: np.ndarray) -> tuple[np.ndarray, int]:
    """v by a power of two that leaves nothing above 1, and the exponent."""
    exponent = int(np.frexp(np.abs(v).max(initial=0.0))[1])
    return np.ldexp(v, -exponent), exponent


def products(values: np.ndarray, query: np.ndarray) -> list[int]:
    """Exact inner products of rounded vectors, in units of 1 / SCALE^2."""

    def whole(v):  # the fraction first: SCALE times a large double may be infinite
        return [int(x) * SCALE + int((x - math.trunc(x)) * SCALE) for x in v.tolist()]

    asked = whole(query)
    return [sum(map(operator.mul, whole(v), asked)) for v in values]


def beyond(score: int) -> bytes:
    """Orders scores that the same end of a long stands for, larger ones last."""
    if LEAST <= score <= LARGEST:
        return b"" if score >= 0 else b"\xff" * 4
    size = (score.bit_length() + 7) // 8
    key = size.to_bytes(4, "big") + abs(score).to_bytes(size, "big")
    return key if score > 0 else bytes(255 - x for x in key)


def stretch(columns: np.ndarray, lists: np.ndarray, depth: int) -> list[np.ndarray]:
    """Bounds of every component of every entry once `depth` places of its list are read: upper and
    lower ones for lists read from their largest value, then upper and lower ones for lists read
    from their smallest. What is read bounds itself; the rest lies between the last value read and
    the other end of the list."""
    n = columns.shape[1]
    out = []
    for read, last, end in (
        (lists[:, n - depth :], lists[:, n - depth], lists[:, 0]),
        (lists[:, :depth], lists[:, depth - 1], lists[:, -1]),
    ):
        known = np.zeros(columns.shape, bool)
        np.put_along_axis(known, read, True, axis=1)
        for bound in (last, end):
            out.append(np.where(known, columns, np.take_along_axis(columns, bound[:, None], 1)))
    return out


def rounds(n: int, dim: int) -> list[tuple[int, int]]:
    """How deep all lists are read, and how many of a query's strongest to their end, round by round."""
    first, more = min(n, FIRST_STRETCH), min(n, max(FIRST_STRETCH, n // 8))
    shares = [0, dim // 2, 3 * dim // 4, 7 * dim // 8, dim]
    return list(dict.fromkeys([(first, 0), *((more, whole) for whole in shares)]))


def candidates(
    columns: np.ndarray,
    lists: np.ndarray,
    queries: np.ndarray,
    k: int,
    slack: np.ndarray | float = 0.0,
    floor: np.ndarray | float = -np.inf,
) -> tuple[list[np.ndarray], np.ndarray]:
    """For each query the entries that may be among the k best (all that tie with the last included),
    and the mean depth its lists were read to.

    columns: (dim, entries); lists: entry numbers by rising value, for each component; queries: one a
    row. slack: what an upper and a lower bound may be off by together. floor: a score that k other
    entries are known to reach. All lists are read in step first, each from the end that adds most;
    then those to their end that leave the widest gap between the bounds. The bounds of all entries
    and queries are products of the queries with bounds of components.
    """
    dim, n = columns.shape
    left = [np.arange(n)] * len(queries)
    depth = np.zeros(len(queries))
    if n <= k:
        return left, depth
    slack, floor = (np.broadcast_to(x, len(queries)) for x in (slack, floor))
    ends = [np.take_along_axis(columns, lists[:, at : at + 1], 1)[:, 0] for at in (0, n - 1)]
    gaps = np.abs(queries) * (ends[1] - ends[0])
    place = np.argsort(np.argsort(-gaps, axis=1, kind="stable"), axis=1, kind="stable")
    used = np.maximum(1, np.count_nonzero(queries, axis=1))
    open_, at, bounds = np.arange(len(queries)), 0, []
    for until, whole in rounds(n, dim):
        if until != at:
            at, bounds = until, stretch(columns, lists, until)
        asked = queries[open_]
        ended = place[open_] < whole
        rest = np.where(ended, 0.0, asked)
        low = high = np.where(ended, asked, 0.0) @ columns if whole else 0.0
        if whole < dim:
            up, down = np.maximum(rest, 0.0), np.minimum(rest, 0.0)
            high = low + up @ bounds[0] + down @ bounds[2]
            low = low + up @ bounds[1] + down @ bounds[3]
        reached = np.maximum(np.partition(low, n - k, axis=1)[:, n - k], floor[open_])
        within = high >= (reached - slack[open_])[:, None]
        done = np.count_nonzero(within, axis=1) <= 4 * k
        if whole == dim:
            done[:] = True
        for i in np.flatnonzero(done):
            q = open_[i]
            left[q] = np.flatnonzero(within[i])
            through = np.count_nonzero(ended[i] & (asked[i] != 0))
            depth[q] = (through * n + (used[q] - through) * at) / used[q]
        open_ = open_[~done]
        if not len(open_):
            break
    return left, depth


def in_units(score: int, exponent: int) -> float:
    """An exact score as a double in units of 2^exponent, rounded down."""
    spare = max(0, score.bit_length() - 53)
    with np.errstate(over="ignore"):
        return float(np.ldexp(float(score >> spare), spare - exponent)) / SCALE**2


def sorted_lists(vectors: DataFrame) -> DataFrame:
    """One row per shard and length of vector: dim, shard, entries (ids of each), data (rounded
    components), lists (entry numbers by rising value, component by component)."""

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(first=[i[0] for i in group["ids"]]).sort_values("first")
        values = rounded(matrix(group["v"]))
        lists = np.argsort(values.T, axis=1, kind="stable").astype(np.int32)
        return pd.DataFrame(
            {
                "dim": [values.shape[1]],
                "shard": [int(group["shard"].iloc[0])],
                "entries": [[list(i) for i in group["ids"]]],
                "data": [values.tobytes()],
                "lists": [lists.tobytes()],
            }
        )

    return vectors.groupBy("dim", "shard").applyInPandas(
        build, "dim int, shard int, entries array<array<long>>, data binary, lists binary"
    )


def top_inner_products(
    df: DataFrame,
    queries: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    shard_size: int = SHARD,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows with the largest inner product of
    floor(1024 * component), the query's own row left out, ties to smaller ids; exact. queries:
    condition on id (long).

    Vectors null, empty or with null or non-finite components, and rows without id, take no part;
    zero vectors do. Ranks are those of the exact integer product, however large; a score that a
    long can't hold is shown as the end of its range. Repeated ids count once; only vectors of the query's length are its candidates. Fewer candidates than k: all of them. No
    rows or no queries: no rows. Other columns are not read.
    """
    rows = saved(clean(df, id_col, vec_col, nonzero=False))
    vectors, shards = sharded(saved(distinct_vectors(rows, k + 1)), shard_size)
    index = saved(sorted_lists(vectors))
    blocks = saved(query_blocks(rows, queries, QUERY_BLOCK))

    #: Of the queries this task has met: the k-th best score so far, no later shard needs less.
    kth: dict[int, int] = {}

    def search(row) -> pd.DataFrame:
        own = np.frombuffer(row.ids, np.int64)
        asked = rounded(np.frombuffer(row.vectors, np.float64).reshape(len(own), row.dim))
        values = np.frombuffer(row.data, np.float64).reshape(-1, row.dim)
        lists = np.frombuffer(row.lists, np.int32).reshape(row.dim, -1)
        scaled, exponent = units(values)
        columns = np.ascontiguousarray(scaled.T)
        pairs = [units(query) for query in asked]
        sent = np.stack([u for u, _ in pairs])
        exponents = [exponent + e for _, e in pairs]
        # All sums of products are integers of units below 2^53: exact in a double.
        exact = np.array([row.dim * SCALE**2 * 2.0 ** min(e, 99) < 2.0**53 for e in exponents])
        reach = np.abs(sent) @ np.abs(columns).max(axis=1) + 2.0**-900
        slack = np.where(exact, 0.0, 16 * (row.dim + 8) * 2.0**-52 * reach)
        floor = np.array([in_units(kth[q], e) if q in kth else -np.inf for q, e in zip(own.tolist(), exponents)])
        # One more than k: the query's own entry may be among them.
        found, _ = candidates(columns, lists, sent, k + 1, slack, floor)
        out = []
        for q, query, left, sure in zip(own.tolist(), asked, found, exact):
            if sure:
                final = map(int, ((SCALE * values[left]) @ (SCALE * query)).tolist())
            else:
                final = products(values[left], query)
            scores = dict(zip(left.tolist(), final))
            best = best_rows(row.entries, q, scores, scores, k)
            if len(best) == k:
                kth[q] = max(best[-1][1], kth.get(q, best[-1][1]))
            out += [(q, i, min(max(s, LEAST), LARGEST), beyond(s)) for i, s in best]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score", "beyond"])

    return search_shards(index, blocks, shards, search, "long", k, among_equal="beyond")
