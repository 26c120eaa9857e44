"""What the two vector searches share: clean distinct vectors, shards of them, blocks of queries.

Searches of a stated query set go shard by shard: every block of queries meets every shard once,
a shard returns its best rows per query, and the shards' results are merged. A vector that occurs
many times is one entry with its smallest ids: a result of k rows cannot need more than k + 1.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import join_hot, saved


def clean(df: DataFrame, id_col: str, vec_col: str, nonzero: bool) -> DataFrame:
    """id, v (array<double>). Rows without id, null or empty vectors and those with null or
    non-finite components take no part; nonzero leaves zero vectors out as well. Repeated ids
    count once, with their smallest vector."""
    v = F.col(vec_col).cast("array<double>")
    df = df.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    df = df.filter("id is not null and v is not null and size(v) > 0")
    # abs(NaN) is larger than any number here, so one comparison finds both kinds.
    fine = F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    df = df.filter(fine)
    if nonzero:
        df = df.filter(F.exists("v", lambda x: x != 0.0))
    return df.groupBy("id").agg(F.min("v").alias("v"))


def distinct_vectors(rows: DataFrame, most: int) -> DataFrame:
    """v and its `most` smallest ids. The limit is applied in the map tasks already, so a vector
    with a large share of the rows sends a few of them only."""
    first = Window.partitionBy("v").orderBy("id")
    kept = rows.withColumn("__r", F.row_number().over(first)).filter(F.col("__r") <= most)
    return kept.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def magnitude() -> Column:
    """A number for the length of v: lengths within a factor of 4 share it, unit vectors are mid-range.
    Squares are of components relative to the largest, so nothing leaves the doubles' range."""
    largest = F.array_max(F.transform("v", F.abs))
    squares = F.aggregate("v", F.lit(0.0), lambda total, x: total + (x / largest) * (x / largest))
    return F.floor((F.log2(largest) + F.log2(squares) / 2) / 2 + 0.5).cast("int")


def sharded(vectors: DataFrame, shard_size: int, by_length: bool = False) -> tuple[DataFrame, int]:
    """The vectors with dim and shard, and the number of shards: it grows with the table. by_length
    (no zero vectors): a shard has vectors of one magnitude."""
    if not by_length:
        count = math.ceil(max(1, vectors.count()) / shard_size)
        shard = F.pmod(F.xxhash64("v"), F.lit(count)).cast("int")
        return vectors.withColumn("dim", F.size("v")).withColumn("shard", shard), count
    vectors = saved(vectors.withColumn("magnitude", magnitude()))
    # Doubles have some 1,050 magnitudes at most, whatever the table.
    first, shards = [], 0
    for r in vectors.groupBy("magnitude").count().orderBy("magnitude").collect():
        first.append((r["magnitude"], shards, math.ceil(r["count"] / shard_size)))
        shards += first[-1][2]
    placed = vectors.sparkSession.createDataFrame(first, "magnitude int, first int, parts int")
    vectors = vectors.join(F.broadcast(placed), "magnitude")
    shard = (F.col("first") + F.pmod(F.xxhash64("v"), F.col("parts"))).cast("int")
    return vectors.select("v", "ids", F.size("v").alias("dim"), shard.alias("shard")), max(1, shards)


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def query_blocks(rows: DataFrame, queries: Column, block: int) -> DataFrame:
    """dim, block, ids and vectors (bytes) of the query rows, about `block` in each."""
    chosen = saved(rows.filter(queries).withColumn("dim", F.size("v")))
    parts = math.ceil(max(1, chosen.count()) / block)

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        return pd.DataFrame(
            {
                "dim": [int(group["dim"].iloc[0])],
                "ids": [group["id"].to_numpy(np.int64).tobytes()],
                "vectors": [matrix(group["v"]).tobytes()],
            }
        )

    chosen = chosen.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"))
    return chosen.groupBy("dim", "block").applyInPandas(
        pack, "dim int, ids binary, vectors binary"
    )


def search_shards(
    index: DataFrame,
    blocks: DataFrame,
    shards: int,
    search: Callable,
    score: str,
    k: int,
    among_equal: str | None = None,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of what search(row) yields for each block and
    shard, larger scores first, ties to smaller ids. index: dim, shard and what search reads.
    among_equal: a column (binary) that search yields too; of equal scores, larger ones are first."""
    asked = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    met = join_hot(asked, index, ["dim", "shard"])

    def work(batches):
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                yield search(row)

    more = [among_equal] if among_equal else []
    made = ", ".join(["query_id long", "vec_id long", f"score {score}", *(f"{c} binary" for c in more)])
    found = met.mapInPandas(work, made)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), *map(F.desc, more), F.asc("vec_id"))
    found = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")


def best_rows(ids: list, query: int, order: np.ndarray, scores: np.ndarray, k: int) -> list[tuple]:
    """Ids and scores of the k best rows for a query: entries expanded to their ids, the query's
    own left out. order: entries by falling score, all that tie with the last included."""
    out = [(-scores[e], int(i)) for e in order for i in ids[e] if i != query]
    out.sort()
    return [(i, -s) for s, i in out[:k]]
