"""Packing of token sequences by minimum bin slack.

Every whole window of a document is a sequence of its own; what remains of each document goes into
a pool. Pools are bounded shares of the remainders. For each next sequence the longest remainder
is set, and subset-sum dynamic programming over a bitset of fill levels finds the multiset of
remaining lengths that comes closest to the capacity; the counts are read back from the levels
kept before each length, and the same multiset is used as often as the pool allows.
"""

from __future__ import annotations

import math
from zlib import crc32

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_small_batches, join_hot, numbers_of_equals, saved
from .tokens import VOCABULARY, Ids, reader

#: Pieces in a pool, about.
POOL = 16_384
#: Equal pieces that go to one pool together.
EQUAL = 256
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def best_fill(counts: dict[int, int], lengths: list[int], room: int) -> list[tuple[int, int]]:
    """(length, times) that fill the room as far as the counts allow. lengths: falling."""
    levels, before = 1, []
    mask = (1 << (room + 1)) - 1
    for length in lengths:
        most = min(counts[length], room // length)
        if most <= 0:
            continue
        before.append((length, most, levels))
        step = 1
        while most > 0:  # copies in shares of 1, 2, 4 …: every number up to `most` is reached
            step = min(step, most)
            levels |= (levels << (step * length)) & mask
            most -= step
            step *= 2
        if levels >> room:
            break
    fill = levels.bit_length() - 1
    chosen = []
    for length, most, earlier in reversed(before):
        times = 0
        while not earlier >> fill & 1:
            fill -= length
            times += 1
        if times:
            chosen.append((length, times))
    return chosen


def pack_lengths(lengths: list[int], capacity: int) -> list[list[int]]:
    """Positions of the given lengths (1 to capacity), window by window."""
    held: dict[int, list[int]] = {}
    for i, length in enumerate(lengths):
        held.setdefault(length, []).append(i)
    counts = {length: len(own) for length, own in held.items()}
    falling = sorted(counts, reverse=True)
    windows = []
    while falling:
        first = falling[0]
        counts[first] -= 1
        chosen = dict(best_fill(counts, falling, capacity - first))
        counts[first] += 1
        chosen[first] = chosen.get(first, 0) + 1
        for _ in range(min(counts[length] // times for length, times in chosen.items())):
            windows.append([held[length].pop() for length, n in sorted(chosen.items(), reverse=True) for _ in range(n)])
            for length, n in chosen.items():
                counts[length] -= n
        falling = [length for length in falling if counts[length]]
    return windows


def pieces(
    docs: DataFrame, capacity: int, id_col: str, text_col: str, vocabulary: str, with_ids: bool
) -> DataFrame:
    """The documents' ids with the end id 0, cut into windows of the capacity and a remainder."""
    schema = PIECE + (", ids binary" if with_ids else "")

    def work(batches):
        made = reader(Ids, vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                own = batch.slice(at, 256)
                out: list[list] = [[], [], [], [], [], []]
                for doc_id, text in zip(own.column(0).to_pylist(), own.column(1).to_pylist()):
                    data = (made.encode(text) if text else b"") + bytes(4)
                    total = len(data) // 4
                    for start in range(0, total, capacity):
                        part = data[4 * start : 4 * (start + capacity)]
                        row = (doc_id, start, len(part) // 4, crc32(part), total, part)
                        for column, value in zip(out, row):
                            column.append(value)
                arrays = [pa.array(c, pa.int64()) for c in out[:5]]
                if with_ids:
                    arrays.append(pa.array(out[5], pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in schema.split(", ")])

    docs = in_small_batches(docs)
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(work, schema)


def pack(
    docs: DataFrame,
    capacity: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    with_ids: bool = False,
    pool: int = POOL,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and
    with with_ids the ids themselves (unsigned little-endian 32 bits).

    A document is the ids of its whole text and an end id 0; null and empty texts are the end id
    alone. Every id lies in exactly one piece, pieces of a sequence follow each other without gap.
    Rows are packed one by one, so repeated and null ids stay; rows without id share sequences with
    each other only. Padding is left at the end of a
    pool only. An empty table gives no rows; other columns are not read. Reruns pack the remainders
    alike: a pool is a hash share of them, equal ones shared out too, taken in a fixed order; whole windows have sequences of
    their own, whose numbers start at 2^62.
    """
    cut = pieces(docs, capacity, id_col, text_col, vocabulary, with_ids)
    names = cut.columns
    cut = saved(cut.withColumn("place", F.monotonically_increasing_id()))
    left = cut.filter(F.col("length") < capacity)
    left = left.agg(F.count("doc_id").alias("named"), F.count_if(F.isnull("doc_id")).alias("unnamed")).first()
    pools, more = (math.ceil(max(1, n) / pool) for n in left)
    # A whole window needs no company, so its ids stay where they were written.
    number = F.monotonically_increasing_id() + F.lit(1 << 62)
    whole = cut.filter(F.col("length") == capacity).drop("place").withColumns({"sequence_id": number, "offset": F.lit(0).cast("long")})
    rest = cut.filter(F.col("length") < capacity)
    # Rows without id have pools of their own, dealt by place: they may all be alike, and pandas
    # would turn the ids beside them into floating-point numbers.
    # Equal remainders of one id have one hash: every EQUAL of them are dealt anew.
    equals = saved(numbers_of_equals(rest.filter("doc_id is not null"), ["doc_id", "start", "ids_crc32"], "place"))
    rest = join_hot(rest, equals, ["place"], "left") if equals.head(1) else rest.withColumn("number", F.lit(0))
    again = F.floor(F.coalesce("number", F.lit(0)) / EQUAL)
    by_id = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", again), F.lit(pools))
    by_place = F.pmod(F.xxhash64("place"), F.lit(more)) + pools
    rest = rest.withColumn("pool", F.when(F.isnull("doc_id"), by_place).otherwise(by_id)).select(*names, "pool")

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "start", "ids_crc32"], kind="stable", ignore_index=True)
        lengths = group["length"].tolist()
        sequence, offset = [0] * len(lengths), [0] * len(lengths)
        base = int(group["pool"].iloc[0]) << 32
        for number, window in enumerate(pack_lengths(lengths, capacity)):
            at = 0
            for i in window:
                sequence[i], offset[i] = base + number, at
                at += lengths[i]
        return group[names].assign(sequence_id=sequence, offset=offset)

    schema = PIECE + (", ids binary" if with_ids else "") + ", sequence_id long, offset long"
    return whole.unionByName(rest.groupBy("pool").applyInPandas(place, schema))
