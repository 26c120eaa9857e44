"""Near duplicates by circulant MinHash.

Two permutations of the circle of 2^32 places make all signature coordinates: the first deals the
shingles over the circle, the second is shifted by one place for every further coordinate.
Coordinates are banded; texts that share a band are candidates, and every link is confirmed on the
full shingle sets. Copies with the same set are one node from the start. In a bucket every text is
compared with the smallest one first; only buckets that still hold several components are looked
at again, in blocks of bounded size, where an exact prefix index finds the remaining links and
each block returns a spanning forest. So no step lists the pairs of a group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HASHES, in_small_batches, join_hot, mix64, saved, shingle_set, use_cache
from .components import components

ROWS = 6
#: Shingles whose signature is worked out at a time: small enough for the processor's cache.
STRETCH = 32_768
#: Shingles in one block of a crowded bucket (8 bytes each).
BLOCK = 800_000
#: Bytes of texts or sets that reach a Python worker at once.
BATCH = 4 << 20
#: Bits of the filter of wanted documents (8 MB).
FILTER_BITS = 1 << 26


def bands_for(threshold: float, rows: int = ROWS, miss: float = 1e-6) -> int:
    """Bands that leave a pair at the threshold uncaught with at most this probability."""
    return math.ceil(math.log(miss) / math.log1p(-(threshold**rows)))


def _permute(x: np.ndarray, spare: np.ndarray) -> None:
    """A permutation of the 32-bit numbers, in place."""
    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
        np.right_shift(x, np.uint32(shift), out=spare)
        np.bitwise_xor(x, spare, out=x)
        np.multiply(x, np.uint32(factor), out=x)
    np.right_shift(x, np.uint32(16), out=spare)
    np.bitwise_xor(x, spare, out=x)


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """Circulant MinHash of non-empty shingle sets: (sets, size) numbers of 32 bits."""
    out = np.empty((len(sets), size), np.uint32)
    first = 0
    while first < len(sets):
        last, total = first, 0
        while last < len(sets) and (last == first or total + len(sets[last]) <= STRETCH):
            total += len(sets[last])
            last += 1
        for k, values in enumerate(_stretch(sets[first:last], size)):
            out[first:last, k] = values
        first = last
    return out


def _stretch(sets: list[np.ndarray], size: int) -> Iterator[np.ndarray]:
    joined = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    # First permutation: the set's place on the circle.
    place = (joined >> np.uint64(32)).astype(np.uint32)
    x, spare = np.empty_like(place), np.empty_like(place)
    _permute(place, spare)
    for k in range(size):
        np.subtract(place, np.uint32(k), out=x)  # the second one, shifted by k places
        _permute(x, spare)
        yield np.minimum.reduceat(x, starts)


def _band_keys(signs: np.ndarray, rows: int) -> np.ndarray:
    docs, size = signs.shape
    bands = size // rows
    raw = np.ascontiguousarray(signs[:, : bands * rows]).view(np.uint8).reshape(docs, bands, rows * 4)
    keys = np.empty((docs, bands), np.int64)
    for b in range(bands):
        part = np.ascontiguousarray(raw[:, b])
        keys[:, b] = np.array(
            [xxhash.xxh3_64_intdigest(r, seed=b) for r in part], np.uint64
        ).view(np.int64)
    return keys


def sketch(docs: DataFrame, id_col: str, text_col: str, threshold: float, width: int) -> DataFrame:
    """Per row: doc_id, n_shingles, digest of the set, and its band keys (empty set: none)."""
    bands = bands_for(threshold)

    def work(batches):
        use_cache(HASHES)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                ids, texts = batch.column(0).slice(at, 512), batch.column(1).slice(at, 512)
                sets = [shingle_set(t, width) for t in texts.to_pylist()]
                full = [i for i, s in enumerate(sets) if len(s)]
                keys = [[] for _ in sets]
                if full:
                    made = _band_keys(signatures([sets[i] for i in full], bands * ROWS), ROWS)
                    for i, row in zip(full, made):
                        keys[i] = row
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.cast(pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                        pa.array(keys, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_shingles", "digest", "bands"],
                )

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        work, "doc_id long, n_shingles long, digest binary, bands array<long>"
    )


def _bit_places(ids: np.ndarray) -> np.ndarray:
    x = mix64(ids.astype(np.int64).view(np.uint64))
    return (np.stack([x, x >> np.uint64(32)]) & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def id_filter(ids: DataFrame) -> bytes:
    """Bits set for a column of ids, of one size for any number of them. It only keeps what is
    clearly not asked for out of a shuffle; an exact join follows."""

    def work(batches):
        bits = np.zeros(FILTER_BITS // 64, np.uint64)
        for batch in batches:
            places = _bit_places(batch.column(0).to_numpy(zero_copy_only=False)).ravel()
            np.bitwise_or.at(bits, places >> 6, np.uint64(1) << (places & 63).astype(np.uint64))
        used = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(bits[used].view(np.int64))], ["place", "bits"])

    words = ids.mapInArrow(work, "place long, bits long").groupBy("place").agg(F.bit_or("bits").alias("bits"))
    words = words.toPandas()
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[words["place"]] = words["bits"]
    return bits.tobytes()


def shingle_table(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """node and its sorted set as bytes, for the wanted nodes; a node has a row for each of its
    different texts. Texts stay where they are read, only wanted sets are shuffled."""
    asked = docs.sparkSession.sparkContext.broadcast(id_filter(wanted.select("node")))

    def work(batches):
        use_cache(HASHES)
        bits = np.frombuffer(asked.value, np.uint64)
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            places = _bit_places(batch.column(0).to_numpy(zero_copy_only=False))
            hit = (bits[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1)
            batch = batch.filter(pa.array(hit.all(axis=0)))
            for at in range(0, batch.num_rows, 512):
                texts = batch.column(1).slice(at, 512).to_pylist()
                sets = [shingle_set(t, width).tobytes() for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, 512).cast(pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary()),
                        pa.array(sets, pa.binary()),
                    ],
                    ["node", "digest", "shingles"],
                )

    made = docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        work, "node long, digest binary, shingles binary"
    )
    made = made.dropDuplicates(["node", "digest"]).select("node", "shingles")
    return join_hot(made, wanted, ["node"], "left_semi")


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * shared >= percent * all, on two sorted sets; empty sets link with nothing."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    shared = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    def work(batches):
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            keep = [
                i
                for i in range(batch.num_rows)
                if linked(
                    np.frombuffer(cols[2][i], np.uint64), np.frombuffer(cols[3][i], np.uint64), percent
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())), batch.column(1).take(pa.array(keep, pa.int64()))],
                ["a", "b"],
            )

    here = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    there = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = join_hot(join_hot(pairs, here, ["a"]), there, ["b"])
    short = F.least(F.length("sa"), F.length("sb"))
    both = both.filter(short * 100 >= F.greatest(F.length("sa"), F.length("sb")) * percent)
    return both.select("a", "b", "sa", "sb").mapInArrow(work, "a long, b long").distinct()


def forest(nodes: list[int], labels: list[int], sets: list[np.ndarray], percent: int) -> list[tuple]:
    """Links that join different labels, enough of them to span each component of the block.

    Two sets that overlap this much share one of the rarest 100 - percent hundredths (and one) of
    either set's shingles, so an index of these finds every link.
    """
    root = {x: x for x in labels}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    _, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # By place and label, so that a component is asked for once, not once per member.
    posts: dict[int, dict[int, list[int]]] = {}
    found, at = [], 0
    tried: set[tuple[int, int]] = set()
    for i, s in enumerate(sets):
        places = inverse[at : at + len(s)]
        at += len(s)
        first = len(s) - math.ceil(percent * len(s) / 100) + 1
        order = np.lexsort((places, counts[places]))[:first]
        for p in places[order]:
            if counts[p] < 2:
                continue
            others = posts.setdefault(int(p), {})
            for label, held in others.items():
                if find(labels[i]) == find(label):
                    continue
                for j in held:
                    if (j, i) in tried:
                        continue
                    tried.add((j, i))
                    if linked(s, sets[j], percent):
                        root[find(labels[i])] = find(label)
                        found.append((nodes[i], nodes[j]))
                        break
            others.setdefault(labels[i], []).append(i)
    return found


def _residual(members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components that still meet in a bucket. members: key, node, n, m."""
    known = join_hot(members, labels.withColumnRenamed("label", "known"), ["node"], "left")
    known = known.withColumn("label", F.coalesce("known", "node")).drop("known")
    buckets = (
        known.groupBy("key")
        .agg(
            F.min("label").alias("low"),
            F.max("label").alias("high"),
            F.bit_xor(F.xxhash64("node")).alias("who"),
            F.sum("n").alias("total"),
            F.max("m").alias("m"),
        )
        .filter("low <> high")
        # The same members often meet in several bands: once is enough.
        .groupBy("who", "m", "total")
        .agg(F.min("key").alias("key"))
        .withColumn("parts", F.ceil(F.col("total") / BLOCK).cast("int"))
        .select("key", "parts")
    )
    rows = join_hot(known, buckets, ["key"]).withColumn(
        "mine", F.pmod(F.xxhash64("node"), "parts").cast("int")
    )
    # A crowded bucket: every two of its parts meet in a block of their own.
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select(
        "key", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"), "node", "label"
    )
    rows = join_hot(rows, sets, ["node"])

    def work(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("node")
        sets = [np.frombuffer(s, np.uint64) for s in block["shingles"]]
        found = forest(block["node"].tolist(), block["label"].tolist(), sets, percent)
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return rows.groupBy("key", "p", "q").applyInPandas(work, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 85,
    width: int = 5,
) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id (smallest id that links reach), kept.

    Links: 100 * shared >= percent * all shingles. Null, empty and blank texts have no shingles
    and link with nothing. Rows that share an id are one document. A row without an id takes no
    part: its component is null and it is kept. An empty table gives no rows. Other columns of
    docs, whatever their names, are not read.
    """
    docs = in_small_batches(docs, 256, BATCH)
    sketches = saved(sketch(docs, id_col, text_col, percent / 100, width))
    full = sketches.filter("doc_id is not null and n_shingles > 0")
    # Equal sets are one class, represented by its smallest id.
    classes = full.groupBy("digest").agg(
        F.min("doc_id").alias("node"), F.min("n_shingles").alias("n"), F.any_value("bands").alias("bands")
    )
    classes = saved(classes)
    members = join_hot(full.select("doc_id", "digest"), classes.select("digest", "node"), ["digest"])
    members = saved(members.select("doc_id", "node").distinct())
    several = members.groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("z"))
    several = join_hot(members, several.filter("b <> z"), ["doc_id"]).select(F.col("node").alias("a"), "b")

    heads = classes.select("node", "n", F.explode("bands").alias("key"))
    buckets = heads.groupBy("key").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("m"))
    crowded = saved(join_hot(heads, buckets.filter("m > 1"), ["key"]).select("key", "node", "n", "pivot", "m"))

    pairs = saved(
        crowded.filter("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    )
    wanted = saved(crowded.select("node").distinct())
    sets = saved(shingle_table(docs, wanted, id_col, text_col, width))

    links = saved(_confirm(pairs, sets, percent).unionAll(several))
    first = saved(components(links))
    more = saved(_residual(crowded.filter("m > 2").select("key", "node", "n", "m"), first, sets, percent))
    labels = first
    if not more.isEmpty():
        labels = components(first.select(F.col("node").alias("a"), F.col("label").alias("b")).unionAll(more))
    named = join_hot(members, labels, ["node"], "left")
    named = named.groupBy("doc_id").agg(F.min(F.coalesce("label", "node")).alias("component_id"))
    rows = sketches.select("doc_id", "n_shingles")
    rows = join_hot(rows, named, ["doc_id"], "left")
    rows = rows.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return rows.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
