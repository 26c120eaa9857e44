"""Mixing sources to target weights by Pareto order sampling.

Within a source the expected copies of a document grow with its odds, up to the most allowed, so
that the expected words are the source's target. Whole copies are certain; for the rest documents
are ranked by their random odds over their odds of inclusion, and the sample of fixed size (in
words) is the head of that order. The order is cut into buckets, so no source is ever sorted in one
task: buckets before the border are taken whole by their sums, and of the one bucket at the border
only sizes and ranks are walked, equal rows counted as one.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, join_hot, numbers_of_equals, saved
from .packing import best_fill

WEIGHTS = (5, 2, 1)
#: Documents in a bucket, about, and most buckets of a source.
BUCKET, BUCKETS = 512, 1 << 20
#: Documents of the head that may be given back to meet a target.
BACK = 8
#: Sources up to which their table (some 100 bytes a row) is broadcast.
FEW = 10_000


def targets(
    sizes: dict[str | None, int], weights: Sequence[int], share: Fraction, most: int
) -> dict[str | None, Fraction]:
    """Words of each source: the shared total by weight; what is above `most` times a source's
    size goes back to the others until none is above."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_ones, out = share * sum(sizes.values()), set(order), {}
    while open_ones:
        unit = left / sum(weight[s] for s in open_ones)
        above = {s for s in open_ones if weight[s] * unit >= most * sizes[s]}
        if not above:
            return out | {s: weight[s] * unit for s in open_ones}
        for s in above:
            out[s] = Fraction(most * sizes[s])
            left -= out[s]
        open_ones -= above
    return out


def _with_small(rows: DataFrame, plan: DataFrame, keys: list[str], sources: int, how: str) -> DataFrame:
    """Join a table of some rows per source; it is broadcast only where it is known to be small."""
    return join_hot(rows, plan if sources > FEW else F.broadcast(plan), keys, how)


def expected_copies(words: dict[int, int], target: Fraction, most: int) -> dict[int, Fraction]:
    """Copies of a document by its odds, given the words of the documents of each odds: in
    proportion to the odds, at most `most`, with the target as the sum of copies * words."""
    left, open_ones, out = target, {o for o, n in words.items() if o and n}, {o: Fraction(0) for o in words}
    while open_ones:
        unit = left / sum(o * words[o] for o in open_ones)
        above = {o for o in open_ones if unit * o >= most}
        if not above:
            return out | {o: unit * o for o in open_ones}
        for o in above:
            out[o] = Fraction(most)
            left -= most * words[o]
        open_ones -= above
    return out


def walk(group: pd.DataFrame) -> pd.DataFrame:
    """How many of each group of equal rows a border bucket gives: the head of the order that fits.
    What is then missing, less than the next document, is filled from the rest of the bucket by
    sizes that add up to it as closely as can be, in the order of rank within a size. Where a word
    or more is still missing, the last BACK documents of the head are given back one by one and
    filled anew, and the closest of these ends counts. One more document follows where that is
    closer."""
    group = group.sort_values(["rank", "key"], ignore_index=True)
    room = float(group["sought"].iloc[0] - group["before"].iloc[0])
    sizes, left = group["size"].tolist(), group["rows"].tolist()
    taken, last = [0] * len(sizes), 0
    for last, size in enumerate(sizes):
        taken[last] = min(left[last], int(room // size))
        left[last] -= taken[last]
        room -= taken[last] * size
        if left[last]:
            break
    best = None
    for _ in range(BACK + 1):
        counts: dict[int, int] = {}
        for size, n in zip(sizes, left):
            if n and size <= room:
                counts[size] = counts.get(size, 0) + n
        fill = best_fill(counts, sorted(counts, reverse=True), int(room)) if counts else []
        missing = int(room) - sum(size * times for size, times in fill)
        if best is None or missing < best[0]:
            best = missing, taken.copy(), left.copy(), room, dict(fill)
        while last >= 0 and not taken[last]:
            last -= 1
        if not missing or last < 0:
            break
        taken[last], left[last], room = taken[last] - 1, left[last] + 1, room + sizes[last]
    _, taken, left, room, wanted = best
    for i, size in enumerate(sizes):
        times = min(left[i], wanted.get(size, 0))
        if times:
            wanted[size] -= times
            taken[i], left[i], room = taken[i] + times, left[i] - times, room - times * size
    over = min(((size, i) for i, size in enumerate(sizes) if left[i]), default=None)
    if over and over[0] < 2 * room:
        taken[over[1]] += 1
    return group[["source", "key", "rows"]].assign(heads=taken)


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: Fraction = Fraction(3, 2),
    most: int = 2,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    carry: Sequence[str] = ("doc_id",),
    odds: Column | None = None,
) -> DataFrame:
    """Per row of docs its `carry` columns and mix: a struct of size (words), source_size, target
    (words of its source), copies and taken (copies * size).

    odds: few different whole numbers; a source's documents are expected in proportion to them, and
    those of odds 0 or null are left out. By default the binary digits of the size, so a long text
    is a little likelier than a short one.

    Null texts have no words and are never taken; a null source is a source like the others, last
    in order. Equal rows share a rank; where the border falls among them, some of them are drawn.
    The draw depends on the carried columns, id, text and seed alone, so reruns agree. An empty
    table gives no rows. The result is one struct column, so carried columns keep any name; maps
    can't be carried. A row per source and odds passes through the driver; sources are taken to be
    few. With BUCKETS a border holds more than BUCKET documents in sources of over 5 * 10^8, as
    numbers only.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    held = F.when(size > 0, F.length(F.bin(size)) if odds is None else odds.cast("int"))
    row = F.struct(*(F.col(f"`{c}`") for c in carry))
    base = saved(
        docs.select(
            row.alias("row"),
            F.col(source_col).alias("source"),
            size.alias("size"),
            F.greatest(F.coalesce(held, F.lit(0)), F.lit(0)).alias("odds"),
            F.xxhash64(F.col(id_col).cast("string"), F.xxhash64(text_col), F.xxhash64(row), F.lit(seed)).alias("key"),
            # Numbers the rows; the upper bits are those of the task.
            F.monotonically_increasing_id().alias("place"),
        )
    )
    spark = docs.sparkSession
    sums: dict = {}
    for r in base.groupBy("source", "odds").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")).collect():
        sums.setdefault(r["source"], {})[r["odds"]] = (r["size"], r["rows"])
    sizes = {s: sum(n for n, _ in own.values()) for s, own in sums.items()}
    aims = targets(sizes, weights, share, most)
    plan = []
    for s, own in sums.items():
        times = expected_copies({o: n for o, (n, _) in own.items()}, aims[s], most)
        rest = float(sum((times[o] - int(times[o])) * n for o, (n, _) in own.items()))
        buckets = min(BUCKETS, -(-sum(n for _, n in own.values()) // BUCKET))
        for o, t in times.items():
            plan.append((s, o, sizes[s], float(aims[s]), int(t), float(t - int(t)), rest, buckets))
    plan = spark.createDataFrame(
        plan,
        "source string, odds int, source_size long, target double, whole int, chance double, rest double, buckets int",
    )
    rows = _with_small(base, plan, ["source", "odds"], len(sums), "inner")
    # Random odds over odds of inclusion, brought to (0, 1): the border lies near 1 to 1, where
    # documents lie no denser than evenly, whatever their chances.
    u = (F.shiftrightunsigned("key", 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    ranked = F.col("u") * (1 - F.col("chance"))
    ranked = ranked / (ranked + (1 - F.col("u")) * F.col("chance"))
    rows = rows.withColumn("u", u).withColumn("rank", F.when(F.col("chance") > 0, ranked)).drop("u")
    bucket = F.least(F.floor(F.col("rank") * F.col("buckets")), F.col("buckets") - 1)
    rows = rows.withColumn("bucket", F.when(F.col("rank").isNotNull(), bucket))

    # Where each source's order passes what is left of its target beside the whole copies.
    order = Window.partitionBy("source").orderBy("bucket")
    heads = rows.filter("bucket is not null").groupBy("source", "bucket")
    heads = heads.agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    heads = heads.withColumn("before", F.sum("words").over(order) - F.col("words"))
    border = heads.filter("before < rest and before + words >= rest")
    border = saved(border.select("source", F.col("bucket").alias("border"), F.col("rest").alias("sought"), "before"))
    rows = _with_small(rows, border, ["source"], len(sums), "left")

    # A row without rank has no draw; a source without border has nothing to draw.
    at = F.col("border").isNotNull() & F.col("bucket").eqNullSafe(F.col("border"))
    clear = rows.filter(~at).withColumn("drawn", F.coalesce(F.col("bucket") < F.col("border"), F.lit(False)))
    near = rows.filter(at)
    equal = near.groupBy("source", "key", "size", "rank", "sought", "before").agg(F.count(F.lit(1)).alias("rows"))
    walked = equal.groupBy("source").applyInPandas(walk, "source string, key long, rows long, heads long")
    near = saved(join_hot(near, walked, ["source", "key"]))

    # Of equal rows on the border the first ones by place.
    settled = near.filter("heads = 0 or heads = rows").withColumn("drawn", F.col("heads") > 0)
    split = near.filter("heads > 0 and heads < rows")
    split = join_hot(split, numbers_of_equals(split, ["key"], "place"), ["place"])
    split = split.withColumn("drawn", F.col("number") < F.col("heads"))
    columns = clear.columns
    drawn = clear.unionByName(settled.select(columns)).unionByName(split.select(columns))
    copies = F.col("whole") + F.col("drawn").cast("int")
    return drawn.select(
        "row.*",
        F.struct(
            "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
        ).alias("mix"),
    )
