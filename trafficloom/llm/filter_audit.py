"""How filters of documents interact, for every order in which they can be applied.

A document is reduced to the set of filters it fails, and documents of one part that fail the same
ones are counted as one cell: 32 cells a part at most. Every cell folds across the array of the 120
orders with aggregate and transform into 600 weighted structs, one per order and step; those of a
part's cells are summed element by element.

Defined results: a null text counts as empty, a null part as the empty string. Filter E asks for the
same text under any smaller id of the whole table, so rows that repeat the smallest id don't fail
it; a null id is smaller than none and has none below it. A document is good (toxic) if any label of
its id says so; labels without id count for nothing. A part without documents has no rows, so an
empty table gives none. Extra columns play no part.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, join_hot, saved

FILTERS = "ABCDE"
#: What a step counts, each weighted by the cell's documents.
COUNTS = ("kept", "removed", "redundant", "good_lost", "toxic_lost")
#: Documents of a cell: all, labelled good, labelled toxic.
WEIGHTS = ("n", "n_good", "n_toxic")


def own_failures(text: Column) -> list[Column]:
    """Filters A to D, which look at one text."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return [
        F.size(words) < 200,
        100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        100 * capitals > 3 * F.length(text),
        text.rlike("[#$%&*|]"),
    ]


def failures(docs: DataFrame, part_col: str = "lang") -> DataFrame:
    """doc_id, part and fails, an array of booleans in the filters' order."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.array(*own_failures(text)).alias("own"),
    )
    # Texts are read and hashed once; from here on a document is its digest.
    rows = saved(rows)
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    first = first.filter("copies > 1 and first is not null").drop("copies")
    rows = join_hot(rows, first, ["digest"], "left")
    again = F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False))
    return rows.select("doc_id", "part", F.concat("own", F.array(again)).alias("fails"))


def cells(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """part, fails and the documents they hold, all, good and toxic."""
    known = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    rows = join_hot(rows, known, ["doc_id"], "left")
    return rows.groupBy("part", "fails").agg(
        F.count("*").alias("n"), F.count_if("good").alias("n_good"), F.count_if("toxic").alias("n_toxic")
    )


def orders_array(filters: str = FILTERS) -> Column:
    """Every order as an array of the filters' places; the same constant in all tasks."""
    return F.array(*(F.array(*map(F.lit, p)) for p in permutations(range(len(filters)))))


def over_order(order: Column) -> Column:
    """What the cell's documents (fails and the weights, columns) meet in one order: a struct a step."""

    def step(state: Column, place: Column) -> Column:
        fails = F.get(F.col("fails"), place)
        gone, hit = state["gone"], fails & ~state["gone"]

        def weighted(condition: Column, weight: str) -> Column:
            return F.when(condition, F.col(weight)).otherwise(F.lit(0).cast("long"))

        now = F.struct(
            place.alias("place"),
            weighted(~gone & ~fails, "n").alias("kept"),
            weighted(hit, "n").alias("removed"),
            weighted(gone & fails, "n").alias("redundant"),
            weighted(hit, "n_good").alias("good_lost"),
            weighted(hit, "n_toxic").alias("toxic_lost"),
        )
        return F.struct((gone | fails).alias("gone"), F.concat(state["steps"], F.array(now)).alias("steps"))

    kind = "array<struct<place:int," + ",".join(f"{c}:bigint" for c in COUNTS) + ">>"
    start = F.struct(F.lit(False).alias("gone"), F.array().cast(kind).alias("steps"))
    return F.aggregate(order, start, step, lambda state: state["steps"])


def add(left: Column, right: Column) -> Column:
    """Element by element: the steps of two cells, which stand in the same places."""
    return F.zip_with(
        left, right, lambda a, b: F.struct(a["place"].alias("place"), *((a[c] + b[c]).alias(c) for c in COUNTS))
    )


def audit(docs: DataFrame, labels: DataFrame, part_col: str = "lang") -> DataFrame:
    """One row per part, filter order and step: part, filter_order, step and the counts."""
    folded = cells(failures(docs, part_col), labels)
    folded = folded.withColumn("steps", F.flatten(F.transform(orders_array(), over_order)))
    # A cell fails one filter only: what no other filter would remove.
    alone = F.aggregate("fails", F.lit(0), lambda total, x: total + x.cast("int")) == 1
    place = F.array_position("fails", True).cast("int") - 1
    # A part has 32 cells at most, so what is collected here is bounded.
    parts = folded.groupBy("part").agg(
        F.collect_list("steps").alias("cells"),
        *(F.coalesce(F.sum(F.when(alone & (place == i), F.col("n"))), F.lit(0).cast("long")).alias(f"alone_{i}")
          for i in range(len(FILTERS))),
    )
    summed = F.aggregate(F.slice("cells", 2, 2 ** len(FILTERS)), F.get("cells", F.lit(0)), add)
    parts = parts.select("part", summed.alias("steps"), F.array(*(f"alone_{i}" for i in range(len(FILTERS)))).alias("alone"))

    def all_orders(i: Column) -> Column:
        mine = F.filter("steps", lambda s: s["place"] == i)
        return F.aggregate(mine, F.lit(0).cast("long"), lambda total, s: total + s["removed"])

    parts = parts.withColumn("shapley", F.transform(F.array(*map(F.lit, range(len(FILTERS)))), all_orders))
    rows = parts.select("part", "alone", "shapley", F.posexplode("steps").alias("at", "s"))
    names = F.array(*(F.lit("".join(p)) for p in permutations(FILTERS)))
    width = len(FILTERS)
    return rows.select(
        "part",
        F.get(names, F.floor(F.col("at") / width).cast("int")).alias("filter_order"),
        (F.col("at") % width + 1).cast("int").alias("step"),
        "s.kept", "s.removed", "s.redundant",
        F.get("alone", F.col("s.place")).alias("unique_fails"),
        "s.good_lost", "s.toxic_lost",
        F.get("shapley", F.col("s.place")).alias("shapley"),
    )
