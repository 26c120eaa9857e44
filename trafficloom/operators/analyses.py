"""Comparisons and reports over feature tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trafficloom.functions import view
from trafficloom.operators import chains
from trafficloom.operators.keyed import first_per_key


#: Ranges a group's values are counted in per round.
RANGES = 4096


def median(df: DataFrame, by: str, value: Column, out: str) -> DataFrame:
    """Exact median per group, by counting: no values are gathered or sorted.

    The span of a group's values is cut into ranges, the rows of each are counted, and only the
    range that holds the middle is looked at again, until it holds a single value or the middle lies
    between two ranges. A map task sends one row per group and range, so a group with most of the
    rows, all of them different, takes no longer than others. NaN counts as missing.
    """
    rows = df.select(F.col(by).alias("_g"), value.cast("double").alias("_v"))
    rows = chains.saved(rows.filter(F.col("_v").isNotNull() & ~F.isnan("_v")))
    # What is left of a group: its span, and the places of the two middle values among its rows.
    left = rows.groupBy("_g").agg(F.count("*").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    left = left.select(
        F.col("_g").alias("_of"), "lo", "hi", F.expr("(n - 1) div 2").alias("first"), F.expr("n div 2").alias("second")
    )
    left, known = chains.saved(left), None
    while True:
        near = F.col("_g").eqNullSafe(F.col("_of")) & F.col("_v").between(F.col("lo"), F.col("hi"))
        # Halves, so that the span of the largest doubles stays finite.
        lo, span = F.col("lo") / 2, F.col("hi") / 2 - F.col("lo") / 2
        at = F.when(span > 0, F.floor((F.col("_v") / 2 - lo) / span * RANGES)).otherwise(F.lit(0))
        counted = rows.join(left, near).groupBy("_of", "first", "second", at.alias("range")).agg(
            F.count("*").alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high")
        )
        upto = F.sum("n").over(Window.partitionBy("_of").orderBy("range"))
        placed = counted.withColumn("before", upto - F.col("n"))

        def holds(place: str) -> Column:
            return (F.col("before") <= F.col(place)) & (F.col(place) < F.col("before") + F.col("n"))

        found = placed.groupBy("_of").agg(
            *[F.max(F.when(holds("first"), F.col(c))).alias(f"a_{c}") for c in ("range", "low", "high")],
            *[F.max(F.when(holds("second"), F.col(c))).alias(f"b_{c}") for c in ("range", "low", "high")],
            F.max(F.when(holds("first"), F.col("first") - F.col("before"))).alias("first"),
            F.max(F.when(holds("second"), F.col("second") - F.col("before"))).alias("second"),
        )
        apart = F.col("a_range") != F.col("b_range")
        found = chains.saved(found.withColumn("done", apart | (F.col("a_low") == F.col("a_high"))))
        # Of two neighbouring ranges, the middle values are the last of one and the first of the other.
        middle = F.col("a_high") * 0.5 + F.col("b_low") * 0.5
        ready = found.filter("done").select(F.col("_of").alias(by), middle.alias(out))
        known = ready if known is None else known.unionByName(ready)
        left = found.filter("not done").select(
            "_of", F.col("a_low").alias("lo"), F.col("a_high").alias("hi"), "first", "second"
        )
        if left.isEmpty():
            return known


def sections_per_state(features: DataFrame, road_class: str) -> DataFrame:
    return (
        features.filter(F.col("road_class") == road_class)
        .groupBy("state")
        .agg(F.count("*").alias("sections"))
    )


def median_heavy_share(features: DataFrame) -> DataFrame:
    share = view.heavy_share(F.col("dtv_kfz"), F.col("dtv_sv"), F.col("sv_anteil"))
    return median(features, "source", share, "median_share")


def placeholder_zeros(raw: DataFrame, count: Column) -> DataFrame:
    """Rows per source whose stated count is the placeholder zero."""
    return raw.groupBy("source").agg(F.count_if(count == 0).alias("zeros"))


def outliers(features: DataFrame, bounds: Mapping[str, int]) -> DataFrame:
    """Counts above what their road class can carry."""
    limit = F.create_map(*[F.lit(t) for pair in bounds.items() for t in pair])
    return features.filter(F.col("dtv_kfz") > limit[F.col("road_class")])


def new_values(derived: DataFrame, known: DataFrame, key: str, value: str) -> DataFrame:
    """Rows of a derived table whose key and value are not both known already."""
    return derived.join(
        known.select(key, value),
        derived[key].eqNullSafe(known[key]) & derived[value].eqNullSafe(known[value]),
        "left_anti",
    )


def compare_releases(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """One row per key with its fate: common, moved, added or removed.

    Both tables need ``key``, ``x``, ``y`` and ``value``; a repeated key counts once.
    """
    a = first_per_key(old.select(key, "x", "y", "value"), [key])
    b = first_per_key(new.select(key, "x", "y", "value"), [key])
    a = a.select(F.col(key).alias("_k"), *[F.col(c).alias("old_" + c) for c in ("x", "y", "value")],
                 F.lit(True).alias("_old"))
    b = b.select(key, *[F.col(c).alias("new_" + c) for c in ("x", "y", "value")],
                 F.lit(True).alias("_new"))
    both = a.join(b, F.col("_k").eqNullSafe(F.col(key)), "full")
    moved = ~(
        F.col("old_x").eqNullSafe(F.col("new_x")) & F.col("old_y").eqNullSafe(F.col("new_y"))
    )
    fate = (
        F.when(F.col("_new").isNull(), "removed")
        .when(F.col("_old").isNull(), "added")
        .when(moved, "moved")
        .otherwise("common")
    )
    return both.select(
        F.coalesce(F.col(key), F.col("_k")).alias(key), fate.alias("fate"), "old_value", "new_value"
    )


def median_change(compared: DataFrame) -> DataFrame:
    """Median change in percent over the stations of both releases, per fate."""
    change = F.when(
        F.col("old_value") > 0,
        (F.col("new_value") - F.col("old_value")) / F.col("old_value") * 100.0,
    )
    return median(compared, "fate", change, "median_change")


def prefer_federal(features: DataFrame, classes=("A", "B")) -> DataFrame:
    """Motorways and federal roads only from the federal source, the rest from the others."""
    federal = F.col("level") == "bund"
    return features.filter(federal | ~F.col("road_class").isin(*classes))
