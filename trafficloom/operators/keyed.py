"""Joins and picks by key.

Two rules keep a key that holds a large share of all rows harmless:

* one row per key is picked by an aggregate (``min_by``/``max_by``), never by sorting the
  whole group in one task: each map task sends at most one row per key;
* the attached side has one row per key, and the join condition is null-safe or has a hash of its
  own, so it never reuses the aggregate's partitioning. Both inputs are freshly exchanged, which is
  the shape adaptive execution splits when one join partition is too large. No side is hinted:
  adaptive execution broadcasts it only when its measured size allows.

A left join whose columns nobody reads is left out of the plan, with the pick before it, see
``attach_one``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficloom.functions import geometry as geo
from trafficloom.functions import values as v
from trafficloom.functions.roads import node_text
from trafficloom.model import ORDINAL


def input_order(df: DataFrame) -> Column:
    """The landed row's place where known, else a total order over all columns."""
    return F.col(ORDINAL) if ORDINAL in df.columns else F.struct(*df.columns)


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Column | None = None
) -> DataFrame:
    """First row of every key; null keys form one group like any other."""
    order = input_order(df) if order is None else order
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest])


def pick_first(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Column
) -> DataFrame:
    """Key and chosen columns of the first row per key; the order is not carried along."""
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*columns), order).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in columns])


def last_per_key(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest])


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    return reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(right[prefix + k]) for k in keys]
    )


def attach(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join on equal or both-missing keys and keep the left side's key columns."""
    other = right.select(
        *[F.col(f"`{k}`").alias("_r_" + k) for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    joined = left.join(other, null_safe(left, other, keys, "_r_"), how)
    return joined.drop(*["_r_" + k for k in keys])


def one_per_key(df: DataFrame, keys: Sequence[str], *picks: Column) -> DataFrame:
    """Picks per key, for ``attach_one``: the key is one value, beside a hash that sorting and
    partitioning compare first."""
    return df.groupBy(F.xxhash64(*keys).alias("_r_hash"), F.struct(*keys).alias("_r_key")).agg(*picks)


def attach_one(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join with a table of ``one_per_key``, on equal or both-missing keys.

    Structs are equal where the same parts are missing, so the aggregate's own columns are compared
    and Spark knows that they are unique: it drops the join if nothing else of the right side is
    used. The second hash keeps the join from reusing the aggregate's partitioning.
    """
    key = F.struct(*[left[k] for k in keys])
    same = F.xxhash64(*[left[k] for k in keys]) == right["_r_hash"]
    same = same & (key == right["_r_key"]) & (F.hash(key) == F.hash(right["_r_key"]))
    return left.join(right, same, "left").drop("_r_hash", "_r_key")


def same_types(a: DataFrame, b: DataFrame, names: Sequence[str]) -> bool:
    """Whether the columns hash alike."""
    return all(a.schema[n].dataType.simpleString() == b.schema[n].dataType.simpleString() for n in names)


def attach_first(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    order: Column | None = None,
) -> DataFrame:
    """Left join with the first right row per key; the number of left rows stays."""
    order = input_order(right) if order is None else order
    if not same_types(left, right, keys):
        return attach(left, pick_first(right, keys, columns, order), keys)
    picked = one_per_key(right, keys, F.min_by(F.struct(*columns), order).alias("_row"))
    cells = [F.col(f"_row.`{c}`").alias(c) for c in columns]
    return attach_one(left, picked.select("_r_hash", "_r_key", *cells), keys)


def join_stations(values: DataFrame, stations: DataFrame, key: str) -> DataFrame:
    """Give every value row its station's geometry; rows without a station drop out."""
    return attach(values, stations.select(key, "geometry"), [key], "inner")


def join_node_pairs(
    net: DataFrame,
    values: DataFrame,
    net_nodes: tuple[str, str],
    value_nodes: tuple[str, str],
    columns: Sequence[str],
) -> DataFrame:
    """Network sections and value rows that share their start and end node.

    Only sections that meet a value are picked from: most of a network has none.
    """

    def keyed(df: DataFrame, nodes: tuple[str, str], keep: Sequence[str]) -> DataFrame:
        order = input_order(df)
        # As columns the numbers are read once; a key names each of them many times.
        numbers = {f"_node{i}": v.parse_number(F.col(n).cast("string")) for i, n in enumerate(nodes)}
        key = F.concat_ws("_", *[node_text(F.col(n)) for n in numbers])
        return df.withColumn("_pick", order).withColumns(numbers).select(key.alias("_key"), "_pick", *keep)

    found = pick_first(keyed(values, value_nodes, columns), ["_key"], columns, F.col("_pick"))
    both = attach(keyed(net, net_nodes, ["geometry"]), found, ["_key"], "inner")
    # A value's cells are the same beside all sections of its key.
    cells = [F.any_value(F.col(f"`{c}`")).alias(c) for c in columns]
    return both.groupBy("_key").agg(F.min_by("geometry", "_pick").alias("geometry"), *cells).drop("_key")


def sum_layers(
    base: DataFrame,
    layers: Mapping[str, DataFrame],
    keys: Sequence[str],
    value: str,
    out: str,
) -> DataFrame:
    """Add ``out``: the sum over all layers of each layer's first value for the row's key.

    A layer without the key or without a value there adds nothing; with no value in any layer
    the sum is null. All layers go through one aggregate and one join.
    """
    tagged = reduce(
        DataFrame.unionByName,
        [
            df.select(
                *keys,
                F.col(value).cast("double").alias("_value"),
                input_order(df).alias("_pick"),
                F.lit(name).alias("_layer"),
            )
            for name, df in layers.items()
        ],
    )
    first = [
        F.min_by(
            F.when(F.col("_layer") == name, F.col("_value")),
            F.when(F.col("_layer") == name, F.col("_pick")),
        )
        for name in layers
    ]
    names = [f"_first{i}" for i in range(len(first))]
    firsts = [c.alias(n) for c, n in zip(first, names)]
    zero = F.lit(0.0)
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(n), zero) for n in names])
    known = F.coalesce(*[F.col(n) for n in names]).isNotNull()
    summed = F.when(known, total).alias(out)
    if not same_types(base, tagged, keys):
        return attach(base, tagged.groupBy(*keys).agg(*firsts).select(*keys, summed), keys)
    per_key = one_per_key(tagged, keys, *firsts).select("_r_hash", "_r_key", summed)
    return attach_one(base, per_key, keys)


def sum_layers_by_shape(
    base: DataFrame, layers: Mapping[str, DataFrame], value: str, out: str
) -> DataFrame:
    """``sum_layers`` keyed by the exact geometry.

    A short hash travels with the shape, so sorting and partitioning compare one number first;
    the shape itself is still compared, so equal hashes of different shapes do not meet.
    """
    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumns(
            {"_hash": geo.shape_hash(F.col("geometry")), "_shape": F.col("geometry.parts")}
        )

    wide = sum_layers(
        keyed(base), {n: keyed(df) for n, df in layers.items()}, ["_hash", "_shape"], value, out
    )
    return wide.drop("_hash", "_shape")
