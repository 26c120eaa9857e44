"""Bringing all sources together and sorting them into level x geometry groups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficloom.catalogue_data import FEDERAL_GROUP, GROUP_PREFIX
from trafficloom.functions.geometry import is_point
from trafficloom.functions.roads import lookup
from trafficloom.operators.canonical import canonical_columns, normalize_counts

def backfill(df: DataFrame, levels: Mapping[str, str]) -> DataFrame:
    """Bring an older table up to the contract: level by source, empty name, clean counts."""
    known = lookup(levels, F.col("source"))
    level = F.coalesce(F.col("level"), known) if "level" in df.columns else known
    name = F.col("name") if "name" in df.columns else F.lit(None).cast(T.StringType())
    return canonical_columns(normalize_counts(df.withColumns({"level": level, "name": name})))


def group_name(level: Column, points: Column) -> Column:
    shape = F.when(points, F.lit("points")).otherwise(F.lit("lines"))
    return F.when(level == "bund", F.lit(FEDERAL_GROUP)).otherwise(
        F.concat(lookup(GROUP_PREFIX, level), shape)
    )


def source_groups(features: DataFrame) -> DataFrame:
    """Group of every source, by its own rows: listed or not, each gets one.

    A source goes as a whole: to the points only if each of its geometries is one.
    """
    # The level is a key of the large aggregate: a text cannot be updated in place in a hash
    # aggregate's buffer, and Spark would sort all features instead.
    per_level = features.groupBy("source", "level").agg(
        F.bool_and(is_point(F.col("geometry"))).alias("points")
    )
    kinds = per_level.groupBy("source").agg(
        F.bool_and("points").alias("points"), F.min("level").alias("level")
    )
    return kinds.select("source", group_name(F.col("level"), F.col("points")).alias("group"))


def route(features: DataFrame) -> DataFrame:
    """Add ``group``. Both sides of the join are exchanged unless the table of sources turns out
    small, so a source with a large share of the features can be split."""
    groups = source_groups(features).withColumnRenamed("source", "_source")
    return features.join(
        groups, features["source"].eqNullSafe(groups["_source"]), "left"
    ).select(*features.columns, "group")


def summary(features: DataFrame) -> DataFrame:
    """Sources and features per group of a table that has not been routed: counts per source and
    level are enough, so no feature is joined or shuffled."""
    per_level = features.groupBy("source", "level").agg(
        F.bool_and(is_point(F.col("geometry"))).alias("points"), F.count("*").alias("n")
    )
    kinds = per_level.groupBy("source").agg(
        F.bool_and("points").alias("points"), F.min("level").alias("level"), F.sum("n").alias("n")
    )
    named = kinds.withColumn("group", group_name(F.col("level"), F.col("points")))
    return named.groupBy("group").agg(
        F.count("source").cast("bigint").alias("sources"), F.sum("n").cast("bigint").alias("features")
    )


def group_summary(routed: DataFrame) -> DataFrame:
    """Sources and features per group, counted per source first."""
    return (
        routed.groupBy("group", "source")
        .agg(F.count("*").alias("n"))
        .groupBy("group")
        .agg(
            F.count("source").cast("bigint").alias("sources"),
            F.sum("n").cast("bigint").alias("features"),
        )
    )
