"""Feature-table views: source filter, popup fields, provider labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficloom.functions import tiling, view


def active_sources(features: DataFrame, codes: Sequence[str]) -> DataFrame:
    """Features of the chosen sources; prunes partitions of a table split by source."""
    return features.filter(F.col("source").isin(*codes))


def visible_at(features: DataFrame, zoom: float) -> DataFrame:
    return features.filter(tiling.on_ladder(F.lit(float(zoom)), F.col("dtv_kfz")))


def with_shares(features: DataFrame) -> DataFrame:
    parts = (F.col("dtv_kfz"), F.col("dtv_sv"), F.col("sv_anteil"))
    return features.withColumns(
        {"heavy_share": view.heavy_share(*parts), "popup_share": view.popup_share(*parts)}
    )


def with_colours(features: DataFrame, accessible: bool = False) -> DataFrame:
    """Colour and legend class by daily count and by heavy share (needs ``heavy_share``)."""
    colours = view.ACCESSIBLE if accessible else view.STANDARD
    kfz, share = F.col("dtv_kfz"), F.col("heavy_share")
    return features.withColumns(
        {
            "dtv_colour": view.ramp_colour(kfz, view.DTV_STOPS, colours),
            "dtv_class": view.legend_label(kfz, view.DTV_STOPS, view.DTV_LABELS),
            "share_colour": view.ramp_colour(share, view.SHARE_STOPS, colours),
            "share_class": view.legend_label(share, view.SHARE_STOPS, view.SHARE_LABELS),
        }
    )


def with_provider(features: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Add ``provider``. The planner broadcasts the catalogue when its size allows."""
    lookup = catalogue.select(
        F.col("code").alias("_code"),
        F.col("level").alias("_level"),
        F.col("name").alias("_name"),
        F.col("state").alias("_state"),
    )
    joined = features.join(lookup, F.col("source") == F.col("_code"), "left")
    label = view.provider(F.col("_level"), F.col("_name"), F.col("_state"), F.col("state"))
    return joined.withColumn("provider", label).drop("_code", "_level", "_name", "_state")


def with_texts(features: DataFrame) -> DataFrame:
    name, no, kind = F.col("name"), F.col("road_no"), F.col("road_class")
    return features.withColumns(
        {
            "title": view.title(name, no, kind),
            "class_text": view.class_text(kind),
            "class_line": view.class_line(name, no, kind),
            "metric_label": view.metric_label(F.col("metric")),
            "metric_title": view.metric_title(F.col("metric")),
        }
    )
