"""Derived values a map or report shows: shares, colour classes, labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from trafficloom.functions.roads import lookup
from trafficloom.functions.values import empty_to_null

# --- fixed values -----------------------------------------------------------------------
DTV_STOPS = (0, 3000, 8000, 15000, 25000, 40000, 60000)
SHARE_STOPS = (0, 5, 10, 15, 20, 25, 30)
DTV_LABELS = ("0", "3 000", "8 000", "15 000", "25 000", "40 000", "60 000+")
SHARE_LABELS = ("0", "5", "10", "15", "20", "25", "30+")
STANDARD = ("#1a9850", "#66bd63", "#d9ef8b", "#fee08b", "#fdae61", "#f46d43", "#d73027")
ACCESSIBLE = ("#4575b4", "#91bfdb", "#e0f3f8", "#ffffbf", "#fee090", "#fc8d59", "#d73027")
NO_DATA = "#b4b4b4"
NO_DATA_LABEL = "keine Angabe"
CLASS_TEXT = {
    "A": "Autobahn",
    "B": "Bundesstraße",
    "L": "Landesstraße",
    "K": "Kreisstraße",
    "G": "Gemeinde-/Stadtstraße",
}
METRIC_TITLE = {
    "DTV": "Durchschnittliche tägliche Verkehrsstärke (Kfz/24h, alle Tage)",
    "DTVw": "Durchschnittliche tägliche Verkehrsstärke werktags (Mo–Fr)",
    "DTV≈": "Näherung aus Jahresmenge: Kfz/Jahr ÷ 365",
    "24h": "Einzelzählung über 24 h an einem Werktag (Di/Do) – kein Jahresmittel wie DTV",
}
METRIC_LABEL = {"24h": "24h-Zählung"}
FEDERAL_LABEL = "BASt"
# ----------------------------------------------------------------------------------------


def heavy_share(kfz: Column, sv: Column, share: Column) -> Column:
    """Share used for colouring: the stated one first, else counted over total."""
    return F.coalesce(share, F.when(kfz > 0, sv / kfz * 100.0))


def popup_share(kfz: Column, sv: Column, share: Column) -> Column:
    """Share shown beside the numbers: counted first (one decimal), else the stated one."""
    counted = F.when(kfz != 0, F.round(sv / kfz * 100.0, 1))
    return F.when(sv.isNotNull(), counted).otherwise(share)


def legend_label(value: Column, stops: Sequence[float], labels: Sequence[str]) -> Column:
    out = F.when(value.isNull(), F.lit(NO_DATA_LABEL))
    for stop, label in zip(stops[1:], labels):
        out = out.when(value < stop, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def ramp_colour(value: Column, stops: Sequence[float], colours: Sequence[str]) -> Column:
    """Colour between two stops, mixed per channel; clamped at both ends; grey without value.

    One branch per pair of neighbouring stops, so a row evaluates a single mix.
    """

    def mix(i: int) -> Column:
        share = (value - F.lit(float(stops[i]))) / F.lit(float(stops[i + 1] - stops[i]))
        parts = [F.lit("#")]
        for at in (1, 3, 5):
            low, high = (int(colours[j][at : at + 2], 16) for j in (i, i + 1))
            level = F.floor(F.lit(float(low)) + F.lit(float(high - low)) * share + 0.5)
            parts.append(F.lower(F.lpad(F.hex(level.cast("bigint")), 2, "0")))
        return F.concat(*parts)

    out = F.when(value.isNull(), F.lit(NO_DATA)).when(value < stops[0], F.lit(colours[0]))
    for i in range(len(stops) - 1):
        out = out.when(value < stops[i + 1], mix(i))
    return out.otherwise(F.lit(colours[-1]))


def daily_from_annual(flow: Column) -> Column:
    return flow / 365.0


def shown_daily(flow: Column) -> Column:
    """Daily equivalent as shown: halves go up."""
    return F.floor(daily_from_annual(flow) + 0.5).cast("bigint")


def class_text(road_class: Column) -> Column:
    return F.coalesce(lookup(CLASS_TEXT, road_class), F.concat(F.lit("Klasse "), road_class))


def title(name: Column, road_no: Column, road_class: Column) -> Column:
    """Name, else road number, else class; an empty text counts as missing."""
    return F.coalesce(
        empty_to_null(name), empty_to_null(road_no), F.concat(road_class, F.lit("-Straße"))
    )


def class_line(name: Column, road_no: Column, road_class: Column) -> Column:
    both = empty_to_null(name).isNotNull() & empty_to_null(road_no).isNotNull()
    text = class_text(road_class)
    return F.when(both, F.concat(text, F.lit(" "), road_no)).otherwise(text)


def provider(level: Column, source_name: Column, source_state: Column, state: Column) -> Column:
    """Municipality with its state, the federal agency, or the state code."""
    town = F.concat(source_name, F.lit(" ("), source_state, F.lit(")"))
    federal = F.coalesce((level == "bund") | (state == "DE"), F.lit(False))
    return F.when(level == "kommune", town).when(federal, FEDERAL_LABEL).otherwise(state)


def metric_label(metric: Column) -> Column:
    return F.coalesce(lookup(METRIC_LABEL, metric), metric)


def metric_title(metric: Column) -> Column:
    return F.coalesce(lookup(METRIC_TITLE, metric), F.lit(""))
