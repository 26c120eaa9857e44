"""Municipal sources: own counts of the towns, with the year and often the road in each row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficloom import catalogue_data
from trafficloom.functions import roads
from trafficloom.functions import values as v
from trafficloom.operators import reshape
from trafficloom.operators.canonical import points_from_xy, to_canonical
from trafficloom.operators.keyed import sum_layers, sum_layers_by_shape
from trafficloom.sources.states import Layers, spec

# --- fixed values: landed columns --------------------------------------------------------
COLOGNE = {"dtv_kfz": "dtv_kfz", "NO": "station_id", "STR_NAME": "name"}
DUESSELDORF = {
    "dtv_kfz": "dtv_kfz", "dtv_sv": "dtv_sv", "strasse": "name", "road_no": "road_no",
    "_uuid": "station_id",
}
FRANKFURT = {
    "mittl_bel": "dtv_kfz", "dtv_sv": "dtv_sv", "str_name": "name", "road_no": "road_no",
    "station_id": "station_id",
}
STATIONS = {
    "kfz": "dtv_kfz", "sv": "dtv_sv", "ID": "station_id", "name": "name", "road_no": "road_no",
}
DUESSELDORF_HEAVY = ("trucks_single", "trucks_trailer", "buses")
FRANKFURT_HEAVY = ("trucks_trailer", "trucks_single")
# ----------------------------------------------------------------------------------------


def koeln(layers: Layers) -> DataFrame:
    """Network edges with a value per direction and year; edges without any value drop out."""
    edges = reshape.pick_direction_year(layers["edges"])
    edges = edges.withColumn("NO", v.id_text(F.col("NO")))
    return to_canonical(
        edges, spec("koeln", COLOGNE, year_from="year", road_class="G", srid=31466)
    )


def _period_values(df: DataFrame) -> DataFrame:
    value, year = reshape.five_or_ten(df, "belastung_gesamt", "zeitraum")
    return df.withColumns({"_value": value, "year": year})


def duesseldorf(layers: Layers) -> DataFrame:
    """Sections of one layer per vehicle kind that share shapes but not ids."""
    base = _period_values(layers["sections"]).withColumnRenamed("_value", "dtv_kfz")
    base = base.filter(F.col("dtv_kfz").isNotNull())
    heavy = {name: _period_values(layers[name]) for name in DUESSELDORF_HEAVY}
    road = roads.road_in_name(F.col("strasse"))
    joined = sum_layers_by_shape(base, heavy, "_value", "dtv_sv").withColumns(
        {"road_no": road.number, "klasse": road.road_class}
    )
    return to_canonical(
        joined,
        spec("duesseldorf", DUESSELDORF, year_from="year", road_class_from="klasse", srid=4326),
    )


def frankfurt(layers: Layers) -> DataFrame:
    """Sections with truck layers attached by section number; years follow the count date."""

    def numbered(df: DataFrame) -> DataFrame:
        section = v.number(df, "str_nr").try_cast("bigint")
        return df.withColumns({"str_nr": section, "_value": v.number(df, "mittl_bel")})

    sections = numbered(layers["sections"])
    base = sections.withColumns(
        {"mittl_bel": F.col("_value"), "year": v.year_of(F.col("zaehldatum"))}
    ).drop("_value").filter(F.col("mittl_bel").isNotNull() & F.col("year").isNotNull())
    heavy = {name: numbered(layers[name]) for name in FRANKFURT_HEAVY}
    road = roads.road_in_name(F.col("str_name"), roads.ROAD_IN_NAME_SUFFIX)
    joined = sum_layers(base, heavy, ["str_nr"], "_value", "dtv_sv").withColumns(
        {
            "road_no": road.number,
            "klasse": road.road_class,
            "station_id": v.id_text(F.col("str_nr")),
        }
    )
    return to_canonical(
        joined, spec("frankfurt", FRANKFURT, year_from="year", road_class_from="klasse")
    )


def stations(code: str, layers: Layers) -> DataFrame:
    """Station sheet with up to four counts each; the newest one counts. One plan, many towns."""
    newest = reshape.latest_count(reshape.blocks_to_long(layers["sheet"]))
    parsed = roads.station_name(F.col("NAME"), catalogue_data.listed(code).name)
    named = newest.withColumns(
        {
            "name": parsed.name,
            "road_no": parsed.number,
            "klasse": parsed.road_class,
            "year": F.year("datum"),
            "ID": v.id_text(F.col("ID")),
        }
    )
    points = points_from_xy(named, "LAENGENGRAD", "BREITENGRAD")
    return to_canonical(
        points, spec(code, STATIONS, year_from="year", road_class_from="klasse", srid=4326)
    )
