"""State and federal sources. Each plan takes its landed layers by name and stays lazy."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficloom import catalogue_data
from trafficloom.functions import roads
from trafficloom.functions import values as v
from trafficloom.model import ORDINAL
from trafficloom.operators.canonical import Spec, points_from_xy, to_canonical
from trafficloom.operators.keyed import attach_first, join_node_pairs
from trafficloom.operators.tiles import combine

Layers = Mapping[str, DataFrame]

# --- fixed values: landed layers, their columns and reference systems -------------------
BAVARIA = {"DTV_Kfz": "dtv_kfz", "DTV_SV": "dtv_sv", "Straße": "road_no", "Zählstelle": "station_id"}
BERLIN = {"dtvw_kfz": "dtv_kfz", "dtv_sv": "dtv_sv", "str_bez": "road_no", "link_id": "station_id"}
BRANDENBURG = {
    "KFZ": "dtv_kfz", "DTV_SV": "dtv_sv", "SV_KFZ": "sv_anteil", "strasse": "road_no",
    "zaehlstellennummer": "station_id",
}
HAMBURG = {"dtv": "dtv_kfz", "sv": "sv_anteil", "id": "station_id"}
LOWER_SAXONY = {"dtv21": "dtv_kfz", "dtvsv21": "dtv_sv", "strbez": "road_no", "zstnr": "station_id"}
NORTH_RHINE = {"DTVKFZA": "dtv_kfz", "DTVSVA": "dtv_sv", "STRBEZ": "road_no", "ZSTNR": "station_id"}
SAXONY = {
    "dtv_kfzges": "dtv_kfz", "dtv_sv": "dtv_sv", "sv_kfz": "sv_anteil", "strasse": "road_no",
    "nummer": "station_id",
}
FEDERAL_COLUMNS = {"DTV": "dtv_kfz", "DTVSV": "dtv_sv", "Str": "road_no", "TKZST": "station_id"}
THURINGIA = {"str_name": "road_no", "zst_nr": "station_id"}
BADEN = {"DTV2024": "dtv_kfz", "DTVSV": "dtv_sv", "svznr": "station_id", "road_no": "road_no"}

THURINGIA_KEY = ("zst_nr", "von_stat", "bis_stat")
NETWORK_LAYERS = ("bab", "b", "l", "k")
# ----------------------------------------------------------------------------------------


def spec(code: str, columns: Mapping[str, str], **more) -> Spec:
    """Mapping of one catalogued source; its constants come from the catalogue."""
    s = catalogue_data.listed(code)
    more.setdefault("year", s.year if "year_from" not in more else None)
    return Spec(
        columns, metric=s.metric, state=s.state, source=code, license=s.license,
        levels=catalogue_data.levels(), **more,
    )


def by(layers: Layers) -> DataFrame:
    rule = roads.class_by_code(roads.CODES_BAVARIA, "L")
    return to_canonical(
        layers["sections"],
        spec("by", BAVARIA, road_class_from="Straßenklasse", road_class_map=rule, srid=4326),
    )


def be(layers: Layers) -> DataFrame:
    """Total counts with the truck layer attached by segment."""
    trucks = layers["trucks"].withColumnRenamed("dtvw_lkw", "dtv_sv")
    both = attach_first(layers["sections"], trucks, ["link_id"], ["dtv_sv"])
    both = both.withColumn("str_bez", v.empty_to_null(F.col("str_bez")))
    rule = roads.class_by_code(roads.CODES_ABLKG, "G", trimmed=False)
    return to_canonical(
        both, spec("be", BERLIN, road_class_from="strklasse", road_class_map=rule, srid=4326)
    )


def bb(layers: Layers) -> DataFrame:
    rule = roads.class_by_code(roads.CODES_ABLK, "L")
    return to_canonical(
        layers["sections"],
        spec("bb", BRANDENBURG, road_class_from="klasse", road_class_map=rule, srid=25833),
    )


def hh(layers: Layers) -> DataFrame:
    """Main roads and motorways, two layers of one shape."""
    rule = roads.class_by_code(roads.CODES_HAMBURG, "B")
    return to_canonical(
        combine([layers["main_roads"], layers["motorways"]]),
        spec("hh", HAMBURG, road_class_from="strassenklasse", road_class_map=rule),
    )


def ni(layers: Layers) -> DataFrame:
    rule = roads.class_by_code(roads.CODES_ABLKG, "L")
    return to_canonical(
        layers["sections"],
        spec("ni", LOWER_SAXONY, road_class_from="strkl", road_class_map=rule, srid=25832),
    )


def nw(layers: Layers) -> DataFrame:
    """Four kinds of day are landed; the all-days columns count."""
    rule = roads.class_by_code(roads.CODES_ABLK, "L")
    return to_canonical(
        layers["sections"],
        spec("nw", NORTH_RHINE, road_class_from="STRKL", road_class_map=rule, srid=25832),
    )


def sn(layers: Layers) -> DataFrame:
    rule = roads.class_by_code(roads.CODES_SAXONY, "L")
    return to_canonical(
        layers["sections"],
        spec("sn", SAXONY, road_class_from="klasse", road_class_map=rule, srid=25833),
    )


def st(layers: Layers) -> DataFrame:
    """Road network joined with the count sheet by start and end node.

    A node pair that several layers hold counts in the layer of the highest class.
    """
    net = combine(
        [
            layers[f"net_{c}"].withColumn(
                ORDINAL, F.struct(F.lit(at).alias("layer"), F.col(ORDINAL).alias("place"))
            )
            for at, c in enumerate(NETWORK_LAYERS)
        ]
    )
    joined = join_node_pairs(
        net, layers["values"], ("vnk", "nnk"), ("VonNK", "NachNK"),
        ["Str", "TKZST", "DTV", "DTVSV"],
    )
    rule = roads.class_by_first_letter("ABLK", "L")
    return to_canonical(
        joined,
        spec("st", FEDERAL_COLUMNS, road_class_from="Str", road_class_map=rule, srid=25832),
    )


def th(layers: Layers) -> DataFrame:
    """Counting sections with the value layer attached by station and chainage."""
    joined = attach_first(
        layers["sections"], layers["values"], list(THURINGIA_KEY), ["dtv_kfz", "dtv_sv"]
    )
    rule = roads.class_by_code(roads.CODES_ABLK, "L")
    return to_canonical(
        joined,
        spec("th", THURINGIA, road_class_from="str_klasse", road_class_map=rule, srid=25832),
    )


def bw(layers: Layers) -> DataFrame:
    """Station list with coordinates; the road number comes in two columns."""
    points = points_from_xy(layers["stations"], "gpsx1", "gpsy1")
    points = points.withColumn("road_no", roads.numbered(F.col("klasse"), F.col("nummer")))
    rule = roads.class_by_code(roads.CODES_ABLK, "L")
    return to_canonical(
        points, spec("bw", BADEN, road_class_from="klasse", road_class_map=rule, srid=4326)
    )


def sl(layers: Layers) -> DataFrame:
    rule = roads.class_by_first_letter("ABLK", "L")
    return to_canonical(
        layers["stations"],
        spec("sl", FEDERAL_COLUMNS, road_class_from="Str", road_class_map=rule, srid=4326),
    )


def bast(layers: Layers) -> DataFrame:
    """Motorway and federal road sheets; stations without coordinates drop out."""
    sheets = combine([layers["motorways"], layers["federal_roads"]])
    points = points_from_xy(sheets, "X_Koordinate", "Y_Koordinate", 25832)
    rule = roads.class_by_first_letter("AB", "A")
    return to_canonical(
        points,
        spec("bast", FEDERAL_COLUMNS, road_class_from="Str", road_class_map=rule, srid=4326),
    )
