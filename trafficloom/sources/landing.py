"""Which landed layers each source has and how they are read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trafficloom.sources import readers
from trafficloom.sources.registry import STATION_TOWNS, is_station_town
from trafficloom.sources.states import NETWORK_LAYERS, THURINGIA_KEY

Reader = Callable[[SparkSession, str], DataFrame]


def geojson(*properties: str, **options) -> Reader:
    """A layer of documents of any size, read in pieces."""
    return lambda spark, path: readers.read_geojson(spark, path, properties, split=True, **options)


def paged(*properties: str, **options) -> Reader:
    return lambda spark, path: readers.read_paged(spark, path, properties, **options)


def gml(row_tag: str, *fields: str, **options) -> Reader:
    return lambda spark, path: readers.read_gml(spark, path, row_tag, fields, **options)


def sheet(name: str | int = "Zeilenformat") -> Reader:
    return lambda spark, path: readers.read_sheet(spark, path, name)


def table() -> Reader:
    return lambda spark, path: readers.read_table(spark, path)


# --- fixed values: landed column names and reference systems ----------------------------
_DUESSELDORF = geojson(
    "_uuid", "strasse", "belastung_gesamt_5j", "zeitraum_5j", "belastung_gesamt_10j",
    "zeitraum_10j",
)
_FRANKFURT = geojson("str_nr", "mittl_bel", "str_name", "zaehldatum", "zp_nr")
LAYERS: dict[str, dict[str, Reader]] = {
    "by": {"sections": geojson("Straßenklasse", "Straße", "Zählstelle", "DTV_Kfz", "DTV_SV")},
    "be": {
        "sections": geojson("link_id", "strklasse", "str_bez", "str_name", "dtvw_kfz"),
        "trucks": geojson("link_id", "dtvw_lkw"),
    },
    "bb": {
        "sections": gml(
            "verkehrsstaerke_2021", "klasse", "strasse", "zaehlstellennummer", "KFZ", "DTV_SV",
            "SV_KFZ", srid=25833,
        )
    },
    "hh": {
        "main_roads": geojson("id", "dtv", "sv", "strassenklasse"),
        "motorways": geojson("id", "dtv", "sv", "strassenklasse"),
    },
    "ni": {"sections": geojson("strkl", "strbez", "zstnr", "dtv21", "dtvsv21", srid=25832)},
    "nw": {
        "sections": geojson(
            "STRKL", "STRBEZ", "STRNR", "ZSTNR", "DTVKFZA", "DTVKFZW", "DTVSVA", srid=25832
        )
    },
    "sn": {
        "sections": geojson(
            "klasse", "strasse", "nummer", "dtv_kfzges", "dtv_sv", "sv_kfz", srid=25833
        )
    },
    "st": {
        **{
            f"net_{c}": gml(f"lsa_lbbau_{c}_feature", "vnk", "nnk", srid=25832)
            for c in NETWORK_LAYERS
        },
        "values": sheet(),
    },
    "th": {
        "sections": gml("SVZ2015_ZstBer", *THURINGIA_KEY, "str_name", "str_klasse", srid=25832),
        "values": gml("SVZ2015_VMenge", *THURINGIA_KEY, "dtv_kfz", "dtv_sv", geometry=None),
    },
    "bw": {"stations": table()},
    "sl": {"stations": geojson("Str", "TKZST", "DTV", "DTVSV")},
    "bast": {"motorways": sheet(), "federal_roads": sheet()},
    "koeln": {
        "edges": geojson(
            "NO", "STR_NAME",
            *[f"K_{y}_24H" for y in range(2016, 2020)],
            *[f"R_K_{y}_24H" for y in range(2016, 2020)],
            srid=31466, member="*link*",
        )
    },
    "duesseldorf": {
        name: _DUESSELDORF for name in ("sections", "trucks_single", "trucks_trailer", "buses")
    },
    "frankfurt": {
        name: _FRANKFURT for name in ("sections", "trucks_trailer", "trucks_single")
    },
    **{code: {"sheet": sheet(0)} for code in STATION_TOWNS},
}
# ----------------------------------------------------------------------------------------


def landed_layers(spark: SparkSession, landing: str, code: str) -> dict[str, DataFrame]:
    layers = LAYERS.get(code) or ({"sheet": sheet(0)} if is_station_town(code) else LAYERS[code])
    return {name: reader(spark, f"{landing}/{code}/{name}") for name, reader in layers.items()}
