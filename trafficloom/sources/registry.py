"""Plan of every live source."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame

from trafficloom import catalogue_data
from trafficloom.sources import municipal, states
from trafficloom.sources.states import Layers

Plan = Callable[[Layers], DataFrame]

STATION_TOWNS = ("ravensburg", "weingarten", "berg", "baienfurt", "baindt")

PLANS: dict[str, Plan] = {
    "by": states.by,
    "be": states.be,
    "bb": states.bb,
    "hh": states.hh,
    "ni": states.ni,
    "nw": states.nw,
    "sn": states.sn,
    "st": states.st,
    "th": states.th,
    "bw": states.bw,
    "sl": states.sl,
    "bast": states.bast,
    "koeln": municipal.koeln,
    "duesseldorf": municipal.duesseldorf,
    "frankfurt": municipal.frankfurt,
    **{code: partial(municipal.stations, code) for code in STATION_TOWNS},
}


def is_station_town(code: str) -> bool:
    """A town whose counts come as one station sheet: those known, and any other that a catalogue
    lists as a spreadsheet of a municipality."""
    if code in PLANS:
        return code in STATION_TOWNS
    source = catalogue_data.listed(code)
    return source.level == "kommune" and source.kind == "xlsx"


def plan_for(code: str) -> Plan:
    if code not in PLANS and is_station_town(code):
        return partial(municipal.stations, code)
    return PLANS[code]
