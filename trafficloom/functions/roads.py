"""Road classes, road numbers, node keys and station names."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from trafficloom.functions.values import parse_number, strip

# --- fixed values -----------------------------------------------------------------------
# Class codes as the sources write them; what is missing here takes the source's default.
CODES_ABLK = {"A": "A", "B": "B", "L": "L", "K": "K"}
CODES_ABLKG = {"A": "A", "B": "B", "L": "L", "K": "K", "G": "G"}
CODES_BAVARIA = {"A": "A", "B": "B", "St": "L", "K": "K"}
CODES_HAMBURG = {"BAB": "A", "HVS": "B"}
CODES_SAXONY = {"A": "A", "B": "B", "S": "L", "L": "L", "K": "K"}
# Road numbers inside a street name, without and with a letter suffix. (?U): Unicode classes.
ROAD_IN_NAME = r"(?U)\b([ABLK])\s?(\d{1,4})\b"
ROAD_IN_NAME_SUFFIX = r"(?U)\b([ABLK])\s?(\d{1,4}[a-z]?)\b"
# A whole name part that is a road number; a five-digit postcode; a year ending a period text.
ROAD_TOKEN = r"(?U)^([ABLK])\s?(\d+)$"
POSTCODE = r"(?U)^\d{5}$"
PERIOD_END = r"(?U)(\d{4})\s*$"
# ----------------------------------------------------------------------------------------


class ColumnRule:
    """Marks a rule that builds a Column, as opposed to a Python function per value."""

    def __init__(self, rule: Callable[[Column], Column]):
        self.rule = rule

    def __call__(self, c: Column) -> Column:
        return self.rule(c)


def lookup(mapping: Mapping[str, str], c: Column) -> Column:
    """Literal map lookup; unknown and null keys give null."""
    table = F.create_map(*[F.lit(v) for pair in mapping.items() for v in pair])
    return table[c]


def class_by_code(mapping: Mapping[str, str], default: str, trimmed: bool = True) -> ColumnRule:
    def rule(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(lookup(mapping, strip(text) if trimmed else text), F.lit(default))

    return ColumnRule(rule)


def class_by_first_letter(allowed: str, default: str) -> ColumnRule:
    def rule(c: Column) -> Column:
        letter = F.upper(F.substring(strip(c.cast("string")), 1, 1))
        return F.when(letter.isin(*allowed), letter).otherwise(F.lit(default))

    return ColumnRule(rule)


class Road(NamedTuple):
    number: Column
    road_class: Column


def road_in_name(c: Column, pattern: str = ROAD_IN_NAME) -> Road:
    """First road number in a street name (``A 46``) and its class; else null and ``G``."""
    letter = F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))
    digits = F.regexp_extract(c, pattern, 2)
    return Road(
        F.when(letter.isNotNull(), F.concat(letter, F.lit(" "), digits)),
        F.coalesce(letter, F.lit("G")),
    )


def period_end_year(c: Column) -> Column:
    return F.regexp_extract(c, PERIOD_END, 1).try_cast("int")


def node_key(c: Column) -> Column:
    """A network node number without its fraction (``4639027.0``); empty when unreadable."""
    return node_text(parse_number(c.cast("string")))


def node_text(x: Column) -> Column:
    """``node_key`` of a number that has been read."""
    cut = F.when(x < 0, F.ceil(x)).otherwise(F.floor(x))
    wide = x.try_cast("decimal(38,0)").cast("string")
    text = F.when(F.abs(x) < F.lit(9.0e18), cut.cast("string")).otherwise(wide)
    return F.coalesce(text, F.lit(""))


def node_pair(a: Column, b: Column) -> Column:
    return F.concat_ws("_", node_key(a), node_key(b))


def numbered(road_class: Column, number: Column) -> Column:
    """``L`` and ``508`` as ``L 508``; null when a part is missing."""
    return F.concat(strip(road_class), F.lit(" "), strip(number))


class Station(NamedTuple):
    name: Column
    number: Column
    road_class: Column


def station_name(raw: Column, city: str) -> Station:
    """``B32_Ulmerstraße_88212_Ravensburg`` as ``B 32 / Ulmerstraße``, ``B 32``, ``B``."""
    tokens = F.filter(
        F.transform(F.split(raw, "_"), strip),
        lambda t: (t != "") & ~t.rlike(POSTCODE) & (F.lower(t) != city.lower()),
    )
    compact = F.transform(tokens, lambda t: F.replace(t, F.lit(" "), F.lit("")))
    first = F.get(F.filter(compact, lambda t: t.rlike(ROAD_TOKEN)), F.lit(0))
    letter = F.substring(first, 1, 1)
    number = F.concat(letter, F.lit(" "), F.regexp_extract(first, ROAD_TOKEN, 2))
    place = F.array_position(compact, first)
    shown = F.transform(
        tokens, lambda t, i: F.when((i + 1).cast("bigint") == place, number).otherwise(t)
    )
    return Station(
        F.array_join(shown, " / "), number, F.coalesce(letter, F.lit("G"))
    )
