"""Zoom ladder and slippy-map tile cover.

Coordinates are projected once to the unit square (x to the east, y to the south); at zoom ``z``
they are only multiplied by ``2^z``, which is exact.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from trafficloom.functions.geometry import map_points

# --- fixed values -----------------------------------------------------------------------
# (zoom, smallest daily count shown from that zoom on); below the first zoom the last one holds.
LADDER = ((8, 0), (7, 1000), (6, 2000), (0, 10000))
# ----------------------------------------------------------------------------------------

MERCATOR_LIMIT = math.degrees(math.atan(math.sinh(math.pi)))
UNIT_END = 1.0 - 2.0**-40  # keeps the eastern and southern edge of the world in the last tile


def zoom_threshold(zoom: Column) -> Column:
    """Smallest daily count visible at a (possibly fractional) zoom."""
    z = F.floor(zoom)
    out = F.when(z >= LADDER[0][0], LADDER[0][1])
    for start, least in LADDER[1:-1]:
        out = out.when(z >= start, least)
    return out.otherwise(LADDER[-1][1])


def on_ladder(zoom: Column, dtv_kfz: Column) -> Column:
    """Features without a count stand as zero and only show from the last step on."""
    return F.coalesce(dtv_kfz, F.lit(0)) >= zoom_threshold(zoom)


def first_zoom(dtv_kfz: Column, minzoom: int, ladder: bool) -> Column:
    """The zoom a feature first shows at; the ladder only ever adds features further in."""
    if not ladder:
        return F.lit(minzoom)
    value = F.coalesce(dtv_kfz, F.lit(0))
    steps = sorted(LADDER)  # widest view first
    out = F.when(value >= steps[0][1], max(steps[0][0], minzoom))
    for start, least in steps[1:]:
        out = out.when(value >= least, max(start, minzoom))
    return out


def unit_x(lon: Column) -> Column:
    inside = F.greatest(F.least(lon, F.lit(180.0)), F.lit(-180.0))
    return F.least((inside + 180.0) / 360.0, F.lit(UNIT_END))


def unit_y(lat: Column) -> Column:
    inside = F.greatest(F.least(lat, F.lit(MERCATOR_LIMIT)), F.lit(-MERCATOR_LIMIT))
    row = (1.0 - F.asinh(F.tan(F.radians(inside))) / F.lit(math.pi)) / 2.0
    return F.greatest(F.least(row, F.lit(UNIT_END)), F.lit(0.0))


def mercator(p: Column) -> Column:
    """A point as the projection gives it, also where that is outside the unit square."""
    row = (1.0 - F.asinh(F.tan(F.radians(p["y"]))) / F.lit(math.pi)) / 2.0
    return F.struct(((p["x"] + 180.0) / 360.0).alias("x"), row.alias("y"))


def unit_parts(geom: Column, clamped: bool = True) -> Column:
    """All points of a geometry in the unit square, those beyond its edges moved to them unless not
    ``clamped``."""
    if not clamped:
        return map_points(geom, mercator)
    return map_points(
        geom, lambda p: F.struct(unit_x(p["x"]).alias("x"), unit_y(p["y"]).alias("y"))
    )


def scale(zoom: Column) -> Column:
    return F.pow(F.lit(2.0), zoom)


def cell(c: Column) -> Column:
    return F.floor(c)


SHIFT = 2**32


def tile(x: Column, y: Column) -> Column:
    """A tile as one number: lists of numbers are made distinct by hashing, structs are not."""
    return x * F.lit(SHIFT) + y


def tile_x(code: Column) -> Column:
    return F.shiftright(code - row_of(code), 32).cast("int")


def row_of(code: Column) -> Column:
    """The last 32 bits with their sign: rows north of the map are below zero."""
    return F.shiftright(F.shiftleft(code, 32), 32)


def tile_y(code: Column) -> Column:
    return row_of(code).cast("int")


# --- fixed values: masks that spread the bits of a number, every second place left free ----
_SPREAD = ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555))
# ----------------------------------------------------------------------------------------
CURVE_BITS = 12  # places per side of a tile: 2^12


def z_order(col: Column, row: Column) -> Column:
    """Place on the Z-shaped curve through a square of 2^16 by 2^16 places: the bits of column and
    row in turn. Places that share their first bits are neighbours."""

    def spread(c: Column) -> Column:
        c = c.cast("bigint")
        for by, mask in _SPREAD:
            c = c.bitwiseOR(F.shiftleft(c, by)).bitwiseAND(F.lit(mask).cast("bigint"))
        return c

    return spread(col).bitwiseOR(F.shiftleft(spread(row), 1))


def curve_in_tile(u: Column, v: Column, z: Column, x: Column, y: Column) -> Column:
    """Place of a point of the unit square on the curve through its tile."""
    side = F.lit(float(2**CURVE_BITS))

    def place(at: Column, tile: Column) -> Column:
        inside = F.floor((at * scale(z) - tile) * side)
        return F.greatest(F.least(inside, F.lit(2**CURVE_BITS - 1)), F.lit(0))

    return z_order(place(u, x), place(v, y))


def segments(unit: Column) -> Column:
    """All segments of unit-square parts, west end first; a lone point is a segment of no length.

    The slope is the same at every zoom, so this is worked out once per feature.
    """

    def between(a: Column, b: Column) -> Column:
        east = a["x"] <= b["x"]
        return F.struct(
            F.least(a["x"], b["x"]).alias("x0"),
            F.greatest(a["x"], b["x"]).alias("x1"),
            F.when(east, a["y"]).otherwise(b["y"]).alias("y0"),
            F.when(east, b["y"]).otherwise(a["y"]).alias("y1"),
            F.when(a["x"] != b["x"], (b["y"] - a["y"]) / (b["x"] - a["x"])).alias("slope"),
        )

    def of_part(part: Column) -> Column:
        n = F.size(part)
        starts = F.slice(part, F.lit(1), F.greatest(n - 1, F.lit(1)))
        ends = F.slice(part, F.greatest(F.least(n, F.lit(2)), F.lit(1)), F.greatest(n, F.lit(1)))
        return F.zip_with(starts, ends, between)

    return F.flatten(F.transform(unit, of_part))


def segment_tiles(s: Column, size: Column) -> Column:
    """Tiles a segment runs through at the zoom with ``size`` tiles per side.

    Walks the tile columns the segment spans; inside one column the segment covers a gapless
    range of rows. The work is the length of the segment, not the area of its envelope.
    """

    def column_tiles(col: Column) -> Column:
        enter = F.when(s["x0"] * size >= col, s["y0"]).otherwise(
            s["y0"] + (col / size - s["x0"]) * s["slope"]
        )
        leave = F.when(s["x1"] * size <= col + 1, s["y1"]).otherwise(
            s["y0"] + ((col + 1) / size - s["x0"]) * s["slope"]
        )
        rows = F.sequence(cell(enter * size), cell(leave * size))  # down or up
        return F.transform(rows, lambda row: tile(col, row))

    columns = F.sequence(cell(s["x0"] * size), cell(s["x1"] * size))
    return F.flatten(F.transform(columns, column_tiles))


def cover(found: Column, size: Column) -> Column:
    """Distinct tiles of all segments of a feature, worked out in its own row."""
    return F.array_distinct(F.flatten(F.transform(found, lambda s: segment_tiles(s, size))))


def in_one_tile(box: Column, size: Column) -> Column:
    """Does one tile hold the whole box at the zoom with ``size`` tiles per side?"""
    return (cell(box["xmin"] * size) == cell(box["xmax"] * size)) & (cell(box["ymin"] * size) == cell(box["ymax"] * size))


def box_tiles(box: Column, several: Column, size: Column) -> Column:
    """The one tile that holds the whole box, else whatever ``several`` works out.

    Most features lie inside a single tile at most zooms; only the others are walked.
    """
    here = tile(cell(box["xmin"] * size), cell(box["ymin"] * size))
    return F.when(in_one_tile(box, size), F.array(here)).otherwise(several)
