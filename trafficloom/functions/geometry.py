"""Geometry as nested arrays of points, handled by plain column expressions.

The inverse transverse Mercator projection follows the Krueger series in the third flattening
(Karney 2011, third order), good to well under a millimetre inside a zone.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficloom.model import POINT_KINDS, SRID


class Zone(NamedTuple):
    """A transverse Mercator zone and, where its datum differs, the shift to WGS 84."""

    semi_major: float
    inverse_flattening: float
    meridian: float
    scale: float
    false_easting: float
    helmert: tuple[float, ...] | None = None  # dx, dy, dz [m], rx, ry, rz ["], scale [ppm]


# --- fixed values: public EPSG parameters -----------------------------------------------
ZONES = {
    25832: Zone(6378137.0, 298.257222101, 9.0, 0.9996, 500000.0),
    25833: Zone(6378137.0, 298.257222101, 15.0, 0.9996, 500000.0),
    31466: Zone(
        6377397.155, 299.1528128, 6.0, 1.0, 2500000.0,
        (598.1, 73.7, 418.2, 0.202, 0.045, -2.455, 6.7),
    ),
}
WGS84 = (6378137.0, 298.257223563)
# ----------------------------------------------------------------------------------------


BOX = ("xmin", "ymin", "xmax", "ymax")


def xy(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def geometry(kind: Column | str, srid: Column | int, parts: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    srid = F.lit(srid) if isinstance(srid, int) else srid
    return F.struct(kind.alias("kind"), srid.cast("int").alias("srid"), parts.alias("parts"))


def point(x: Column, y: Column, srid: Column | int = SRID) -> Column:
    return geometry("Point", srid, F.array(F.array(xy(x, y))))


def line(points: Column, srid: Column | int = SRID) -> Column:
    """A LineString from an array of ``struct<x,y>``."""
    return geometry("LineString", srid, F.array(points))


def map_points(geom: Column, change: Callable[[Column], Column]) -> Column:
    return F.transform(geom["parts"], lambda part: F.transform(part, change))


def with_srid(geom: Column, srid: int) -> Column:
    """State the reference system without moving any point."""
    return geom.withField("srid", F.lit(srid))


def stating(geom: Column, srid: int) -> Column:
    """``with_srid`` built field by field, so that points nobody asks for are not read; a null
    geometry then has null fields and still counts as missing."""
    return F.struct(geom["kind"].alias("kind"), F.lit(srid).alias("srid"), geom["parts"].alias("parts"))


def swap_axes(geom: Column) -> Column:
    """Lat/lon delivered as x/y, put the right way round."""
    return geom.withField("parts", map_points(geom, lambda p: xy(p["y"], p["x"])))


def is_missing(geom: Column) -> Column:
    """True for a null geometry and for one without any point."""
    return ~F.coalesce(F.exists(geom["parts"], lambda p: F.size(p) > 0), F.lit(False))


def is_point(geom: Column) -> Column:
    return geom["kind"].isin(*POINT_KINDS)


def bounds(geom: Column) -> Column:
    """Envelope of one geometry: ``struct<xmin,ymin,xmax,ymax>``."""
    return bounds_of_parts(geom["parts"])


def bounds_of_parts(parts: Column) -> Column:
    points = F.flatten(parts)
    xs = F.transform(points, lambda p: p["x"])
    ys = F.transform(points, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("xmin"),
        F.array_min(ys).alias("ymin"),
        F.array_max(xs).alias("xmax"),
        F.array_max(ys).alias("ymax"),
    )


def intersects_box(box: Column, w: float, s: float, e: float, n: float) -> Column:
    """Does an envelope touch the box west, south, east, north?"""
    return (box["xmin"] <= e) & (box["xmax"] >= w) & (box["ymin"] <= n) & (box["ymax"] >= s)


def first_point(geom: Column) -> Column:
    return F.get(F.get(geom["parts"], F.lit(0)), F.lit(0))


def point_count(geom: Column) -> Column:
    return F.size(F.flatten(geom["parts"]))


def shape_hash(geom: Column) -> Column:
    """Short key of the exact shape; equal shapes still have to be compared in full."""
    return F.xxhash64(geom["kind"], geom["parts"])


def rounded(c: Column, digits: int = 4) -> Column:
    return F.bround(c, digits)


# ---------------------------------------------------------------------- reprojection


class Series(NamedTuple):
    rectifying: float
    beta: tuple[float, float, float]
    delta: tuple[float, float, float]


def series(zone: Zone) -> Series:
    n = 1.0 / (2.0 * zone.inverse_flattening - 1.0)
    radius = zone.semi_major / (1.0 + n) * (1.0 + n**2 / 4.0 + n**4 / 64.0)
    beta = (
        n / 2.0 - 2.0 * n**2 / 3.0 + 37.0 * n**3 / 96.0,
        n**2 / 48.0 + n**3 / 15.0,
        17.0 * n**3 / 480.0,
    )
    delta = (
        2.0 * n - 2.0 * n**2 / 3.0 - 2.0 * n**3,
        7.0 * n**2 / 3.0 - 8.0 * n**3 / 5.0,
        56.0 * n**3 / 15.0,
    )
    return Series(radius, beta, delta)


def _grid(zone: Zone, x: Column, y: Column) -> tuple[Column, Column]:
    radius = zone.scale * series(zone).rectifying
    return y / F.lit(radius), (x - F.lit(zone.false_easting)) / F.lit(radius)


def _conformal(zone: Zone, xi: Column, eta: Column) -> tuple[Column, Column]:
    a, b = xi, eta
    for j, beta in enumerate(series(zone).beta, start=1):
        k = 2.0 * j
        a = a - F.lit(beta) * F.sin(xi * k) * F.cosh(eta * k)
        b = b - F.lit(beta) * F.cos(xi * k) * F.sinh(eta * k)
    return a, b


def _angles(xi: Column, eta: Column) -> tuple[Column, Column]:
    """Conformal latitude and the longitude difference to the meridian, in radians."""
    return F.asin(F.sin(xi) / F.cosh(eta)), F.atan2(F.sinh(eta), F.cos(xi))


def _latitude(zone: Zone, chi: Column) -> Column:
    phi = chi
    for j, delta in enumerate(series(zone).delta, start=1):
        phi = phi + F.lit(delta) * F.sin(chi * (2.0 * j))
    return phi


def _square_eccentricity(inverse_flattening: float) -> float:
    f = 1.0 / inverse_flattening
    return f * (2.0 - f)


def _to_earth_centred(zone: Zone, phi: Column, lam: Column) -> tuple[Column, Column, Column]:
    e2 = _square_eccentricity(zone.inverse_flattening)
    radius = F.lit(zone.semi_major) / F.sqrt(1.0 - F.lit(e2) * F.sin(phi) * F.sin(phi))
    return (
        radius * F.cos(phi) * F.cos(lam),
        radius * F.cos(phi) * F.sin(lam),
        radius * F.lit(1.0 - e2) * F.sin(phi),
    )


def _shift(zone: Zone, x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """Seven-parameter position-vector transformation."""
    dx, dy, dz, rx, ry, rz, ppm = zone.helmert
    rx, ry, rz = (math.radians(v / 3600.0) for v in (rx, ry, rz))
    m = 1.0 + ppm * 1e-6
    return (
        F.lit(dx) + F.lit(m) * (x - F.lit(rz) * y + F.lit(ry) * z),
        F.lit(dy) + F.lit(m) * (F.lit(rz) * x + y - F.lit(rx) * z),
        F.lit(dz) + F.lit(m) * (F.lit(-ry) * x + F.lit(rx) * y + z),
    )


def _from_earth_centred(x: Column, y: Column, z: Column) -> tuple[Column, Column]:
    """Bowring's closed form, exact to far below a millimetre near the surface."""
    a, inverse = WGS84
    e2 = _square_eccentricity(inverse)
    b = a * math.sqrt(1.0 - e2)
    p = F.sqrt(x * x + y * y)
    theta = F.atan2(z * F.lit(a), p * F.lit(b))
    phi = F.atan2(
        z + F.lit(e2 / (1.0 - e2) * b) * F.pow(F.sin(theta), F.lit(3.0)),
        p - F.lit(e2 * a) * F.pow(F.cos(theta), F.lit(3.0)),
    )
    return phi, F.atan2(y, x)


def reproject_columns(df: DataFrame, srid: int, x: str, y: str, lon: str, lat: str) -> DataFrame:
    """Add ``lon``/``lat`` for flat coordinate columns: compiled expressions, step by step."""
    if srid == SRID:
        return df.withColumns({lon: F.col(x), lat: F.col(y)})
    zone = ZONES[srid]
    c = F.col
    step = "_tm_"

    def put(frame: DataFrame, **values: Column) -> DataFrame:
        return frame.withColumns({step + k: v for k, v in values.items()})

    def get(*names: str) -> list[Column]:
        return [c(step + n) for n in names]

    a, b = _grid(zone, c(x), c(y))
    out = put(df, a=a, b=b)
    a, b = _conformal(zone, *get("a", "b"))
    out = put(out, c=a, d=b)
    chi, dlam = _angles(*get("c", "d"))
    out = put(out, chi=chi, dlam=dlam)
    out = put(
        out,
        phi=_latitude(zone, c(step + "chi")),
        lam=c(step + "dlam") + F.lit(math.radians(zone.meridian)),
    )
    names = ["a", "b", "c", "d", "chi", "dlam", "phi", "lam"]
    if zone.helmert:
        ex, ey, ez = _to_earth_centred(zone, *get("phi", "lam"))
        out = put(out, ex=ex, ey=ey, ez=ez)
        sx, sy, sz = _shift(zone, *get("ex", "ey", "ez"))
        out = put(out, sx=sx, sy=sy, sz=sz)
        phi, lam = _from_earth_centred(*get("sx", "sy", "sz"))
        out = put(out, phi=phi, lam=lam)
        names += ["ex", "ey", "ez", "sx", "sy", "sz"]
    out = out.withColumns({lon: F.degrees(c(step + "lam")), lat: F.degrees(c(step + "phi"))})
    return out.drop(*[step + n for n in names])


def _pair(a: Column, b: Column) -> Column:
    return F.struct(a.alias("a"), b.alias("b"))


def _triple(a: Column, b: Column, c: Column) -> Column:
    return F.struct(a.alias("a"), b.alias("b"), c.alias("c"))


def _parts_to_wgs84(zone: Zone, parts: Column) -> Column:
    """All points of a geometry, one pass over the points per step of the calculation."""

    def step(points: Column, change: Callable[[Column], Column]) -> Column:
        return F.transform(points, lambda part: F.transform(part, change))

    meridian = F.lit(math.radians(zone.meridian))
    out = step(parts, lambda p: _pair(*_grid(zone, p["x"], p["y"])))
    out = step(out, lambda p: _pair(*_conformal(zone, p["a"], p["b"])))
    out = step(out, lambda p: _pair(*_angles(p["a"], p["b"])))
    out = step(out, lambda p: _pair(_latitude(zone, p["a"]), p["b"] + meridian))
    if zone.helmert:
        out = step(out, lambda p: _triple(*_to_earth_centred(zone, p["a"], p["b"])))
        out = step(out, lambda p: _triple(*_shift(zone, p["a"], p["b"], p["c"])))
        out = step(out, lambda p: _pair(*_from_earth_centred(p["a"], p["b"], p["c"])))
    return step(out, lambda p: xy(F.degrees(p["b"]), F.degrees(p["a"])))


def to_wgs84(geom: Column, srid: int | None = None) -> Column:
    """Geometry in EPSG:4326.

    ``srid`` fixes the source system for the whole column; otherwise each row's own one counts.
    A row in an unknown system keeps it and fails the contract. With a fixed system the result
    is built field by field, so a query that only asks for the kind never moves a point; a null
    geometry then has null fields and still counts as missing.
    """

    def moved(code: int) -> Column:
        zone = ZONES[code]
        return F.struct(
            geom["kind"].alias("kind"),
            F.lit(SRID).alias("srid"),
            _parts_to_wgs84(zone, geom["parts"]).alias("parts"),
        )

    if srid == SRID:
        return geom
    if srid is not None:
        return moved(srid)
    out = F.when(geom["srid"] == SRID, geom)
    for code in ZONES:
        out = out.when(geom["srid"] == code, moved(code))
    return out.otherwise(geom)
