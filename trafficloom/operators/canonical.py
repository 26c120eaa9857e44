"""Mapping a source table to the canonical feature table."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficloom.functions import geometry as geo
from trafficloom.functions import tiling
from trafficloom.functions import values as v
from trafficloom.functions.roads import ColumnRule, lookup
from trafficloom.model import CANONICAL, COLUMNS, LEVELS, SRID


@dataclass(frozen=True)
class Spec:
    """How one source maps to the canonical columns.

    ``columns``    {source column: canonical column}
    ``year``       one year for all rows, or ``year_from`` names the column holding it
    ``road_class`` one class for all rows, or ``road_class_from`` names the column and
                   ``road_class_map`` turns it into a class: a dict (unknown codes become null
                   and fail the contract), a ``ColumnRule`` or a Python function per value
    ``level``      publisher level; looked up by ``source`` in ``levels`` when not given
    ``srid``       system of all coordinates; without it each geometry's own one counts
    """

    columns: Mapping[str, str]
    metric: str
    state: str
    source: str
    license: str
    year: int | None = None
    year_from: str | None = None
    level: str | None = None
    levels: Mapping[str, str] = field(default_factory=dict)
    road_class: str | None = None
    road_class_from: str | None = None
    road_class_map: Mapping[str, str] | ColumnRule | Callable[[object], str] | None = None
    srid: int | None = None


_MOVED: ContextVar[bool] = ContextVar("moved", default=True)


@contextmanager
def where_they_lie() -> Iterator[None]:
    """Plans built inside leave geometries in their own reference systems, which they name. For
    ``catalogue.stats_of_points``; the contract wants them in EPSG:4326."""
    token = _MOVED.set(False)
    try:
        yield
    finally:
        _MOVED.reset(token)


def _placed(geometry: Column, srid: int | None) -> Column:
    if _MOVED.get():
        return geo.to_wgs84(geometry, srid)
    return geometry if srid is None else geo.stating(geometry, srid)


def source_level(source: str, levels: Mapping[str, str]) -> str:
    level = levels.get(source)
    if level not in LEVELS:
        raise ValueError(f"no valid level for source {source!r}: {level!r}")
    return level


def _road_class(spec: Spec, c: Column) -> Column:
    rule = spec.road_class_map
    if not rule:
        return c.cast("string")
    if isinstance(rule, ColumnRule):
        return rule(c)
    if isinstance(rule, Mapping):
        return lookup(rule, c.cast("string"))
    return F.udf(rule, "string", useArrow=True)(c)


def to_canonical(df: DataFrame, spec: Spec) -> DataFrame:
    """Rename, add constants, drop foreign columns, reproject, clean the counts."""
    if spec.year is None and spec.year_from is None:
        raise ValueError("give year or year_from")
    if spec.road_class is None and spec.road_class_from is None:
        raise ValueError("give road_class or road_class_from")
    level = spec.level or source_level(spec.source, spec.levels)

    # Where each column of the renamed table comes from.
    origin = {c: c for c in df.columns if c not in spec.columns}
    origin.update({target: c for c, target in spec.columns.items() if c in df.columns})

    def named(name: str) -> str:
        return origin.get(name, name)

    def column(name: str) -> Column:
        return F.col(f"`{named(name)}`")

    def optional(name: str, kind: str) -> Column:
        return column(name).cast(kind) if name in origin else F.lit(None).cast(kind)

    def count(name: str) -> Column:
        if name not in origin:
            return F.lit(None).cast("bigint")
        return v.count_value(v.number(df, named(name)))

    year = (
        F.lit(spec.year).cast("int")
        if spec.year_from is None
        else v.whole_year(v.number(df, named(spec.year_from)))
    )
    road_class = (
        F.lit(spec.road_class)
        if spec.road_class is not None
        else _road_class(spec, column(spec.road_class_from))
    )
    share = (
        v.number(df, named("sv_anteil"))
        if "sv_anteil" in origin
        else F.lit(None).cast("double")
    )
    out = df.select(
        count("dtv_kfz").alias("dtv_kfz"),
        count("dtv_sv").alias("dtv_sv"),
        share.alias("sv_anteil"),
        F.lit(spec.metric).alias("metric"),
        year.alias("year"),
        road_class.alias("road_class"),
        optional("road_no", "string").alias("road_no"),
        optional("name", "string").alias("name"),
        optional("station_id", "string").alias("station_id"),
        F.lit(spec.state).alias("state"),
        F.lit(spec.source).alias("source"),
        F.lit(level).alias("level"),
        F.lit(spec.license).alias("license"),
        _placed(F.col("geometry"), spec.srid).alias("geometry"),
    )
    return clean_counts(out)


def clean_counts(df: DataFrame) -> DataFrame:
    """Whole, non-placeholder counts; applying it again changes nothing."""
    kfz = v.clean_kfz(F.col("dtv_kfz"))
    return df.withColumns(
        {"dtv_kfz": kfz, "dtv_sv": v.clean_sv(kfz, F.col("dtv_sv"))}
    )


def normalize_counts(df: DataFrame) -> DataFrame:
    """``clean_counts`` for a table whose counts may still be texts or doubles."""
    whole = {n: v.count_value(v.number(df, n)) for n in ("dtv_kfz", "dtv_sv")}
    return clean_counts(df.withColumns(whole))


def canonical_columns(df: DataFrame) -> DataFrame:
    """Fixed order, foreign columns dropped, types as in the contract."""
    return df.select(
        *[F.col(c).cast(CANONICAL[c].dataType).alias(c) for c in COLUMNS], "geometry"
    )


def points_from_xy(df: DataFrame, x: str, y: str, srid: int = SRID) -> DataFrame:
    """Point geometry in EPSG:4326 from two coordinate columns; rows without both drop out.

    The coordinates stay flat columns through the projection, so it compiles to plain arithmetic.
    """
    read = df.withColumns({"_x": v.number(df, x), "_y": v.number(df, y)}).filter(
        F.col("_x").isNotNull() & F.col("_y").isNotNull()
    )
    moved = geo.reproject_columns(read, srid, "_x", "_y", "_lon", "_lat")
    return moved.withColumn("geometry", geo.point(F.col("_lon"), F.col("_lat"))).drop(
        "_x", "_y", "_lon", "_lat"
    )


def write_ready(df: DataFrame, keep_missing: bool = False) -> DataFrame:
    """Only rows with a geometry, with a flat envelope beside it for file pruning.

    The envelope comes out of a generator that yields nothing for a missing geometry, so the
    test is not copied into a filter below, where the geometry would be worked out twice.
    ``keep_missing`` leaves those rows in, without envelope. The geometry is the last column, so
    that footers can be asked about all others (``footers.read``).
    """
    geometry = F.col("geometry")
    box = F.when(~geo.is_missing(geometry), F.array(geo.bounds(geometry)))
    ready = df.select(*df.columns, F.inline_outer(box) if keep_missing else F.inline(box))
    return ready.select(*[c for c in ready.columns if c != "geometry"], "geometry")


def near_each_other(df: DataFrame, first: Sequence[str], spread: bool) -> DataFrame:
    """Rows with a flat envelope in the order of a space-filling curve within each value of
    ``first``, so that neighbours share row groups and a box reads few of them. ``spread`` deals
    ranges of that order to the tasks; without it each task sorts what it has."""
    middle = [(F.col(f"{a}min") + F.col(f"{a}max")) / 2.0 for a in "xy"]
    side = F.lit(float(2**16))
    places = [F.floor(unit * side) for unit in (tiling.unit_x(middle[0]), tiling.unit_y(middle[1]))]
    keyed = df.withColumn("_curve", tiling.z_order(*places))
    order = [*first, "_curve"]
    if spread:
        keyed = keyed.repartitionByRange(*order)
    return keyed.sortWithinPartitions(*order).drop("_curve")
