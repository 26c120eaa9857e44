"""Landed files as tables.

A download tool drops the payload of each source below ``<landing>/<source>/<layer>/``. Every
reader declares its columns (nothing is inferred), keeps the place of each row in the input and
leaves parsing to the tasks. Feature collections are read in pieces (``sources/collections.py``);
other documents are parsed by one task each, so large layers are landed as pages.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficloom.functions import geometry as geo
from trafficloom.functions import values as v
from trafficloom.model import ORDINAL, PARTS, SRID
from trafficloom.operators.canonical import points_from_xy
from trafficloom.sources import collections

# --- fixed values -----------------------------------------------------------------------
DOWNLOAD_ENDINGS = (".zip", ".gml", ".json", ".geojson")
HREF = r'href="([^"]+)"'
# ----------------------------------------------------------------------------------------


class LandingError(collections.CollectionError):
    """The landed payload is not what the source promises."""


def natural(text: Column) -> Column:
    """A text whose order takes runs of digits as numbers: page 2 comes before page 10."""
    parts = F.regexp_extract_all(text, F.lit(r"\d+|\D+"), F.lit(0))
    padded = F.transform(
        parts, lambda p: F.when(p.rlike(r"^\d{1,20}$"), F.lpad(p, 20, "0")).otherwise(p)
    )
    return F.array_join(padded, "")


def _place(*inside: Column) -> Column:
    """Total input order: file (by the numbers in its name), block of the file, row."""
    return F.struct(
        natural(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        *inside,
    )


# ------------------------------------------------------------------------------ tables


# Doubled quotes stand for one, a quoted cell may run over lines. Rows that do not have the
# header's cells (an unclosed quote shifts them) and files with another header fail the load.
CSV = {
    "header": "true",
    "encoding": "UTF-8",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "mode": "FAILFAST",
    "enforceSchema": "false",
}


def read_table(spark: SparkSession, paths: str | Sequence[str], **options: str) -> DataFrame:
    """CSV files with a header, every column a text; the usual words for "missing" are null.

    A file is read by one task, because a cell may hold line breaks; ``multiLine="false"`` splits
    large files that are known to have none.
    """
    raw = spark.read.options(**{**CSV, **options}).csv(paths)
    row = F.monotonically_increasing_id().alias("row")
    return raw.select(
        *[v.null_tokens(F.col(f"`{c}`")).alias(c) for c in raw.columns],
        _place(row).alias(ORDINAL),
    )


def read_csv_points(
    spark: SparkSession, paths: str | Sequence[str], x: str, y: str, srid: int = SRID
) -> DataFrame:
    """A table with coordinate columns as points; rows without both coordinates drop out."""
    return points_from_xy(read_table(spark, paths), x, y, srid)


def read_sheet(spark: SparkSession, book: str, sheet: str | int = 0) -> DataFrame:
    """One sheet of a workbook landed as ``<book>/<sheet>.csv``."""
    return read_table(spark, f"{book}/{sheet}.csv")


# ----------------------------------------------------------------------------- GeoJSON

FEATURE = (
    "struct<type:string,id:string,properties:map<string,string>,"
    "geometry:struct<type:string,coordinates:string>>"
)
COLLECTION = f"features array<{FEATURE}>, links array<struct<rel:string,href:string>>"


def _vertices(c: Column) -> Column:
    """``[[x, y, …], …]`` as points; a height is ignored."""
    return F.transform(c, lambda p: geo.xy(F.get(p, F.lit(0)), F.get(p, F.lit(1))))


def geojson_geometry(g: Column, srid: int) -> Column:
    """Geometry object with its coordinates as JSON text."""
    kind, text = g["type"], g["coordinates"]
    one = F.from_json(text, "array<double>")
    many = F.from_json(text, "array<array<double>>")
    nested = F.from_json(text, "array<array<array<double>>>")
    dot = geo.xy(F.get(one, F.lit(0)), F.get(one, F.lit(1)))
    parts = (
        F.when(kind == "Point", F.when(F.size(one) >= 2, F.array(F.array(dot))))
        .when(kind == "MultiPoint", F.transform(_vertices(many), lambda p: F.array(p)))
        .when(kind == "LineString", F.array(_vertices(many)))
        .when(kind == "MultiLineString", F.transform(nested, _vertices))
    )
    shape = geo.geometry(kind, srid, F.coalesce(parts, F.array().cast(PARTS)))
    return F.when(kind.isNotNull(), shape)


def _property(name: str) -> Column:
    """A property; the feature's own ``id`` where no property has that name."""
    own = F.col("f.properties")[name]
    return F.coalesce(own, F.col("f.id")) if name == "id" else own


def piece_features(pieces: DataFrame, start: str) -> DataFrame:
    """Features (``f``) of the pieces of large collections, each parsed by itself, with their place."""
    text = collections.whole_pieces(F.col("value"), start)
    parsed = F.from_json(text, COLLECTION, {"mode": "FAILFAST"})
    place = F.struct(natural(F.col("file")).alias("file"), "block", "row")
    rows = pieces.select(place.alias("_page"), F.posexplode(parsed["features"]).alias("at", "f"))
    return rows.select("f", F.col("_page").withField("at", F.col("at")).alias(ORDINAL))


def read_geojson(
    spark: SparkSession,
    paths: str | Sequence[str],
    properties: Sequence[str],
    srid: int = SRID,
    swap: bool = False,
    per_line: bool = False,
    member: str | None = None,
    where: str | None = None,
    order_by: str | None = None,
    split: bool = False,
    places: DataFrame | None = None,
) -> DataFrame:
    """Feature collections (any number of pages) or one feature per line.

    ``srid``      states the system of the coordinates, whatever the file says
    ``swap``      the server delivered lat, lon
    ``member``    file name pattern to pick out of the landed directory
    ``where``     SQL condition on the property texts, ``order_by`` a property fixing the order
    ``split``     large documents: a task per byte range instead of one per file; files that are not
                  one whole collection are refused
    ``places``    ``(folder, page, at)``: pages come in the order of ``at`` instead of by name
    """

    def reader():
        if member:
            return spark.read.option("pathGlobFilter", member).option("recursiveFileLookup", "true")
        return spark.read

    start = collections.feature_start(reader(), paths) if split else None
    if start:
        rows = piece_features(collections.checked_pieces(reader(), paths, start), start)
    elif per_line:
        row = F.monotonically_increasing_id()
        schema = T._parse_datatype_string(FEATURE)  # noqa: SLF001
        rows = reader().schema(schema).json(paths).select(
            F.struct("*").alias("f"), _place(row.alias("row"), F.lit(0).alias("at")).alias(ORDINAL)
        )
    else:
        pages = reader().schema(COLLECTION).option("multiLine", "true").json(paths)
        place = _place(F.lit(0).cast("bigint").alias("row"))
        pages = pages.select(place.alias("_page"), *_names(), "features")
        if places is not None:
            ordered = places.select(*[F.col(c).alias(f"_{c}") for c in ("folder", "page", "at")])
            named = (F.col("folder") == F.col("_folder")) & (F.col("page") == F.col("_page_name"))
            pages = pages.join(ordered.withColumnRenamed("_page", "_page_name"), named, "left")
            # A chain's place goes before the file's name.
            by_chain = F.concat(F.col("folder"), F.lit("/"), F.lpad(F.col("_at").cast("string"), 20, "0"))
            pages = pages.withColumn("_page", F.col("_page").withField("file", F.coalesce(by_chain, "_page.file")))
        rows = pages.select("_page", F.posexplode("features").alias("at", "f")).select(
            "f", F.col("_page").withField("at", F.col("at")).alias(ORDINAL)
        )
    shape = geojson_geometry(F.col("f.geometry"), srid)
    out = rows.select(
        *[_property(p).alias(p) for p in properties],
        (geo.swap_axes(shape) if swap else shape).alias("geometry"),
        ORDINAL,
    )
    if where:
        out = out.filter(where)
    if order_by:
        first = v.parse_number(F.col(order_by))
        out = out.withColumn(ORDINAL, F.struct(first.alias("key"), F.col(ORDINAL).alias("place")))
    return out


def _names() -> tuple[Column, Column]:
    """Folder and name of a landed page."""
    return (
        F.regexp_extract("_metadata.file_path", r"^(.*)/[^/]*$", 1).alias("folder"),
        F.regexp_replace("_metadata.file_name", r"\.json$", "").alias("page"),
    )


def page_links(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(folder, page, next, href)`` of every landed page; ``next`` is null at the end of a chain."""
    pages = spark.read.schema(COLLECTION).option("multiLine", "true").json(paths)
    following = F.get(F.filter("links", lambda link: link["rel"] == "next"), F.lit(0))["href"]
    pages = pages.select(*_names(), following.alias("href"))
    return pages.withColumn("next", collections.page_name(F.col("href")))


def missing_pages(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``next`` links whose target page was not landed."""
    links = page_links(spark, paths)
    wanted = links.filter("next is not null").select(F.col("next").alias("page"), "href")
    return wanted.join(links.select("page"), "page", "left_anti")


def read_paged(spark: SparkSession, paths: str | Sequence[str], *args, **kwargs) -> DataFrame:
    """All pages of a paged service in the order of their links; an incomplete landing is an error,
    and so is a chain that branches or closes on itself."""
    gaps = missing_pages(spark, paths).agg(F.count("*").alias("n"), F.min("href").alias("href"))
    gap = gaps.first()
    if gap["n"]:
        raise LandingError(
            f"{gap['n']} pages not landed, among them {gap['href']}; missing_pages() lists all"
        )
    places = collections.page_order(page_links(spark, paths).select("folder", "page", "next"))
    return read_geojson(spark, paths, *args, places=places, **kwargs)


# --------------------------------------------------------------------------------- GML

_DIM = "_srsDimension:string"
_TEXT = f"struct<_VALUE:string,{_DIM}>"
_POINT = f"struct<pos:{_TEXT},{_DIM}>"
_LINE = f"struct<posList:{_TEXT},{_DIM}>"
_ARCS = f"struct<segments:struct<LineStringSegment:array<{_LINE}>>,{_DIM}>"
_CURVE = f"struct<LineString:{_LINE},Curve:{_ARCS}>"
GML_GEOMETRY = (
    f"struct<Point:{_POINT},LineString:{_LINE},Curve:{_ARCS},"
    f"MultiPoint:struct<pointMember:array<struct<Point:{_POINT}>>,{_DIM}>,"
    f"MultiCurve:struct<curveMember:array<{_CURVE}>,{_DIM}>,"
    f"MultiLineString:struct<lineStringMember:array<{_CURVE}>,{_DIM}>>"
)
# Names a geometry property goes by.
GML_NAMES = ("geom", "geometry", "the_geom", "shape", "wkb_geometry", "msGeometry")


def _positions(pos: Column, *around: Column) -> Column:
    """``x y x y …`` as points. The number of coordinates is the one stated nearest to them, two
    if none is; a list it does not divide fails."""
    stated = [c["_srsDimension"].try_cast("int") for c in (pos, *around)]
    step = F.coalesce(*stated, F.lit(2))
    numbers = F.transform(
        F.filter(F.split(v.strip(pos["_VALUE"]), r"\s+"), lambda t: t != ""),
        lambda t: v.parse_number(t),
    )
    whole = F.size(numbers) % step == 0
    starts = F.sequence(F.lit(0), F.greatest(F.size(numbers) - step, F.lit(0)), step)
    points = F.transform(starts, lambda i: geo.xy(F.get(numbers, i), F.get(numbers, i + 1)))
    odd = F.raise_error(F.concat(F.lit("coordinates do not come in groups of "), step))
    return F.when(F.size(numbers) >= 2, F.when(whole, points).otherwise(odd))


def _line(line: Column, *around: Column) -> Column:
    return _positions(line["posList"], line, *around)


def _arcs(curve: Column, *around: Column) -> Column:
    """The segments of a curve as one line; a shared end counts once."""
    parts = F.transform(
        curve["segments"]["LineStringSegment"], lambda seg: _line(seg, curve, *around)
    )

    def add(line: Column, part: Column) -> Column:
        same = F.get(line, F.size(line) - 1) == F.get(part, F.lit(0))
        joined = F.concat(line, F.slice(part, 2, F.greatest(F.size(part) - 1, F.lit(0))))
        return F.when(F.coalesce(same, F.lit(False)), joined).otherwise(F.concat(line, part))

    points = F.filter(parts, lambda p: p.isNotNull())
    empty = F.slice(F.get(points, F.lit(0)), 1, 0)
    return F.when(F.size(points) > 0, F.aggregate(points, empty, add))


def gml_geometry(g: Column, srid: int, swap: bool = False) -> Column:
    def members(many: Column, name: str) -> Column:
        def one(c: Column) -> Column:
            arcs = F.when(c["Curve"].isNotNull(), _arcs(c["Curve"], many))
            return F.coalesce(F.when(c["LineString"].isNotNull(), _line(c["LineString"], many)), arcs)

        return F.transform(many[name], one)

    dots = F.transform(
        g["MultiPoint"]["pointMember"],
        lambda m: _positions(m["Point"]["pos"], m["Point"], g["MultiPoint"]),
    )
    shapes = (
        ("Point", "Point", F.array(_positions(g["Point"]["pos"], g["Point"]))),
        ("LineString", "LineString", F.array(_line(g["LineString"]))),
        ("Curve", "LineString", F.array(_arcs(g["Curve"]))),
        ("MultiPoint", "MultiPoint", dots),
        ("MultiCurve", "MultiLineString", members(g["MultiCurve"], "curveMember")),
        ("MultiLineString", "MultiLineString", members(g["MultiLineString"], "lineStringMember")),
    )
    kind = F.coalesce(*(F.when(g[element].isNotNull(), F.lit(name)) for element, name, _ in shapes))
    parts = F.coalesce(*(F.when(g[element].isNotNull(), value) for element, _, value in shapes))
    whole = F.filter(parts, lambda p: p.isNotNull())
    shape = geo.geometry(kind, srid, whole)
    shape = geo.swap_axes(shape) if swap else shape
    return F.when(kind.isNotNull(), shape)


def read_gml(
    spark: SparkSession,
    paths: str | Sequence[str],
    row_tag: str,
    fields: Sequence[str],
    geometry: str | Sequence[str] | None = GML_NAMES,
    srid: int = SRID,
    swap: bool = False,
) -> DataFrame:
    """Feature members of GML documents; name prefixes are ignored. ``geometry`` names the element
    of the shape, or those it may be: the first that is there counts."""
    names = [geometry] if isinstance(geometry, str) else list(geometry or ())
    schema = ", ".join([f"`{f}` string" for f in fields])
    for name in names:
        schema += f", `{name}` {GML_GEOMETRY}"
    raw = (
        spark.read.schema(schema)
        .options(rowTag=row_tag, ignoreNamespace="true", attributePrefix="_")
        .xml(paths)
    )
    place = _place(F.monotonically_increasing_id().alias("row")).alias(ORDINAL)
    found = F.coalesce(*[F.col(f"`{n}`") for n in names]) if names else None
    shape = [gml_geometry(found, srid, swap).alias("geometry")] if names else []
    return raw.select(*[F.col(f"`{f}`") for f in fields], *shape, place)


def in_box(features: DataFrame, w: float, s: float, e: float, n: float) -> DataFrame:
    """Features whose envelope touches the box.

    A table written with flat envelope columns is filtered by them, which skips files and row
    groups; otherwise the envelope is worked out once per row.
    """
    if "xmin" in features.columns:
        return features.filter(geo.intersects_box(F.struct(*geo.BOX), w, s, e, n))
    boxed = features.withColumn("_box", F.explode(F.array(geo.bounds(F.col("geometry")))))
    return boxed.filter(geo.intersects_box(F.col("_box"), w, s, e, n)).drop("_box")


# ------------------------------------------------------------------------- link feeds


def fitting_links(
    text: Column, match: str | None = None, endings: Sequence[str] | None = DOWNLOAD_ENDINGS
) -> Column:
    """Links of one page with their place among all its links, in order."""

    def fits(link: Column) -> Column:
        low = F.lower(link["href"])
        good = F.lit(True) if match is None else low.contains(match.lower())
        if endings:
            ends = [low.endswith(e) for e in endings]
            good = good & reduce(lambda a, b: a | b, ends)
        return good

    links = F.transform(
        F.regexp_extract_all(text, F.lit(HREF), F.lit(1)),
        lambda href, at: F.struct(at.alias("at"), href.alias("href")),
    )
    return F.filter(links, fits)


def feed_links(pages: DataFrame, text: str, key: str, **options) -> DataFrame:
    """Candidate links of every feed page: ``(key, at, href)``."""
    return pages.select(key, F.inline(fitting_links(F.col(text), **options)))


def first_link(pages: DataFrame, text: str, key: str, **options) -> DataFrame:
    """The first fitting link of every feed page that has one: found inside the page's row."""
    first = F.slice(fitting_links(F.col(text), **options), 1, 1)
    return pages.select(key, F.inline(first)).select(key, "href")


def feed_link(spark: SparkSession, path: str, match: str | None = None) -> str:
    """Download link of one landed feed document."""
    feed = spark.read.text(path, wholetext=True).withColumn("feed", F.lit(path))
    found = first_link(feed, "value", "feed", match=match).first()
    if found is None:
        raise LandingError(f"feed {path}: no download link (match={match!r})")
    return found["href"]
