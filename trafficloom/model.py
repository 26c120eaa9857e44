"""The canonical feature table: columns, allowed values and the geometry type."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values of the contract ------------------------------------------------------
METRICS = ("DTV", "DTVw", "24h")
ROAD_CLASSES = ("A", "B", "L", "K", "G")
LEVELS = ("bund", "land", "kommune")
GEOMETRY_KINDS = ("Point", "MultiPoint", "LineString", "MultiLineString")
POINT_KINDS = ("Point", "MultiPoint")
SRID = 4326
REQUIRED = ("metric", "year", "road_class", "state", "source", "level", "license")
# ----------------------------------------------------------------------------------------

ENUMS = {"metric": METRICS, "road_class": ROAD_CLASSES, "level": LEVELS}

XY = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
PARTS = T.ArrayType(T.ArrayType(XY))
# A point is parts[0][0], a line is parts[0], a multi geometry has one inner array per part.
GEOMETRY = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("srid", T.IntegerType()),
        T.StructField("parts", PARTS),
    ]
)

CANONICAL = T.StructType(
    [
        T.StructField("dtv_kfz", T.LongType()),
        T.StructField("dtv_sv", T.LongType()),
        T.StructField("sv_anteil", T.DoubleType()),
        T.StructField("metric", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("road_class", T.StringType()),
        T.StructField("road_no", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("station_id", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("license", T.StringType()),
        T.StructField("geometry", GEOMETRY),
    ]
)
COLUMNS = tuple(f.name for f in CANONICAL if f.name != "geometry")
OPTIONAL = ("dtv_kfz", "dtv_sv", "sv_anteil", "road_no", "name", "station_id")

# Landed rows keep their place in the input, so "the first row wins" has a meaning.
ORDINAL = "_ord"
